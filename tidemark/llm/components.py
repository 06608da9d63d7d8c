"""Connected components of a distributed edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root is one node of the component.

    Each round points every node at its smallest neighbour if that is smaller, follows the
    pointers to their ends by doubling, and contracts the edges to the ends; these are
    local minima, so the node count at least halves. The minima combine before the shuffle,
    and a node with very many edges costs one row per task there. Null ends are ignored.
    """
    edges = written(edges.where("a != b").select("a", "b").distinct(), "edges")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = written(both.groupBy(F.col("a").alias("node"))
                     .agg(F.least(F.min("b"), F.first("a")).alias("root")), "pointers")
        while True:
            ends = to.select(F.col("node").alias("via"), F.col("root").alias("end"))
            far = written(to.join(ends, to["root"] == ends["via"])
                          .select("node", F.col("end").alias("root"),
                                  (F.col("end") != F.col("root")).alias("moved")), "pointers")
            to = far.select("node", "root")
            if far.where("moved").isEmpty():
                break
        maps.append(to)
        left = to.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = to.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = written(edges.join(left, "a").join(right, "b").where("ra != rb")
                        .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                        .distinct(), "edges")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # From the last map back, so that each join meets a table of final roots.
    final = maps[-1]
    for earlier in reversed(maps[:-1]):
        step = final.select(F.col("node").alias("via"), F.col("root").alias("end"))
        final = written(earlier.join(step, earlier["root"] == step["via"], "left")
                        .select("node", F.coalesce("end", "root").alias("root")), "roots")
    return final
