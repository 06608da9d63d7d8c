"""Filter interaction audit: what every filter removes under every order of the filters.

Each document is reduced to its mask, the set of filters that it fails, and documents are
counted by part and mask before anything else. In the lexicographic list of all orders the
ones that start with the same filters stand together, so the orders in which a mask is removed
at a given step by a given filter form intervals of Lehmer ranks. The count of a mask is
added at the start of each of its intervals and taken off at the end (a difference array);
prefix sums over the ranks give the removals of every order and step.

The interval table depends on the number of filters alone (840 rows for five) and is broadcast.
Rows per part: orders x steps, whatever the number of documents. A part may hold most rows, as
counts combine before every shuffle. Copies are found by the SHA-256 of the whole text: the
smallest id of each text is looked up by text and id together, so a text with very many copies
spreads by its ids.

Edge cases: a null text counts as empty, a null part as the empty string. A document with a
null id has no smaller id and is none, so it never fails as a copy. Rows that repeat id and
text are each counted and aren't copies of one another. Several labels of one id count as
their largest. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import blank_words, cut

MOST_FILTERS = 6
COUNTS = ("removed", "good_lost", "toxic_lost")


def lehmer_rank(prefix: tuple[int, ...], n: int) -> int:
    """Rank of the first order of ``n`` filters that starts with ``prefix``."""
    rank = 0
    for k, x in enumerate(prefix):
        smaller = sum(1 for y in range(x) if y not in prefix[:k])
        rank += smaller * factorial(n - 1 - k)
    return rank


def removal_intervals(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, lo, hi): in the orders of rank lo to hi - 1 the mask goes at that step."""
    out = []
    for step in range(1, n + 1):
        for prefix in permutations(range(n), step):
            lo = lehmer_rank(prefix, n)
            rest = [x for x in range(n) if x not in prefix]
            for size in range(len(rest) + 1):
                for more in combinations(rest, size):
                    mask = sum(1 << x for x in (prefix[-1], *more))
                    out.append((mask, step, lo, lo + factorial(n - step)))
    return out


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text: too short, repetitive, shouting, odd symbols."""
    words = blank_words(text)
    n = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": n < 200,
        "B": F.size(F.array_distinct(words)) * 100 < n * 50,
        "C": capitals * 100 > F.length(text) * 2,
        "D": text.rlike(r"[#$%&*|]"),
    }


def masks(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> tuple[DataFrame, str]:
    """(part, mask, n, good, toxic) and the letters of the filters; bit k is letter k.

    The last letter, E, is the copy of a smaller id's text.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"),
                        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    fails = text_failures(F.col("text"))
    bits = [F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(fails.values())]
    marks = labels.groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = plain.select("id", "part", F.unhex(F.sha2(F.col("text"), 256)).alias("key"),
                        sum(bits[1:], bits[0]).alias("mask"))
    rows = cut(rows.join(marks, "id", "left").fillna(0, ["good", "toxic"]))
    copy = 1 << len(fails)

    firsts = rows.where("id is not null").groupBy("key").agg(F.min("id").alias("id"))
    passing = rows.join(firsts, ["key", "id"], "left_semi") \
        .unionByName(rows.where("id is null"))

    def counted(df: DataFrame, sign: int, extra: int) -> DataFrame:
        return df.groupBy("part", (F.col("mask") + extra).alias("mask")).agg(
            (F.count(F.lit(1)) * sign).alias("n"), (F.sum("good") * sign).alias("good"),
            (F.sum("toxic") * sign).alias("toxic"))

    # All rows count as copies; the ones that pass are moved to the mask without that bit.
    passed = counted(passing, 1, 0)
    moved = passed.select("part", (F.col("mask") + copy).alias("mask"),
                          *[(-F.col(c)).alias(c) for c in ("n", "good", "toxic")])
    both = counted(rows, 1, copy).unionByName(passed).unionByName(moved)
    return both.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]) \
        .where("n > 0"), "".join(fails) + "E"


def order_table(spark: SparkSession, letters: str) -> DataFrame:
    """(rank, step, filter_order, bit): every order and the filter at each of its steps."""
    n = len(letters)
    rows = [(lehmer_rank(p, n), step, "".join(letters[x] for x in p), p[step - 1])
            for p in permutations(range(n)) for step in range(1, n + 1)]
    return spark.createDataFrame(rows, "rank int, step int, filter_order string, bit int")


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley; ``counts`` as from :func:`masks`."""
    n = len(letters)
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    spark = counts.sparkSession
    counts = cut(counts)
    intervals = spark.createDataFrame(removal_intervals(n), "mask int, step int, lo int, hi int")
    orders = order_table(spark, letters)
    ranks = factorial(n)

    def end(at: str, sign: int) -> Column:
        values = [(F.col(c) * sign).alias(name)
                  for c, name in zip(("n", "good", "toxic"), COUNTS)]
        return F.struct(F.col(at).alias("rank"), *values)

    steps = counts.join(F.broadcast(intervals), "mask").select(
        "part", "step", F.explode(F.array(end("lo", 1), end("hi", -1))).alias("x")) \
        .select("part", "step", "x.*").where(F.col("rank") < ranks)
    steps = steps.groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    nought = [F.lit(0).cast("long").alias(c) for c in COUNTS]
    grid = counts.select("part").distinct() \
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n)))) \
        .withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1)))) \
        .select("part", "step", "rank", *nought)
    dense = grid.unionByName(steps).repartition("part") \
        .groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(
        Window.unboundedPreceding, 0)
    sums = dense.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in COUNTS])

    has = [F.col("mask").bitwiseAND(1 << k) != 0 for k in range(n)]
    only = [F.col("mask") == (1 << k) for k in range(n)]
    zero = F.lit(0).cast("long")
    stats = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*[F.sum(F.when(c, F.col("n")).otherwise(zero)) for c in has]).alias("fails"),
        F.array(*[F.sum(F.when(c, F.col("n")).otherwise(zero)) for c in only]).alias("alone"))
    full = sums.join(F.broadcast(orders), ["rank", "step"]).join(stats, "part")
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(
        Window.unboundedPreceding, 0)
    return full.select(
        "part", "filter_order", "step",
        (F.col("total") - F.sum("removed").over(so_far)).alias("kept"), "removed",
        (F.col("fails")[F.col("bit")] - F.col("removed")).alias("redundant"),
        F.col("alone")[F.col("bit")].alias("unique_fails"), "good_lost", "toxic_lost",
        F.sum("removed").over(Window.partitionBy("part", "bit")).alias("shapley"))


def audit_documents(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """:func:`audit` of the text filters and the copy filter over whole documents."""
    return audit(*masks(docs, labels, **columns))
