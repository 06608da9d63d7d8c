"""Surrogate ids: consecutive 1..N (plus a base) in a given total order.

No single-partition window over the data: rows are range-partitioned and
sorted on the order keys and ties, each row gets its position inside its
partition, and the sorted rows are written once to the shared checkpoint
folder. Partition sizes are counted from those written rows, so positions and
offsets (one row per partition, broadcast) can't disagree, and a frequent key
is split over partitions by the tie columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir


def assign_ids(
    df: DataFrame,
    order_cols: list[str],
    id_col: str = "id",
    base: int | None = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``id_col`` = base + rank of the row in ``order_cols`` (ties broken by
    the other columns)."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # remaining sortable columns break ties, so a recomputed task (lost executor)
    # numbers its rows exactly as before; fully equal rows are interchangeable
    ties = [name for name, dtype in df.dtypes
            if name not in order_cols and not dtype.startswith(("map", "variant"))]
    sort_cols = [F.col(c).asc_nulls_first() for c in list(order_cols) + ties]
    ordered = (
        df.repartitionByRange(n, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # monotonically_increasing_id = partition index << 33 | position in partition
    ordered = ordered.withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    checkpoint_dir(df.sparkSession)
    ordered = ordered.checkpoint(eager=True)
    sizes = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"),
    ).fillna(0, subset=["_off"])
    out = ordered.join(F.broadcast(offsets), "_pid")
    return out.withColumn(
        id_col, F.lit(base or 0).cast("long") + F.col("_off") + F.col("_pos") + F.lit(1)
    ).drop("_pid", "_mid", "_pos", "_off")

