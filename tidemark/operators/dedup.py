"""One row per key: latest-wins and first-wins.

``row_number() = 1`` over the key. Spark plans this with a partial
``WindowGroupLimit`` before the shuffle, so every map task forwards at most one
row per key and a hot key cannot flood one reducer.

Null order follows the source database: a NULL ordering value sorts first
under DESC (so it wins latest-wins) and last under ASC (so it loses
first-wins). The tie-break column makes the result deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_per_key(
    df: DataFrame,
    keys: list[str] = ("city", "time"),
    order_col: str = "inserted_at",
    tie_col: str = "id",
) -> DataFrame:
    """Newest ``order_col`` per key wins; ties go to the largest ``tie_col``."""
    order = [F.col(order_col).desc_nulls_first(), F.col(tie_col).desc_nulls_last()]
    return _first_per_key(df, list(keys), order)


def first_per_key(
    df: DataFrame,
    keys: list[str] = ("time",),
    order_col: str = "inserted_at",
    tie_col: str = "id",
) -> DataFrame:
    """Oldest ``order_col`` per key wins; ties go to the smallest ``tie_col``."""
    order = [F.col(order_col).asc_nulls_last(), F.col(tie_col).asc_nulls_last()]
    return _first_per_key(df, list(keys), order)


def latest_by_aggregate(
    df: DataFrame,
    keys: list[str] = ("city", "time"),
    order_col: str = "inserted_at",
    tie_col: str = "id",
) -> DataFrame:
    """Latest-wins as an aggregation (usable on streams, where ``row_number``
    is refused): ``max`` of a struct that orders like the window above
    (NULL ``order_col`` first, then newest, then largest tie)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(
        F.col(order_col).isNull().alias("_null"),
        F.col(order_col).alias("_o"),
        F.col(tie_col).alias("_t"),
        *[F.col(c) for c in rest],
    )
    best = df.groupBy(*keys).agg(F.max(rank).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*df.columns)
