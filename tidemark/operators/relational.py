"""Joins, distinct counts, list/pattern filters, sorts and top-k.

Join strategy is left to the planner: dimension sides are broadcast by the
size check Spark applies (``spark.sql.autoBroadcastJoinThreshold`` against
the plan's size estimate, and again by AQE on the runtime size after
filtering); anything bigger is a shuffle join, with AQE splitting skewed
partitions. No side read from a file carries a broadcast hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# -- filters -------------------------------------------------------------------

def in_list(df: DataFrame, column: str, values) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def not_in_list(column: str, values) -> Column:
    return ~F.col(column).isin(list(values))


def equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """SQL LIKE: ``%`` and ``_`` are wildcards, ``[`` and ``]`` are literal."""
    return df.filter(F.col(column).like(pattern))


# -- aggregation shapes ----------------------------------------------------------

def count_by(df: DataFrame, keys: list[str], alias: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def count_distinct_by(df: DataFrame, keys: list[str], column: str, alias: str) -> DataFrame:
    """``count(distinct column)`` per key: Spark first groups by (key, column)
    with map-side partial aggregation, so a hot key is spread over the
    distinct values before the second grouping."""
    return df.groupBy(*keys).agg(F.count_distinct(F.col(column)).alias(alias))


def pre_count(df: DataFrame, key: str, alias: str = "_n") -> DataFrame:
    """Collapse a fact table to one row per join key with its row count, so a
    later join moves one row per key instead of every fact row."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))


# -- order and limits -------------------------------------------------------------

def sort_by(df: DataFrame, spec: list[tuple[str, str]]) -> DataFrame:
    """Global sort with explicit null order: ``("col", "asc"|"desc")``.

    ASC puts NULLs last and DESC first (the source database's default).
    """
    cols = []
    for name, direction in spec:
        c = F.col(name)
        cols.append(c.desc_nulls_first() if direction == "desc" else c.asc_nulls_last())
    return df.orderBy(*cols)


def top_k(df: DataFrame, spec: list[tuple[str, str]], k: int) -> DataFrame:
    """Sorted first ``k`` rows (each task keeps its own top k before the merge).

    ``spec`` must be a total order so the result is deterministic.
    """
    return sort_by(df, spec).limit(k)


def row_cap(df: DataFrame, spec: list[tuple[str, str]], cap: int) -> DataFrame:
    """Result row cap for ad-hoc reads, deterministic through a total order."""
    return top_k(df, spec, cap)
