"""Hourly slot grids.

The grid is built per key row with ``explode(sequence(..))``: no cartesian
product, and the work is spread over however many key rows there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timeshift import hour_floor
from tidemark.schemas import FORECAST_DAYS_AHEAD


def hourly_slots(
    keys: DataFrame, start_col: str, days_ahead: int = FORECAST_DAYS_AHEAD,
    slot_col: str = "time",
) -> DataFrame:
    """``24 * days_ahead`` hourly slots per key row from the top of ``start_col``'s hour."""
    n = 24 * days_ahead
    start = hour_floor(start_col)
    return keys.withColumn("_h", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn(
        slot_col, start + F.make_dt_interval(F.lit(0), F.col("_h"))
    ).drop("_h")


def latest_hour_per_key(raw: DataFrame, key: str = "city", time_col: str = "inserted_at",
                        carry: str = "utc_offset") -> DataFrame:
    """One row per key: its newest ``time_col``, where the grid starts, and the offset
    text of the newest row."""
    newest = F.max(F.struct(F.col(time_col), F.col(carry)))
    return raw.groupBy(key).agg(newest.alias("_m")).select(
        key, F.col(f"_m.{carry}").alias(carry), F.col(f"_m.{time_col}").alias("_start"))
