"""Mart models built on staging: the detailed report and the daily rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rollup import daily_means
from tidemark.schemas import DAILY_COLUMNS, REPORT_COLUMNS


def report(stg: DataFrame) -> DataFrame:
    """Staging without ``inserted_at_local``; local time before UTC time."""
    return stg.select(*REPORT_COLUMNS)


def report_sorted(rep: DataFrame) -> DataFrame:
    """Read-time order of the report: city ascending, local time descending."""
    return rep.orderBy(
        F.col("city").asc_nulls_last(),
        F.col("weather_time_local").desc_nulls_first(),
        F.col("id").desc_nulls_last(),
    )


def daily_average(stg: DataFrame, scale: int = 2) -> DataFrame:
    """Per city and local date: exactly rounded means of four measures and a
    has-forecast flag."""
    return daily_means(stg, "city", "weather_time_local", scale=scale).select(*DAILY_COLUMNS)


def daily_sorted(daily: DataFrame) -> DataFrame:
    """Read-time order of the rollup: city, then newest date first."""
    return daily.orderBy(F.col("city").asc_nulls_last(), F.col("date").desc_nulls_first())
