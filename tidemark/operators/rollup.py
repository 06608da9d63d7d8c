"""Per-(key, day) rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.means import rounded_mean


def daily_means(
    df: DataFrame,
    key: str = "city",
    time_col: str = "weather_time_local",
    measures: dict[str, str] | None = None,
    flag_col: str = "is_forecast",
    flag_alias: str = "has_forecast_data",
    scale: int = 2,
) -> DataFrame:
    """Group by key and ``date(time_col)``; exact rounded means and an any-true flag.

    Partial aggregation runs before the shuffle, so a key holding a large
    share of the rows is reduced map-side to one buffer per task.
    """
    measures = measures or {
        "temperature": "avg_temperature",
        "wind_speed": "avg_wind_speed",
        "humidity": "avg_humidity",
        "pressure": "avg_pressure",
    }
    aggs = [rounded_mean(src, scale).alias(dst) for src, dst in measures.items()]
    aggs.append(F.max(F.col(flag_col).cast("int")).alias(flag_alias))
    return df.groupBy(F.col(key), F.to_date(F.col(time_col)).alias("date")).agg(*aggs)


def daily_min_max(
    df: DataFrame,
    key: str = "city",
    time_col: str = "weather_time_local",
    measure: str = "temperature",
    prefix: str = "temp",
    scale: int = 2,
) -> DataFrame:
    """Average, maximum and minimum of one measure per key and day."""
    return df.groupBy(F.col(key), F.to_date(F.col(time_col)).alias("date")).agg(
        rounded_mean(measure, scale).alias(f"avg_{prefix}"),
        F.max(measure).alias(f"max_{prefix}"),
        F.min(measure).alias(f"min_{prefix}"),
    )


def count_rows(df: DataFrame, alias: str = "n") -> DataFrame:
    """Global ``count(*)`` as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(alias))
