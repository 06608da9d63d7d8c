"""Raw observation tables: scans, the city dimension and the events view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import literal_frame
from tidemark.functions.timeshift import hour_floor
from tidemark.schemas import CITY_UTC_OFFSETS, RAW_COLUMNS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables, ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def city_dim(spark: SparkSession) -> DataFrame:
    """The 10-row city dimension: ``k`` (position), ``city``, ``utc_offset``.

    Its size is fixed by the constant list, so it is always safe to broadcast.
    """
    rows = [(k, city, offset) for k, (city, offset) in enumerate(CITY_UTC_OFFSETS)]
    return literal_frame(spark, rows, ["k", "city", "utc_offset"])


def scan_raw(df: DataFrame) -> DataFrame:
    """Explicit 11-column projection of a raw table (pruned at the scan)."""
    return df.select(*RAW_COLUMNS)


def scan_wildcard(df: DataFrame) -> DataFrame:
    """``SELECT *`` of a table."""
    return df.select("*")


def observations_from_events(events: DataFrame, cities: DataFrame) -> DataFrame:
    """Raw observation rows derived from the ``events`` table.

    City and offset come from the city dimension at position ``user_id % 10``
    (a broadcast hash join on a 10-row side); measures are taken from
    ``value``; the slot time is the hour of ``ts``; error events are the
    observed (non-forecast) rows.
    """
    n_cities = len(CITY_UTC_OFFSETS)
    ev = events.select("event_id", "ts", "user_id", "event_type", "value")
    joined = ev.join(F.broadcast(cities), (ev["user_id"] % n_cities) == cities["k"], "inner")
    return joined.select(
        F.col("event_id").alias("id"),
        F.col("city"),
        F.col("value").alias("temperature"),
        F.col("event_type").alias("weather_description"),
        (F.col("value") / 10).alias("wind_speed"),
        (F.col("value") * 2).alias("humidity"),
        (F.lit(1000) + F.col("value")).alias("pressure"),
        hour_floor("ts").alias("time"),
        F.col("ts").alias("inserted_at"),
        F.col("utc_offset"),
        (F.col("event_type") != F.lit("error")).alias("is_forecast"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw observation table for a driver data directory."""
    return observations_from_events(read_table(spark, sf_dir, "events"), city_dim(spark))
