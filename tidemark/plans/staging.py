"""Staging models: the current one (retention + latest-wins) and the legacy one
(first-wins on time only, newest k rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import literal_frame
from tidemark.functions.timeshift import offset_seconds, shift_by_seconds
from tidemark.operators.dedup import first_per_key, latest_per_key
from tidemark.operators.retention import retain
from tidemark.schemas import LEGACY_TOP_K, RETENTION_HOURS, STAGING_COLUMNS
from tidemark.sources.raw import scan_raw


OFFSET_TEXTS = 1000  # distinct offset texts that are parsed apart; any more are parsed row by row


def offset_dictionary(raw: DataFrame, offset_col: str, most: int = OFFSET_TEXTS
                      ) -> DataFrame | None:
    """(``_offset_text``, ``_offset_s``) of the distinct offset texts of a table.

    Runs a job over that one column. None for a stream, and where there are more than ``most``
    texts: the dictionary is broadcast, so its size is counted first.
    """
    if raw.isStreaming:
        return None
    texts = raw.select(offset_col).where(F.col(offset_col).isNotNull()).distinct() \
        .limit(most + 1).collect()
    if len(texts) > most:
        return None
    rows = literal_frame(raw.sparkSession, [(t[0],) for t in texts] or [("",)], ["_offset_text"])
    return rows.withColumn("_offset_s", offset_seconds("_offset_text"))


def with_local_time(raw: DataFrame, offset_col: str = "utc_offset") -> DataFrame:
    """``*`` plus the parsed offset (seconds) and ``time_local_tz``.

    Every distinct offset text is parsed once and joined back, so no fact row is parsed.
    """
    dictionary = offset_dictionary(raw, offset_col)
    if dictionary is None:
        parsed = raw.withColumn("_offset_s", offset_seconds(offset_col))
    else:
        parsed = raw.join(F.broadcast(dictionary),
                          raw[offset_col] == dictionary["_offset_text"], "left") \
            .drop("_offset_text")
    return parsed.withColumn("time_local_tz", shift_by_seconds("time", "_offset_s"))


def staging(raw: DataFrame, as_of=None, hours: int = RETENTION_HOURS) -> DataFrame:
    """Project, shift to local time, apply retention, then latest-wins per (city, time).

    Retention runs before the dedup, so an expired newest row never hides an
    older one that is kept.
    """
    local = with_local_time(scan_raw(raw))
    kept = retain(local, as_of=as_of, hours=hours)
    latest = latest_per_key(kept, ["city", "time"], "inserted_at", "id")
    return latest.select(
        "id", "city", "temperature", "weather_description", "wind_speed",
        "humidity", "pressure",
        F.col("time").alias("weather_time_utc"),
        F.col("time_local_tz").alias("weather_time_local"),
        shift_by_seconds("inserted_at", "_offset_s").alias("inserted_at_local"),
        "is_forecast",
    ).select(*STAGING_COLUMNS)


def staging_sorted(stg: DataFrame) -> DataFrame:
    """Read-time order of the staging model: city, then UTC slot time."""
    return stg.orderBy(F.col("city").asc_nulls_last(), F.col("weather_time_utc").asc_nulls_last())


def legacy_staging(raw: DataFrame, k: int = LEGACY_TOP_K) -> DataFrame:
    """First-wins per slot time (one city survives per timestamp), newest ``k`` rows.

    The time column is kept unshifted as ``weather_time_local``; ``k`` is a
    top-k with a total order (``inserted_at`` DESC NULLS FIRST, then id DESC).
    """
    first = first_per_key(raw.select("*"), ["time"], "inserted_at", "id")
    projected = first.select(
        "id", "city", "temperature", "weather_description", "wind_speed",
        F.col("time").alias("weather_time_local"),
        shift_by_seconds("inserted_at", offset_seconds("utc_offset")).alias("inserted_at_local"),
        "inserted_at",
    )
    top = projected.orderBy(F.col("inserted_at").desc_nulls_first(), F.col("id").desc_nulls_last())
    return top.limit(k).drop("inserted_at")
