"""Readings documents (nested JSON) to flat raw rows.

A landing folder of JSON documents is read in bulk with the declared payload
schema (no inference), or a string column is parsed with ``from_json``. Only
eight fields are kept. ``humidity`` and ``pressure`` default to 0 when the key
is absent; in exact mode an explicit JSON ``null`` stays NULL. With the document
text at hand, a document is rejected when a required key is absent, its slot time
can't be read or a number is no number; a required key that holds ``null`` is
accepted. Rejected documents keep their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import as_col
from tidemark.functions.timeshift import offset_seconds, seconds_interval
from tidemark.schemas import PAYLOAD_DDL

REQUIRED = ["city", "time", "utc_offset", "temperature", "wind_speed"]
LOCATION_KEYS = ["name", "localtime", "utc_offset"]
READING_KEYS = ["temperature", "weather_descriptions", "wind_speed"]
MEASURES = ["temperature", "wind_speed", "humidity", "pressure"]


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Bulk read of landed documents; one column per top-level field."""
    return spark.read.schema(PAYLOAD_DDL).option("mode", "PERMISSIVE").json(path)


def parse_payload(df: DataFrame, text_col: str = "payload") -> DataFrame:
    """Parse a JSON text column into the payload's top-level fields (the
    input columns are kept)."""
    parsed = F.from_json(F.col(text_col), PAYLOAD_DDL)
    return df.withColumn("_doc", parsed).select(*df.columns, "_doc.*")


def key_present(text_col, path: str, key: str) -> Column:
    """True when ``key`` exists in the object at JSON ``path`` (even if null)."""
    obj = F.get_json_object(as_col(text_col), path)
    return F.coalesce(F.array_contains(F.json_object_keys(obj), F.lit(key)), F.lit(False))


CURRENT_KEYS = "_current_keys"


def _default_when_missing(field: str, text_col: str | None) -> Column:
    value = F.col(f"current.{field}")
    if text_col is None:
        return F.coalesce(value, F.lit(0.0))
    present = F.coalesce(F.array_contains(F.col(CURRENT_KEYS), F.lit(field)), F.lit(False))
    return F.when(present, value).otherwise(F.lit(0.0))


def _slot_time(normalize_to_utc: bool) -> Column:
    local = F.try_to_timestamp(F.col("location.localtime"), F.lit("yyyy-MM-dd HH:mm")) \
        .cast("timestamp_ntz")
    if not normalize_to_utc:
        return local
    return local - seconds_interval(offset_seconds(F.col("location.utc_offset")))


def payload_rows(df: DataFrame, text_col: str | None = None, keep=(),
                 normalize_to_utc: bool = False) -> DataFrame:
    """Flatten parsed payloads to the raw columns (no id, no ``inserted_at``).

    ``text_col`` names the original JSON text; given, missing-key defaults are
    exact (absent -> 0, explicit null -> NULL); otherwise NULL also becomes 0.
    ``keep`` names input columns passed through in front.

    The document's ``localtime`` is already local. By default it is stored
    as is in ``time`` (so staging shifts it a second time, as the source
    pipeline does); ``normalize_to_utc=True`` subtracts the offset instead, so
    ``time`` holds UTC like the forecast rows.
    """
    if text_col is not None:
        # the keys of ``current`` are listed once per document, for every default
        df = df.withColumn(
            CURRENT_KEYS, F.json_object_keys(F.get_json_object(F.col(text_col), "$.current")))
    return df.select(
        *keep,
        F.col("location.name").alias("city"),
        F.col("current.temperature").cast("double").alias("temperature"),
        F.get(F.col("current.weather_descriptions"), 0).alias("weather_description"),
        F.col("current.wind_speed").cast("double").alias("wind_speed"),
        _default_when_missing("humidity", text_col).cast("double").alias("humidity"),
        _default_when_missing("pressure", text_col).cast("double").alias("pressure"),
        _slot_time(normalize_to_utc).alias("time"),
        F.col("location.utc_offset").alias("utc_offset"),
        F.lit(False).alias("is_forecast"),
    )


def _has_keys(text_col: str, path: str, keys: list[str]) -> Column:
    found = F.json_object_keys(F.get_json_object(F.col(text_col), path))
    wanted = F.array(*[F.lit(k) for k in keys])
    return F.coalesce(F.size(F.array_intersect(found, wanted)) == len(keys), F.lit(False))


def split_documents(parsed: DataFrame, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) parsed documents; both keep the columns of ``parsed``."""
    ok = _has_keys(text_col, "$.location", LOCATION_KEYS) \
        & _has_keys(text_col, "$.current", READING_KEYS) \
        & (F.col("location.localtime").isNull() | _slot_time(False).isNotNull())
    for name in MEASURES:
        written = F.get_json_object(F.col(text_col), f"$.current.{name}")
        ok = ok & (written.isNull() | F.col(f"current.{name}").isNotNull())
    ok = F.coalesce(ok, F.lit(False))
    return parsed.filter(ok), parsed.filter(~ok)


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) flat rows by their required fields, where the text isn't at hand."""
    ok = None
    for name in REQUIRED:
        cond = F.col(name).isNotNull()
        ok = cond if ok is None else ok & cond
    return rows.filter(ok), rows.filter(~ok)
