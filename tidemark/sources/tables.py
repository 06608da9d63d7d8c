"""Table maintenance without MERGE: append, upsert, insert-if-absent and delete-by-key.

Parquet tables have no ``MERGE INTO``; every change is a DataFrame plan
(anti-join + union). ``sources.versions`` commits whole tables, and
``sources.keyed`` commits changes of single keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.timeshift import utc_now_ntz
from tidemark.schemas import RAW, RAW_COLUMNS
from tidemark.sources.ids import assign_ids


# -- pure DataFrame forms ----------------------------------------------------

def _first_of_key(incoming: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in ``order``; rows with a NULL in a key are all kept,
    as NULL equals nothing."""
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    first = incoming.filter(whole).withColumn("_rn", F.row_number().over(w)) \
        .filter(F.col("_rn") == 1).drop("_rn")
    return first.unionByName(incoming.filter(~whole))


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str],
           order_by: list | None = None) -> DataFrame:
    """Rows of ``incoming`` replace target rows with the same key; others are added.

    Of incoming rows that share a key the first in ``order_by`` counts (default: the
    largest in all columns). A NULL key matches nothing, so such rows are added.
    """
    order = order_by or [F.col(c).desc_nulls_last() for c in incoming.columns]
    one = _first_of_key(incoming, keys, order)
    kept = target.join(one.select(*keys), keys, "left_anti")
    return kept.unionByName(one.select(*target.columns))


def insert_if_absent(
    target: DataFrame, incoming: DataFrame, keys: list[str], order_by: list | None = None
) -> DataFrame:
    """``INSERT .. ON CONFLICT (keys) DO NOTHING``.

    Incoming rows whose key already exists are dropped; among incoming rows
    sharing a key the first in ``order_by`` (default: all columns ascending) is
    inserted. A NULL key never conflicts, so such rows are all inserted.
    """
    order = order_by or [F.col(c).asc_nulls_last() for c in incoming.columns]
    one = _first_of_key(incoming, keys, order)
    new_rows = one.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new_rows.select(*target.columns))


def delete_where_equal(df: DataFrame, column: str, value) -> DataFrame:
    """``DELETE .. WHERE column = value``: rows with NULL in ``column`` stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


# -- writers -------------------------------------------------------------------

def create_raw_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the raw schema and its defaults.

    The defaults (``inserted_at`` = now, ``is_forecast`` = TRUE) apply to SQL
    ``INSERT`` statements that omit the columns; DataFrame writers use
    :func:`stamp_defaults`.
    """
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {name} (
              id BIGINT, city STRING, temperature DOUBLE, weather_description STRING,
              wind_speed DOUBLE, humidity DOUBLE, pressure DOUBLE,
              time TIMESTAMP_NTZ,
              inserted_at TIMESTAMP_NTZ DEFAULT CAST(current_timestamp() AS TIMESTAMP_NTZ),
              utc_offset STRING, is_forecast BOOLEAN DEFAULT TRUE)
            USING parquet{loc}"""
    )


def stamp_defaults(df: DataFrame, is_forecast: bool | None = None) -> DataFrame:
    """Add absent default columns with literals (an explicit NULL stays NULL)."""
    spark = df.sparkSession
    out = df
    if "inserted_at" not in out.columns:
        out = out.withColumn("inserted_at", utc_now_ntz(spark))
    if "is_forecast" not in out.columns:
        out = out.withColumn("is_forecast", F.lit(True if is_forecast is None else is_forecast))
    elif is_forecast is not None:
        out = out.withColumn("is_forecast", F.lit(is_forecast))
    return out


def prepare_append(
    batch: DataFrame, id_base: int, order_cols: list[str], is_forecast: bool | None = None
) -> DataFrame:
    """Stamp defaults and ids on a batch so it matches the raw schema."""
    stamped = stamp_defaults(batch, is_forecast)
    with_ids = assign_ids(stamped, order_cols, "id", base=id_base)
    return with_ids.select(*[F.col(f.name).cast(f.dataType) for f in RAW.fields])


def current_max_id(df: DataFrame, id_col: str = "id") -> int:
    """The largest id in a table (0 if empty): a single scalar."""
    value = df.agg(F.max(id_col)).first()[0]
    return int(value or 0)


def append(df: DataFrame, path: str) -> None:
    df.select(*RAW_COLUMNS).write.mode("append").parquet(path)


def create_schema(spark: SparkSession, name: str) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` in the session's catalog."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def append_named(df: DataFrame, table: str) -> None:
    """Append raw rows to a catalog table, ``schema.table``; columns go by name."""
    df.select(*RAW_COLUMNS).write.mode("append").format("parquet").saveAsTable(table)
