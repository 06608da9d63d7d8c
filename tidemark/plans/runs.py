"""End-to-end runs: forecast slots, observation load, and the full refresh of
staging, marts and the quality report.

Staging is written once and both marts read the written table, so the
dedup shuffle runs once per refresh. The models of a refresh are committed
together (``sources.versions``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timeshift import ntz_literal
from tidemark.operators.quality import declared_checks, range_checks, run_suite
from tidemark.operators.spine import hourly_slots, latest_hour_per_key
from tidemark.plans.marts import daily_average, report
from tidemark.plans.staging import staging
from tidemark.schemas import FORECAST_DAYS_AHEAD, RAW_COLUMNS
from tidemark.sources.payload import payload_rows, split_documents, split_rejects
from tidemark.sources.ledger import RawTable
from tidemark.sources.tables import prepare_append
from tidemark.sources.versions import Store


def forecast_slots(raw: DataFrame, days_ahead: int = FORECAST_DAYS_AHEAD,
                   cities: DataFrame | None = None, as_of=None) -> DataFrame:
    """Hourly slots (city, utc_offset, time).

    Without ``cities`` every city of ``raw`` starts from the hour of its newest row. With a list of
    cities (city, utc_offset) these get slots, whatever ``raw`` holds: the ones with readings
    from their newest row, the others, all of them on a first run, from ``as_of``.
    """
    newest = latest_hour_per_key(raw)
    if cities is None:
        return hourly_slots(newest, "_start", days_ahead, "time").drop("_start")
    if as_of is None:
        raise ValueError("cities without readings need as_of")
    seen = newest.select(F.col("city").alias("_c"), "_start")
    starts = cities.select("city", "utc_offset").join(seen, F.col("city") == F.col("_c"), "left") \
        .select("city", "utc_offset", F.coalesce("_start", ntz_literal(as_of)).alias("_start"))
    return hourly_slots(starts, "_start", days_ahead, "time").drop("_start")


def load_observations(parsed_payloads: DataFrame, id_base: int, text_col: str | None = None,
                      inserted_at=None, normalize_to_utc: bool = False
                      ) -> tuple[DataFrame, DataFrame]:
    """(raw rows, rejects) for a set of parsed reading documents.

    With ``text_col`` the rejects are whole documents with their text, else flat rows.
    """
    good, bad = accepted_rows(parsed_payloads, text_col, inserted_at, normalize_to_utc)
    return prepare_append(good, id_base, ["city", "time", "temperature"], is_forecast=False), bad


def accepted_rows(parsed_payloads: DataFrame, text_col: str | None = None, inserted_at=None,
                  normalize_to_utc: bool = False) -> tuple[DataFrame, DataFrame]:
    """(raw rows without ids, rejects)."""
    if text_col is not None:
        accepted, bad = split_documents(parsed_payloads, text_col)
        good = payload_rows(accepted, text_col, normalize_to_utc=normalize_to_utc)
    else:
        good, bad = split_rejects(payload_rows(parsed_payloads,
                                               normalize_to_utc=normalize_to_utc))
    if inserted_at is not None:
        good = good.withColumn("inserted_at", F.lit(str(inserted_at)).cast("timestamp_ntz"))
    return good, bad


def append_observations(table: RawTable, batch: str, parsed_payloads: DataFrame,
                        text_col: str | None = None, inserted_at=None,
                        normalize_to_utc: bool = False) -> DataFrame:
    """Append the accepted documents of a named batch to the raw table, with ids of their own;
    returns the rejects. A batch that is sent again adds nothing."""
    good, bad = accepted_rows(parsed_payloads, text_col, inserted_at, normalize_to_utc)
    table.append(batch, good, is_forecast=False)
    return bad


def refresh(spark: SparkSession, raw: DataFrame, out_dir: str, as_of=None,
            partition_daily: bool = True, fail_on_checks: bool = False) -> dict[str, str]:
    """Rebuild staging, report, daily rollup and the quality report in the store ``out_dir``.

    All four come into force in one commit, so readers see the models of one run together,
    and a run lost at any step leaves the last one's. Returns the folders of the new version;
    :func:`read_model` reads the newest. ``fail_on_checks`` raises after the commit if any check
    failed.
    """
    store = Store(spark, out_dir)
    stg = store.stage("stg_weather_data", staging(raw.select(*RAW_COLUMNS), as_of=as_of))
    kept = store.read_staged(stg)
    marts = {"weather_report": (report(kept), None),
             "daily_average": (daily_average(kept), ["date"] if partition_daily else None)}
    # the marts don't depend on each other: their jobs share the cluster
    with ThreadPoolExecutor(len(marts)) as pool:
        written = list(pool.map(lambda name: store.stage(
            name, marts[name][0], partition_by=marts[name][1]), marts))
    models = {s.table: store.read_staged(s) for s in written}
    quality = store.stage("quality", run_suite(spark, models, declared_checks() + range_checks()))
    version = store.publish([stg, *written, quality])
    if fail_on_checks:
        failed = store.read("quality", version).filter(~F.col("passed")).count()
        if failed:
            raise RuntimeError(f"{failed} quality checks failed, see {store.root}")
    return {name: store.folders(name, version)[0] for name in version.tables}


def read_model(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A model of the newest committed refresh."""
    return Store(spark, out_dir).read(name)
