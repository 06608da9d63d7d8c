"""End-to-end: observation load (documents -> raw rows) and the written refresh."""

import datetime as dt
import json

import pytest

from pyspark.sql import functions as F

from conftest import SF001, raw_df
from tidemark.plans.catalog import AS_OF
from tidemark.plans.marts import daily_average
from tidemark.plans.runs import forecast_slots, load_observations, read_model, refresh
from tidemark.plans.staging import staging
from tidemark.session import scratch_path
from tidemark.sources.payload import parse_payload
from tidemark.sources.raw import city_dim, observations
from tidemark.sources.versions import Store

MODELS = ["stg_weather_data", "weather_report", "daily_average", "quality"]


def test_observation_load_assigns_ids_after_base_and_rejects(spark):
    docs = [
        {"location": {"name": "Paris", "localtime": "2026-01-01 10:00", "utc_offset": "+1"},
         "current": {"temperature": 3, "weather_descriptions": ["Clear"], "wind_speed": 4}},
        {"location": {"name": "Oslo", "localtime": "2026-01-01 10:00", "utc_offset": "+1"},
         "current": {"weather_descriptions": [], "wind_speed": 4}},
    ]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "payload STRING")
    rows, rejected = load_observations(parse_payload(df), id_base=41, text_col="payload",
                                       inserted_at="2026-01-01 10:05:00")
    (row,) = rows.collect()
    assert row.id == 42 and row.city == "Paris" and row.is_forecast is False
    assert row.humidity == 0.0 and row.pressure == 0.0
    (doc,) = rejected.collect()
    assert doc.location.name == "Oslo" and json.loads(doc.payload) == docs[1]


def test_forecast_slots_one_row_per_city(spark):
    raw = raw_df(spark, [
        dict(id=1, city="Tokyo", utc_offset="+9", inserted_at="2026-01-01 09:42:00"),
        dict(id=2, city="Tokyo", utc_offset="+9.0", inserted_at="2026-01-01 10:42:00")])
    rows = forecast_slots(raw, days_ahead=2).orderBy("time").collect()
    assert len(rows) == 48 and {r.utc_offset for r in rows} == {"+9.0"}
    assert str(rows[0].time) == "2026-01-01 10:00:00" and str(rows[-1].time) == "2026-01-03 09:00:00"


def test_listed_cities_get_slots_on_a_first_run(spark):
    empty = raw_df(spark, [])
    slots = forecast_slots(empty, cities=city_dim(spark), as_of="2026-01-01 10:42:00")
    assert slots.columns == ["city", "utc_offset", "time"] and slots.count() == 1680
    assert str(slots.agg(F.min("time")).first()[0]) == "2026-01-01 10:00:00"
    raw = raw_df(spark, [dict(id=1, city="Tokyo", utc_offset="+9.0", inserted_at="2026-01-02 09:42:00")])
    starts = forecast_slots(raw, cities=city_dim(spark), as_of="2026-01-01 10:42:00").groupBy(
        "city", "utc_offset").agg(F.min("time").alias("t")).collect()
    assert {r.city: (r.utc_offset, str(r.t)) for r in starts}["Tokyo"] == ("+9", "2026-01-02 09:00:00")
    assert len(starts) == 10 and len({str(r.t) for r in starts}) == 2
    with pytest.raises(ValueError):
        forecast_slots(raw, cities=city_dim(spark))


def test_a_refresh_shows_all_models_of_one_run(spark, monkeypatch):
    """A run lost before its commit leaves the models of the last one."""
    raw = observations(spark, SF001)
    out = scratch_path(spark, "refresh-lost")
    refresh(spark, raw, out, as_of="2024-01-05 12:00:00")
    before = {m: read_model(spark, out, m).count() for m in MODELS}
    with monkeypatch.context() as m:
        m.setattr(Store, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            refresh(spark, raw, out, as_of=AS_OF)
    assert {m: read_model(spark, out, m).count() for m in MODELS} == before
    held = {m: read_model(spark, out, m) for m in MODELS}  # a reader during the next run
    refresh(spark, raw, out, as_of=AS_OF)
    assert {m: held[m].count() for m in MODELS} == before
    assert read_model(spark, out, "daily_average").count() == 275 != before["daily_average"]


def test_second_refresh_replaces_the_first(spark):
    raw = observations(spark, SF001)
    out = scratch_path(spark, "refresh-twice")
    refresh(spark, raw, out, as_of="2024-01-05 12:00:00")
    paths = refresh(spark, raw, out, as_of=AS_OF)
    want = daily_average(staging(raw, as_of=AS_OF))
    got = spark.read.parquet(paths["daily_average"])
    assert got.count() == want.count()
    assert got.select(want.columns).exceptAll(want).count() == 0


def test_failed_checks_fail_the_refresh_when_asked(spark):
    raw = observations(spark, SF001)
    with pytest.raises(RuntimeError, match="quality checks failed"):
        refresh(spark, raw, scratch_path(spark, "refresh-gate"), as_of=AS_OF, fail_on_checks=True)


def test_wall_clock_staging_in_another_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        now = dt.datetime.now(dt.UTC).replace(tzinfo=None, microsecond=0)
        rows = [dict(id=k, time=(now - dt.timedelta(hours=h)).isoformat(), is_forecast=False,
                     utc_offset="+0") for k, h in ((1, 1), (2, 11), (3, 13), (4, 16))]
        got = sorted(r.id for r in staging(raw_df(spark, rows)).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [1, 2]


def test_refresh_writes_all_models(spark):
    raw = observations(spark, SF001)
    paths = refresh(spark, raw, scratch_path(spark, "refresh-test"), as_of=AS_OF)
    assert spark.read.parquet(paths["stg_weather_data"]).count() == 799
    assert spark.read.parquet(paths["weather_report"]).count() == 799
    daily = spark.read.parquet(paths["daily_average"])
    assert daily.count() == 275
    expected = daily_average(staging(raw, as_of=AS_OF))
    assert daily.select(expected.columns).exceptAll(expected).count() == 0
    quality = spark.read.parquet(paths["quality"])
    assert quality.count() == 30
    failed = {r.column_name for r in quality.filter(~F.col("passed")).collect()}
    assert "weather_description" in failed  # event types are not weather descriptions
