import datetime as dt

from conftest import raw_df

from tidemark.operators.dedup import first_per_key, latest_by_aggregate, latest_per_key
from tidemark.plans.marts import daily_average
from tidemark.plans.staging import legacy_staging, staging

AS_OF = "2026-01-01 12:00:00"  # cutoff 2026-01-01 00:00:00


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_newest_wins(spark):
    df = raw_df(spark, [dict(id=1, inserted_at="2026-01-01 10:00:00"),
                        dict(id=2, inserted_at="2026-01-01 11:00:00")])
    assert ids(latest_per_key(df)) == [2]


def test_tie_goes_to_larger_id(spark):
    df = raw_df(spark, [dict(id=1), dict(id=2)])
    assert ids(latest_per_key(df)) == [2]


def test_null_inserted_at_wins_latest(spark):
    df = raw_df(spark, [dict(id=1, inserted_at=None), dict(id=2, inserted_at="2026-01-01 11:00:00")])
    assert ids(latest_per_key(df)) == [1]
    assert ids(latest_by_aggregate(df)) == [1]


def test_first_wins_null_loses(spark):
    df = raw_df(spark, [dict(id=1, inserted_at=None), dict(id=2, inserted_at="2026-01-01 11:00:00")])
    assert ids(first_per_key(df)) == [2]


def test_first_wins_on_time_only(spark):
    df = raw_df(spark, [dict(id=1, city="Paris", inserted_at="2026-01-01 09:00:00"),
                        dict(id=2, city="Tokyo", inserted_at="2026-01-01 08:00:00")])
    assert ids(first_per_key(df)) == [2]


def test_null_flag_dropped(spark):
    df = raw_df(spark, [dict(id=1, is_forecast=None)])
    assert staging(df, as_of=AS_OF).count() == 0


def test_null_offset_forecast_kept_with_null_local(spark):
    df = raw_df(spark, [dict(id=1, utc_offset=None, is_forecast=True)])
    row = staging(df, as_of=AS_OF).first()
    assert row.id == 1 and row.weather_time_local is None and row.inserted_at_local is None


def test_null_offset_observed_dropped(spark):
    df = raw_df(spark, [dict(id=1, utc_offset=None, is_forecast=False)])
    assert staging(df, as_of=AS_OF).count() == 0


def test_cutoff_is_strict(spark):
    df = raw_df(spark, [
        dict(id=1, is_forecast=False, time="2026-01-01 00:00:00"),
        dict(id=2, is_forecast=False, time="2026-01-01 01:00:00"),
    ])
    assert ids(staging(df, as_of=AS_OF)) == [2]


def test_cutoff_compares_local_time(spark):
    # 23:00 UTC is 08:00 next day in Tokyo: kept; same slot in New York is 18:00: dropped
    df = raw_df(spark, [
        dict(id=1, city="Tokyo", utc_offset="+9", is_forecast=False, time="2025-12-31 23:00:00"),
        dict(id=2, city="New York", utc_offset="-5", is_forecast=False,
             time="2025-12-31 23:00:00"),
    ])
    assert ids(staging(df, as_of=AS_OF)) == [1]


def test_filter_runs_before_dedup(spark):
    df = raw_df(spark, [
        dict(id=1, is_forecast=True, time="2025-12-30 00:00:00", inserted_at="2025-12-29 00:00:00"),
        dict(id=2, is_forecast=False, time="2025-12-30 00:00:00", inserted_at="2025-12-30 00:00:00"),
    ])
    assert ids(staging(df, as_of=AS_OF)) == [1]


def test_day_boundary_groups_under_next_local_date(spark):
    df = raw_df(spark, [dict(id=1, city="Tokyo", utc_offset="+9", time="2026-01-01 20:00:00")])
    row = daily_average(staging(df, as_of=AS_OF)).first()
    assert row.date == dt.date(2026, 1, 2)


def test_staging_columns(spark):
    df = raw_df(spark, [dict(id=1)])
    out = staging(df, as_of=AS_OF)
    assert out.columns == ["id", "city", "temperature", "weather_description", "wind_speed",
                           "humidity", "pressure", "weather_time_utc", "weather_time_local",
                           "inserted_at_local", "is_forecast"]
    assert dict(out.dtypes)["weather_time_local"] == "timestamp_ntz"


def test_legacy_top_k_order(spark):
    rows = [dict(id=i, time=f"2026-01-01 {i:02d}:00:00", inserted_at=f"2026-01-02 {i:02d}:00:00")
            for i in range(10)]
    out = legacy_staging(raw_df(spark, rows), k=3).collect()
    assert [r.id for r in out] == [9, 8, 7]
