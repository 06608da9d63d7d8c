"""Incremental merges: order-free, replay-safe, equal to the batch result."""

import pytest

from conftest import SF001, raw_df

from tidemark.operators.dedup import latest_per_key
from tidemark.plans.catalog import AS_OF
from tidemark.plans.marts import daily_average
from tidemark.plans.staging import staging
from tidemark.session import scratch_path
from tidemark.sources.raw import observations
from tidemark.sources.versions import Store
from tidemark.streaming import daily_state
from tidemark.streaming.daily_state import read_daily, run_batch
from tidemark.streaming.incremental import merge_latest, merge_with_late, read_latest


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_merge_is_replay_safe_and_keeps_newest(spark):
    target = scratch_path(spark, "merge-test")
    first = raw_df(spark, [dict(id=1, inserted_at="2026-01-01 10:00:00"),
                           dict(id=2, city="Paris", inserted_at="2026-01-01 10:00:00")])
    second = raw_df(spark, [dict(id=3, inserted_at="2026-01-01 11:00:00"),
                            dict(id=4, city="Paris", inserted_at="2026-01-01 09:00:00")])
    merge_latest(first, target)
    merge_latest(second, target)
    assert ids(read_latest(spark, target)) == [2, 3]
    merge_latest(second, target)  # a replayed micro-batch
    assert ids(read_latest(spark, target)) == [2, 3]


def test_batches_in_any_order_equal_batch_dedup(spark):
    raw = observations(spark, SF001)
    target = scratch_path(spark, "merge-order")
    halves = raw.randomSplit([0.5, 0.5], seed=7)
    for part in reversed(halves):
        merge_latest(part, target)
    assert ids(read_latest(spark, target)) == ids(latest_per_key(raw))


def same(got, want):
    columns = want.columns
    return sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.collect()))


def test_refresh_batches_equal_batch_daily(spark):
    raw = observations(spark, SF001)
    root = scratch_path(spark, "rs")
    for part in raw.randomSplit([0.3, 0.3, 0.4], seed=3):
        run_batch(part, root, AS_OF)
    want = daily_average(staging(raw, as_of=AS_OF))
    assert read_daily(spark, root).count() == 275 and same(read_daily(spark, root), want)


def test_a_later_clock_expires_rows_and_shows_what_they_hid(spark):
    raw = observations(spark, SF001)
    root = scratch_path(spark, "expiry")
    parts = raw.randomSplit([0.4, 0.3, 0.3], seed=5)
    seen = None
    for part, as_of in zip(parts, ("2024-01-05 00:00:00", "2024-01-12 06:30:00", AS_OF)):
        run_batch(part, root, as_of)
        seen = part if seen is None else seen.unionByName(part)
        assert same(read_daily(spark, root), daily_average(staging(seen, as_of=as_of)))
        assert same(daily_state.visible(Store(spark, root)), staging(seen, as_of=as_of))
    # an older forecast comes back when the observation that hid it expires
    one = dict(city="Oslo", time="2026-01-01 00:00:00")
    rows = [dict(one, id=1, inserted_at="2026-01-01 01:00:00", is_forecast=True),
            dict(one, id=2, inserted_at="2026-01-01 02:00:00", is_forecast=False),
            dict(one, id=3, inserted_at="2026-01-01 03:00:00", is_forecast=False, utc_offset="-9")]
    root = scratch_path(spark, "expiry-2")
    run_batch(raw_df(spark, rows), root, "2026-01-01 01:00:00")
    none = raw_df(spark, [])
    for as_of, shown in (("2026-01-01 02:00:00", [3]), ("2026-01-01 04:00:00", [2]),
                         ("2026-01-01 20:00:00", [1])):
        run_batch(none, root, as_of)
        assert ids(daily_state.visible(Store(spark, root))) == shown
        assert ids(staging(raw_df(spark, rows), as_of=as_of)) == shown
    with pytest.raises(ValueError, match="went back"):
        run_batch(none, root, "2026-01-01 01:00:00")


def test_untouched_dates_are_not_opened(spark):
    root = scratch_path(spark, "untouched")
    rows = [dict(id=k, time=f"2026-01-0{k} 00:00:00") for k in range(1, 6)]
    before = run_batch(raw_df(spark, rows), root, "2026-01-02 00:00:00")
    after = run_batch(raw_df(spark, [dict(id=9, time="2026-01-03 05:00:00")]), root,
                      "2026-01-02 01:00:00")
    for table in ("retained", "daily"):
        moved = {p for p in after.parts(table) if after.parts(table)[p] != before.parts(table)[p]}
        assert moved == {"2026-01-03"}


def test_an_epoch_stopped_at_any_step_and_replayed_counts_once(spark, monkeypatch):
    raw = observations(spark, SF001)
    root = scratch_path(spark, "replay")
    halves = raw.randomSplit([0.5, 0.5], seed=11)
    run_batch(halves[0], root, "2024-01-10 00:00:00", stream="s", epoch=0)
    first = read_daily(spark, root).collect()
    steps = ("stage retained", "stage daily", "commit")
    for stop in steps:
        def lost(self, table, *a, real=Store.stage, **k):
            staged = real(self, table, *a, **k)
            if stop == f"stage {table}":
                raise OSError("lost")
            return staged

        def refused(self, *a, real=Store.commit, **k):
            if stop == "commit":
                raise OSError("lost")
            return real(self, *a, **k)

        with monkeypatch.context() as m:
            m.setattr(Store, "stage", lost)
            m.setattr(Store, "commit", refused)
            with pytest.raises(OSError):
                run_batch(halves[1], root, AS_OF, stream="s", epoch=1)
        assert sorted(map(str, read_daily(spark, root).collect())) == sorted(map(str, first))
    for _ in range(2):  # the second time it finds itself done
        version = run_batch(halves[1], root, AS_OF, stream="s", epoch=1)
    assert version.number == 2
    assert same(read_daily(spark, root), daily_average(staging(raw, as_of=AS_OF)))


def test_a_stopped_merge_loses_no_row(spark, monkeypatch):
    target = scratch_path(spark, "merge-stop")
    merge_latest(raw_df(spark, [dict(id=1), dict(id=2, city="Paris")]), target, epoch=0)
    more = raw_df(spark, [dict(id=3, inserted_at="2026-01-01 11:00:00")])
    with monkeypatch.context() as m:
        m.setattr(Store, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            merge_latest(more, target, epoch=1)
    assert ids(read_latest(spark, target)) == [1, 2]
    for _ in range(2):
        merge_latest(more, target, epoch=1)
    assert ids(read_latest(spark, target)) == [2, 3] and Store(spark, target).latest().number == 2


def test_days_with_nan_take_the_average_of_doubles(spark):
    root = scratch_path(spark, "nan")
    rows = [dict(id=1, temperature=float("nan")), dict(id=2, city="Paris", temperature=None),
            dict(id=3, city="Rome", temperature=1.005)]
    run_batch(raw_df(spark, rows), root, "2026-01-01 00:00:00")
    want = daily_average(staging(raw_df(spark, rows), as_of="2026-01-01 00:00:00"))
    assert same(read_daily(spark, root), want)
    run_batch(raw_df(spark, [dict(id=4, temperature=2.0, inserted_at="2026-01-01 05:00:00")]), root,
              "2026-01-01 00:00:00")
    assert {r.avg_temperature for r in read_daily(spark, root).collect()} == {2.0, None, 1.01}


def test_late_rows_are_kept_and_counted(spark):
    root = scratch_path(spark, "late")
    batches = [[dict(id=1, inserted_at="2026-01-03 00:10:00")],
               [dict(id=2, city="Paris", inserted_at="2026-01-02 11:59:00"),
                dict(id=3, city="Tokyo", inserted_at="2026-01-02 12:01:00"),
                dict(id=4, city="Rome", inserted_at=None)],
               [dict(id=5, city="Oslo", inserted_at="2026-01-02 00:00:00")]]
    for epoch, rows in enumerate(batches):
        for _ in range(2):
            version = merge_with_late(raw_df(spark, rows), root, epoch=epoch)
    store = Store(spark, root)
    assert ids(store.read("latest")) == [1, 3, 4] and ids(store.read("late")) == [2, 5]
    assert version.notes["late_total"] == 2 and version.notes["late"] == 1


def _land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_ingest_restart_is_exactly_once(spark):
    from tidemark.schemas import RAW
    from tidemark.streaming.incremental import ingest, read_landing

    landing, target, ckpt = (scratch_path(spark, n) for n in ("land", "tgt", "ck"))
    _land(raw_df(spark, [dict(id=1), dict(id=2, city="Paris")]), landing)
    for _ in range(2):  # second run restarts from the same checkpoint
        q = ingest(read_landing(spark, landing, RAW), target, ckpt)
        q.awaitTermination(600)
    assert ids(spark.read.parquet(target)) == [1, 2]
    _land(raw_df(spark, [dict(id=3, city="Tokyo")]), landing)
    ingest(read_landing(spark, landing, RAW), target, ckpt).awaitTermination(600)
    assert ids(spark.read.parquet(target)) == [1, 2, 3]


def test_watermarked_form_drops_rows_later_than_the_delay(spark):
    from tidemark.schemas import RAW
    from tidemark.streaming.incremental import read_landing, run_windowed_latest

    landing, target, ckpt = (scratch_path(spark, n) for n in ("wland", "wtgt", "wck"))
    _land(raw_df(spark, [dict(id=1, time="2026-01-03 00:00:00",
                              inserted_at="2026-01-03 00:10:00")]), landing)
    q = run_windowed_latest(read_landing(spark, landing, RAW, max_files_per_trigger=1),
                            target, ckpt)
    q.awaitTermination(600)
    # two days behind the newest arrival: beyond the 12-hour watermark
    _land(raw_df(spark, [dict(id=2, city="Paris", time="2026-01-01 00:00:00",
                              inserted_at="2026-01-01 00:10:00")]), landing)
    # within the delay: kept
    _land(raw_df(spark, [dict(id=3, city="Tokyo", time="2026-01-02 20:00:00",
                              inserted_at="2026-01-02 20:10:00")]), landing)
    q = run_windowed_latest(read_landing(spark, landing, RAW, max_files_per_trigger=1),
                            target, ckpt)
    q.awaitTermination(600)
    assert ids(read_latest(spark, target)) == [1, 3]


def test_merge_keeps_rows_without_slot_time(spark):
    target = scratch_path(spark, "merge-null")
    merge_latest(raw_df(spark, [dict(id=1, time=None), dict(id=2)]), target)
    merge_latest(raw_df(spark, [dict(id=3, city="Paris", time=None)]), target)
    assert ids(read_latest(spark, target)) == [1, 2, 3]


def test_refresh_with_empty_first_batch_changed_and_null_offsets(spark):
    root = scratch_path(spark, "ro")
    as_of = "2026-01-02 00:00:00"
    expired = [dict(id=1, time="2020-01-01 00:00:00", is_forecast=False, utc_offset="+0")]
    first = [dict(id=2, city="Toronto", time="2026-01-02 02:00:00", utc_offset="-5"),
             dict(id=3, city="Oslo", time="2026-01-02 02:00:00", utc_offset=None)]
    second = [dict(id=4, city="Toronto", time="2026-01-02 02:00:00", utc_offset="+1.0",
                   inserted_at="2026-01-01 05:00:00"),
              dict(id=5, city="Rome", time=None, utc_offset="+1")]
    seen = []
    for rows in (expired, first, second):
        run_batch(raw_df(spark, rows), root, as_of)
        seen += rows
    want = daily_average(staging(raw_df(spark, seen), as_of=as_of))
    got = read_daily(spark, root).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == 3
