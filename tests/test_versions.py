"""Versioned tables, keyed tables and the growing raw table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources import ledger, versions
from tidemark.sources import tables as tb
from tidemark.sources.keyed import NO_KEY, KeyedTable
from tidemark.sources.ledger import RawTable
from tidemark.sources.versions import Conflict, Store


def kv(spark, rows):
    return spark.createDataFrame(rows, "k INT, v STRING")


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_replace_reads_what_it_replaces_and_survives_a_failed_write(spark):
    store = Store(spark, scratch_path(spark, "store"))
    assert store.latest().number == 0 and store.read("t") is None
    store.replace("t", kv(spark, [(1, "a"), (2, "b")]))
    store.replace("t", tb.upsert(store.read("t"), kv(spark, [(2, "B")]), ["k"]))
    assert as_set(store.read("t")) == [(1, "a"), (2, "B")]
    broken = store.read("t").withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        store.replace("t", broken)
    assert as_set(store.read("t")) == [(1, "a"), (2, "B")] and store.latest().number == 2


def test_a_reader_keeps_its_version_until_it_is_released(spark):
    store = Store(spark, scratch_path(spark, "store"))
    first = store.replace("t", kv(spark, [(1, "a")]))
    held = store.read("t", first)
    store.replace("t", kv(spark, [(2, "b")]))
    store.replace("t", kv(spark, [(3, "c")]))
    assert as_set(held) == [(1, "a")] and as_set(store.read("t")) == [(3, "c")]
    store.release(keep=1)
    assert store.numbers() == [3] and as_set(store.read("t")) == [(3, "c")]
    with pytest.raises(Exception):
        store.read("t", first).collect()


def test_a_driver_lost_at_any_step_leaves_the_old_or_the_new_version(spark, monkeypatch):
    store = Store(spark, scratch_path(spark, "store"))
    store.replace("t", kv(spark, [(1, "a")]))
    staged = store.stage("t", kv(spark, [(2, "b")]))  # written, never committed
    assert as_set(Store(spark, store.root).read("t")) == [(1, "a")]

    class Lost:
        def rename(self, *_):
            raise OSError("lost")

    broken = Store(spark, store.root)
    broken._names = Lost()
    with pytest.raises(OSError):
        broken.commit([staged], broken.latest())
    assert as_set(Store(spark, store.root).read("t")) == [(1, "a")]
    store.commit([staged], store.latest())
    assert as_set(Store(spark, store.root).read("t")) == [(2, "b")]


def test_two_writers_of_one_version_conflict_and_publish_goes_after(spark):
    store, other = (Store(spark, r) for r in [scratch_path(spark, "store")] * 2)
    base = store.replace("t", kv(spark, [(1, "a")]))
    mine, theirs = store.stage("t", kv(spark, [(2, "b")])), other.stage("u", kv(spark, [(9, "z")]))
    store.commit([mine], base)
    with pytest.raises(Conflict):
        other.commit([theirs], base)
    assert other.publish([theirs]).number == 3
    assert as_set(store.read("t")) == [(2, "b")] and as_set(store.read("u")) == [(9, "z")]


def test_parts_are_replaced_dropped_and_taken_over(spark):
    store = Store(spark, scratch_path(spark, "store"))
    first = store.replace("t", kv(spark, [(1, "a"), (2, "b"), (3, "x y/%"), (None, "n")]), F.col("v"))
    assert set(first.parts("t")) == {"a", "b", "x y/%", "n"}
    staged = store.stage("t", kv(spark, [(7, "b"), (8, None)]), F.col("v"),
                         {"a", "b", versions.NULL_PART})
    version = store.commit([staged], first)
    assert as_set(store.read("t")) == as_set(kv(spark, [(7, "b"), (8, None), (3, "x y/%"), (None, "n")]))
    assert version.parts("t")["n"] == first.parts("t")["n"]  # not rewritten
    assert as_set(store.read("t", only={"b", "zz"})) == [(7, "b")]
    assert as_set(store.read("t", only=set())) == []


# -- keyed tables -----------------------------------------------------------------

def keyed(spark, rows, **kw):
    table = KeyedTable(spark, scratch_path(spark, "keyed"), ["k"], **kw)
    table.create(kv(spark, rows))
    return table


def test_changes_follow_the_plain_forms(spark):
    rows = [(k, f"v{k}") for k in range(40)] + [(None, "n"), (None, "m")]
    table = keyed(spark, rows, buckets=4)
    change = [(k, f"w{k}") for k in range(30, 50)] + [(35, "zz"), (None, "p"), (None, "p")]
    want = tb.upsert(kv(spark, rows), kv(spark, change), ["k"])
    table.upsert(kv(spark, change))
    assert as_set(table.read()) == as_set(want)
    more = [(k, f"x{k}") for k in range(45, 60)] + [(50, "aa"), (None, "q")]
    want = tb.insert_if_absent(want, kv(spark, more), ["k"])
    table.insert_if_absent(kv(spark, more))
    assert as_set(table.read()) == as_set(want)
    for value in ("w33", "p", "x51", "absent"):
        want = tb.delete_where_equal(want, "v", value)
        table.delete_where("v", value)
        assert as_set(table.read()) == as_set(want)
    table.insert_if_absent(kv(spark, [(33, "back"), (34, "no")]))
    table.insert_if_absent(kv(spark, [(33, "again")]))
    want = want.unionByName(kv(spark, [(33, "back")]))
    assert as_set(table.read()) == as_set(want)
    table.delete_keys(kv(spark, [(33, None), (None, None)]))
    want = want.where("k is null or k != 33")
    assert as_set(table.read()) == as_set(want)
    table.compact(least=1)
    assert as_set(table.read()) == as_set(want) and not table.deltas(table.store.latest())
    table.upsert(kv(spark, []))
    assert as_set(table.read()) == as_set(want)


def test_a_change_leaves_other_buckets_alone(spark):
    table = keyed(spark, [(k, "a") for k in range(200)], buckets=8)
    before = table.store.latest()
    after = table.upsert(kv(spark, [(5, "b"), (6, "c")]))
    assert after.parts("rows") == before.parts("rows")  # no base file is written anew
    changed = set(table.deltas(after))
    assert 1 <= len(changed) <= 2 and NO_KEY not in changed
    for _ in range(3):
        table.upsert(kv(spark, [(5, "d")]))
    done = table.compact(least=4)
    (bucket,) = {b for b, p in done.parts("rows").items() if p != before.parts("rows").get(b)}
    assert bucket in changed
    assert dict(as_set(table.read()))[5] == "d" and table.read().count() == 200


# -- the growing raw table ----------------------------------------------------------

def observed(spark, cities):
    rows = [(c, 1.0, "Clear", 2.0, 3.0, 4.0, dt.datetime(2026, 1, 1, k), "+0")
            for k, c in enumerate(cities)]
    return spark.createDataFrame(rows, "city STRING, temperature DOUBLE, weather_description STRING, "
                                       "wind_speed DOUBLE, humidity DOUBLE, pressure DOUBLE, "
                                       "time TIMESTAMP_NTZ, utc_offset STRING")


def test_batches_get_ids_of_their_own_and_replays_add_nothing(spark):
    table = RawTable(spark, scratch_path(spark, "raw"))
    assert table.read().count() == 0
    for batch, cities in (("a", "xyz"), ("b", "uv"), ("a", "xyz"), ("b", "uv")):
        table.append(batch, observed(spark, cities), is_forecast=False)
    got = sorted((r.id, r.city) for r in table.read().collect())
    assert got == [(1, "x"), (2, "y"), (3, "z"), (4, "u"), (5, "v")]
    table.fold()
    table.append("a", observed(spark, "xyz"))
    table.append("c", observed(spark, "w"))
    assert sorted(r.id for r in table.read().collect()) == [1, 2, 3, 4, 5, 6]
    table.append("empty", observed(spark, ""))
    assert table.read().count() == 6


def test_writers_from_one_state_get_different_ranges(spark, monkeypatch):
    root = scratch_path(spark, "raw")
    one, two = RawTable(spark, root), RawTable(spark, root)
    state = one.create()
    # the second writer still sees the state that the first one started from
    assert one.reserve("a", 10) == 1
    real, stale = two.store.latest, [state]
    monkeypatch.setattr(two.store, "latest", lambda: stale.pop() if stale else real())
    assert two.reserve("b", 5) == 11
    assert one.reserve("a", 10) == 1 and one.store.latest().notes["next"] == 16
    with pytest.raises(ValueError, match="had 10 rows"):
        one.reserve("a", 11)


def test_a_batch_lost_between_reservation_and_append_keeps_its_ids(spark, monkeypatch):
    table = RawTable(spark, scratch_path(spark, "raw"))
    real = ledger.Store.stage
    monkeypatch.setattr(ledger.Store, "stage", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.append("a", observed(spark, "xy"))
    monkeypatch.setattr(ledger.Store, "stage", real)
    table.append("b", observed(spark, "z"))
    table.append("a", observed(spark, "xy"))
    assert sorted((r.id, r.city) for r in table.read().collect()) == [(1, "x"), (2, "y"), (3, "z")]


def test_schema_and_table_are_created_and_written_by_name(spark):
    tb.create_schema(spark, "obs_test")
    name = "obs_test.raw_by_name"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tb.create_raw_table(spark, name)
    rows = tb.prepare_append(observed(spark, "ab"), 0, ["city", "time"])
    tb.append_named(rows, name)
    tb.append_named(tb.prepare_append(observed(spark, "c"), tb.current_max_id(spark.table(name)),
                                      ["city", "time"]), name)
    assert sorted((r.id, r.city) for r in spark.table(name).collect()) == [(1, "a"), (2, "b"), (3, "c")]
    tb.create_schema(spark, "obs_test")  # exists
    spark.sql(f"DROP TABLE {name}")
    spark.sql("DROP SCHEMA obs_test")
