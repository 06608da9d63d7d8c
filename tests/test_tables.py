import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir
from tidemark.sources import tables as tb
from tidemark.sources.ids import assign_ids


def kv(spark, rows):
    return spark.createDataFrame(rows, "k INT, v STRING")


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_replaces_and_adds(spark):
    out = tb.upsert(kv(spark, [(1, "a"), (2, "b")]), kv(spark, [(2, "B"), (3, "C")]), ["k"])
    assert as_set(out) == [(1, "a"), (2, "B"), (3, "C")]


def test_insert_if_absent_keeps_existing(spark):
    out = tb.insert_if_absent(kv(spark, [(1, "a"), (2, "b")]),
                              kv(spark, [(2, "B"), (3, "C"), (3, "D")]), ["k"])
    assert as_set(out) == [(1, "a"), (2, "b"), (3, "C")]


def test_delete_keeps_null_keys(spark):
    out = tb.delete_where_equal(kv(spark, [(1, "a"), (None, "n"), (2, "b")]), "k", 1)
    assert sorted(r.v for r in out.collect()) == ["b", "n"]


def test_ids_are_consecutive_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("x"))
    out = assign_ids(df, ["x"], "sid", base=100, num_partitions=6)
    got = sorted((r.x, r.sid) for r in out.collect())
    assert got == [(x, 101 + x) for x in range(5000)]


def test_create_table_defaults_and_append(spark, tmp_path):
    name = "raw_weather_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tb.create_raw_table(spark, name, str(tmp_path / "t"))
    spark.sql(f"INSERT INTO {name} (id, city, time, utc_offset) "
              "VALUES (1, 'London', TIMESTAMP_NTZ '2026-01-01 00:00:00', '+0')")
    row = spark.table(name).first()
    assert row.is_forecast is True and row.inserted_at is not None
    batch = spark.createDataFrame([("Paris", dt.datetime(2026, 1, 1, 1), "+1")],
                                  "city STRING, time TIMESTAMP_NTZ, utc_offset STRING")
    batch = batch.select("city", F.lit(1.0).alias("temperature"),
                         F.lit("Clear").alias("weather_description"),
                         F.lit(2.0).alias("wind_speed"), F.lit(3.0).alias("humidity"),
                         F.lit(1001.0).alias("pressure"), "time", "utc_offset")
    rows = tb.prepare_append(batch, tb.current_max_id(spark.table(name)), ["city", "time"])
    rows.write.insertInto(name)
    out = spark.table(name).orderBy("id").collect()
    assert [r.id for r in out] == [1, 2] and out[1].is_forecast is True
    spark.sql(f"DROP TABLE {name}")


def test_ids_are_distinct_without_exchange_reuse_and_with_a_hot_key(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(0, 20000).select(
            F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 7).alias("x"),
            F.col("id").alias("y"), F.create_map(F.lit("k"), F.col("id")).alias("m"))
        out = assign_ids(df, ["x"], "sid", num_partitions=6).cache()
        assert out.select("sid").distinct().count() == 20000
        assert out.agg(F.min("sid"), F.max("sid")).first() == (1, 20000)
        wrong = out.alias("a").join(out.alias("b"), F.col("a.sid") + 1 == F.col("b.sid")) \
            .filter("a.x > b.x or (a.x is not null and b.x is null)")
        assert wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_null_keys_never_conflict_and_duplicates_are_reduced(spark):
    target = kv(spark, [(1, "a"), (None, "n")])
    incoming = kv(spark, [(None, "p"), (None, "p"), (1, "b"), (1, "c"), (2, "d")])
    for got, one in ((tb.insert_if_absent(target, incoming, ["k"]), "a"),
                     (tb.upsert(target, incoming, ["k"]), "c")):
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(
            map(str, [(1, one), (2, "d"), (None, "n"), (None, "p"), (None, "p")]))


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
