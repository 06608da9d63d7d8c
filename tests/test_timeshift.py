import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.timeshift import hour_floor, offset_seconds, shift_by_offset


def test_offset_shapes(spark):
    cases = [("+0", 0), ("-5", -18000), ("+5:30", 19800), ("-4.0", -14400),
             ("-3:30", -12600), ("+10", 36000), (" +8 ", 28800), ("+5.75", 20700)]
    df = spark.createDataFrame(cases, "o STRING, expected INT")
    got = df.select("expected", offset_seconds("o").cast("double").alias("s")).collect()
    for row in got:
        assert row.s == row.expected


def test_unparseable_and_null_offsets_give_null(spark):
    df = spark.createDataFrame([("abc",), (None,), ("",)], "o STRING")
    got = [r.s for r in df.select(offset_seconds("o").alias("s")).collect()]
    assert got == [None, None, None]


def test_shift_at_new_year(spark):
    start = dt.datetime(2026, 1, 1, 0, 0)
    df = spark.createDataFrame([(o,) for o in ["+0", "-5", "+5:30", "-4.0", "-3:30"]], "o STRING")
    df = df.withColumn("t", F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    got = [r.local for r in df.select(shift_by_offset("t", "o").alias("local")).collect()]
    assert got == [
        start,
        dt.datetime(2025, 12, 31, 19, 0),
        dt.datetime(2026, 1, 1, 5, 30),
        dt.datetime(2025, 12, 31, 20, 0),
        dt.datetime(2025, 12, 31, 20, 30),
    ]


def test_hour_floor_keeps_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 59, 59, 999999),)], "t TIMESTAMP_NTZ")
    out = df.select(hour_floor("t").alias("h"))
    assert dict(out.dtypes)["h"] == "timestamp_ntz"
    assert out.first().h == dt.datetime(2024, 3, 10, 2, 0)


def test_text_that_is_not_wholly_an_offset_gives_null(spark):
    odd = ["+5x", "+5:30:15", "+530", "12345678", "+24", "-99", "5:60", "+", ":30", "--5", "+5:", "1e1"]
    df = spark.createDataFrame([(o,) for o in odd], "o STRING")
    assert [r.o for r in df.filter(offset_seconds("o").isNotNull()).collect()] == []
    ok = spark.createDataFrame([("+23:59",), ("-0:30",)], "o STRING")
    assert [int(r.s) for r in ok.select(offset_seconds("o").alias("s")).collect()] == [86340, -1800]
