import math
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import functions as F

from tidemark.functions.means import rounded_mean


def mean_of(spark, values, scale=2):
    df = spark.createDataFrame([(1, v) for v in values], "g INT, x DOUBLE")
    return df.groupBy("g").agg(rounded_mean("x", scale).alias("m")).first().m


def test_half_cent_rounds_away_from_zero(spark):
    assert mean_of(spark, [2.675]) == 2.68
    assert mean_of(spark, [-2.675]) == -2.68
    assert mean_of(spark, [2.67, 2.68]) == 2.68
    assert mean_of(spark, [-2.67, -2.68]) == -2.68
    assert mean_of(spark, [0.001, 0.004]) == 0.0


def test_nulls_ignored_and_all_null_group_is_null(spark):
    assert mean_of(spark, [1.0, None, 2.0]) == 1.5
    df = spark.createDataFrame([(1, None), (1, None)], "g INT, x DOUBLE")
    out = df.groupBy("g").agg(rounded_mean("x").alias("m")).collect()
    assert len(out) == 1 and out[0].m is None


def test_nan_propagates(spark):
    assert math.isnan(mean_of(spark, [1.0, float("nan")]))


def test_independent_of_partitioning(spark):
    values = [i * 0.005 for i in range(1, 2001)]
    df = spark.createDataFrame([(1, v) for v in values], "g INT, x DOUBLE")
    a = df.repartition(1).groupBy("g").agg(rounded_mean("x").alias("m")).first().m
    b = df.repartition(7).groupBy("g").agg(rounded_mean("x").alias("m")).first().m
    assert a == b


def test_mixed_flags_give_one(spark):
    df = spark.createDataFrame([(1, True), (1, False)], "g INT, f BOOLEAN")
    assert df.groupBy("g").agg(F.max(F.col("f").cast("int")).alias("m")).first().m == 1


def test_one_rounding_and_no_cut_of_inputs(spark):
    assert mean_of(spark, [1.00496]) == 1.0
    assert mean_of(spark, [-2.00497]) == -2.0
    assert mean_of(spark, [1.00499999999]) == 1.0
    assert mean_of(spark, [1.005, 1.0049999]) == 1.0
    assert mean_of(spark, [1e14 + 0.5, 1e14]) == 1e14 + 0.25
    assert mean_of(spark, [1e300, 1.0]) == 5e299
    assert mean_of(spark, [1 / 3, -1 / 3, 0.0]) == 0.0


def slow_mean(values):
    total = sum(Decimal(repr(v)).quantize(Decimal("1e-16"), rounding=ROUND_HALF_UP) for v in values)
    return float((total / len(values)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def test_means_are_those_of_decimals(spark):
    rng = random.Random(4)
    groups = [[rng.choice([-1, 1]) * rng.random() * 10 ** rng.randrange(-4, 17) for _ in range(n)]
              for n in (1, 2, 3, 7, 8, 40) for _ in range(6)]
    groups += [[0.125, -0.125], [-0.005], [0.005], [-0.015, 0.005], [9e19, -9e19, 0.01], [-9e19] * 3,
               [3.8549999999999995, 3.8550000000000004], [0.40199999999999997, 0.398, 0.4049999999999999]]
    rows = [(g, v) for g, values in enumerate(groups) for v in values]
    with localcontext() as context:
        context.prec = 80
        want = [slow_mean(values) for values in groups]
    got = spark.createDataFrame(rows, "g INT, x DOUBLE").repartition(5).groupBy("g").agg(
        rounded_mean("x").alias("m")).orderBy("g").collect()
    assert [r.m for r in got] == want


def test_large_sums_neither_fail_nor_switch(spark):
    big = spark.range(14_000_000).select((F.col("id") * 0 + F.lit(9e14)).alias("x"))
    assert big.agg(rounded_mean("x").alias("m")).first().m == 9e14
    half = spark.range(4_000_000).select(F.lit(1e15 + 0.5).alias("x"))
    assert half.agg(rounded_mean("x").alias("m")).first().m == 1e15 + 0.5
    mixed = spark.range(2_000_000).select(F.when(F.col("id") == 0, F.lit(2e15)).otherwise(F.lit(0.01)).alias("x"))
    exact = (Decimal(2 * 10 ** 15) + Decimal("0.01") * 1_999_999) / 2_000_000
    assert mixed.agg(rounded_mean("x").alias("m")).first().m == float(round(exact, 2))
