from tidemark.operators import quality as dq


def test_accepted_values_flags_outside_values_and_passes_null(spark):
    df = spark.createDataFrame([("Mist",), ("Clear",), (None,), ("Mist",)], "d STRING")
    out = dq.accepted_failures(df, "d", ["Clear", "Cloudy"]).collect()
    assert [(r.value, r.n_records) for r in out] == [("Mist", 2)]


def test_literal_accepted_values_vs_range(spark):
    df = spark.createDataFrame([(55.0,), (100.0,)], "h DOUBLE")
    lit = dq.accepted_failures(df, "h", [0, 100], where="h >= 0 AND h <= 100").collect()
    assert [r.value for r in lit] == [55.0]
    assert dq.range_failures(df, "h", 0, 100).count() == 0


def test_unique_ignores_null(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k INT")
    out = dq.unique_failures(df, "k").collect()
    assert [(r.k, r.n_records) for r in out] == [(1, 2)]


def test_declared_suite_shape():
    checks = dq.declared_checks()
    tests = [c.test for c in checks]
    assert len(checks) == 24
    assert tests.count("not_null") == 17 and tests.count("unique") == 1
    assert tests.count("accepted_values") == 6


def test_suite_counts(spark):
    rep = spark.createDataFrame(
        [(1, "London", "Mist", None), (1, "Paris", "Clear", 3.0), (2, None, "Mist", 30.0)],
        "id INT, city STRING, weather_description STRING, wind_speed DOUBLE")
    checks = [
        dq.Check("r", "unique", "id"),
        dq.Check("r", "not_null", "city"),
        dq.Check("r", "accepted_values", "weather_description", ("Clear",)),
        dq.Check("r", "not_null", "wind_speed"),
        dq.Check("r", "in_range", "wind_speed", low=0.0, high=25.0),
    ]
    out = {r.check_id: (r.n_failed, r.passed)
           for r in dq.run_suite(spark, {"r": rep}, checks).collect()}
    assert out == {1: (1, False), 2: (1, False), 3: (1, False), 4: (1, False), 5: (1, False)}


def test_null_counts_include_nan(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (None, None), (1.0, "b")], "x DOUBLE, s STRING")
    out = {r.column_name: (r.n_null, r.n_nan) for r in dq.null_counts(df).collect()}
    assert out == {"x": (1, 1), "s": (1, 0)}
