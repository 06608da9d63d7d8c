"""Data-quality checks and a one-row-per-check suite report.

Semantics follow the usual column-test conventions: a check is a query that
returns failing rows; ``not_null`` returns the NULL rows, ``unique`` returns
one row per duplicated value, ``accepted_values`` returns one row per
distinct value outside the list (NULL passes both), an optional ``where``
restricts the rows tested. ``in_range`` counts non-NULL rows outside
``[low, high]``.

The suite evaluates all checks of one table in a single pass: each row emits one small record
per check it fails. Records are pre-aggregated, shuffled on (check, value) and, one row per
value, on the check.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import literal_frame
from tidemark.schemas import CITIES, DOCUMENTED_RANGES, WEATHER_DESCRIPTIONS


@dataclass(frozen=True)
class Check:
    model: str
    test: str  # not_null | unique | accepted_values | in_range
    column: str
    values: tuple = ()
    where: str | None = None
    low: float | None = None
    high: float | None = None


# -- single checks (each returns the failing rows) ----------------------------

def unique_failures(df: DataFrame, columns: list[str] | str) -> DataFrame:
    """Duplicated keys with their row counts (``group by .. having count(*) > 1``)."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    not_null = None
    for c in cols:
        cond = F.col(c).isNotNull()
        not_null = cond if not_null is None else not_null & cond
    return (
        df.filter(not_null)
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def _outside(column: str, values) -> F.Column:
    c = F.col(column)
    return c.isNotNull() & ~c.isin(list(values))


def accepted_failures(
    df: DataFrame, column: str, values, where: str | None = None
) -> DataFrame:
    """Distinct values outside ``values`` with their row counts."""
    rows = df.filter(F.expr(where)) if where else df
    return (
        rows.filter(_outside(column, values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def range_failures(df: DataFrame, column: str, low, high) -> DataFrame:
    c = F.col(column)
    return df.filter(c.isNotNull() & ~c.between(low, high))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One pass over ``df``: ``(column_name, n_null, n_nan)`` per column."""
    columns = columns or df.columns
    types = dict(df.dtypes)
    aggs = []
    for c in columns:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n_null__{c}"))
        if types[c] in ("double", "float"):
            aggs.append(F.count_if(F.isnan(F.col(c))).alias(f"n_nan__{c}"))
        else:
            aggs.append(F.lit(0).cast("long").alias(f"n_nan__{c}"))
    one = df.agg(*aggs)
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n_null__{c}").alias("n_null"),
            F.col(f"n_nan__{c}").alias("n_nan"),
        )
        for c in columns
    ]
    return one.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


# -- suite ---------------------------------------------------------------------

def _check_label(check: Check) -> str:
    return check.test


def _check_records(df: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    """All checks of one table in one pass.

    Each row emits a ``(check_id, value)`` record per check it fails (every
    non-NULL row for ``unique``); records are grouped on ``(check_id, value)``
    with map-side partial aggregation, so a hot value collapses before the
    shuffle. Per check this gives failing rows (not_null, in_range), distinct
    failing values (accepted_values) or duplicated values (unique).
    """
    items = []
    for idx, ch in checks:
        c = F.col(ch.column)
        value = F.lit(None).cast("string")
        if ch.test == "not_null":
            failing = c.isNull()
        elif ch.test == "in_range":
            failing = c.isNotNull() & ~c.between(ch.low, ch.high)
        elif ch.test == "accepted_values":
            failing, value = _outside(ch.column, ch.values), c.cast("string")
        elif ch.test == "unique":
            failing, value = c.isNotNull(), c.cast("string")
        else:
            raise ValueError(f"unknown test {ch.test}")
        if ch.where:
            failing = F.expr(ch.where) & failing
        items.append(F.when(failing, F.struct(F.lit(idx).alias("check_id"), value.alias("value"))))
    grouped = (
        df.select(F.explode(F.array_compact(F.array(*items))).alias("f"))
        .select("f.check_id", "f.value")
        .groupBy("check_id", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return grouped.groupBy("check_id").agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("groups"),
        F.count_if(F.col("n") > 1).alias("dup_groups"),
    )


def run_suite(spark: SparkSession, models: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check: ``check_id, model, test, column_name, n_failed, passed``."""
    indexed = list(enumerate(checks, start=1))
    results = None
    for model, df in models.items():
        mine = [(i, ch) for i, ch in indexed if ch.model == model]
        if mine:
            part = _check_records(df, mine)
            results = part if results is None else results.unionByName(part)
    # the check list is fixed by the code: a literal frame of len(checks) rows
    catalog = literal_frame(
        spark, [(i, ch.model, _check_label(ch), ch.column) for i, ch in indexed],
        ["check_id", "model", "test", "column_name"],
    )
    joined = catalog.join(F.broadcast(results.withColumnRenamed("check_id", "_cid")),
                          F.col("check_id") == F.col("_cid"), "left")
    test = F.col("test")
    raw_n = (F.when(test == "accepted_values", F.col("groups"))
             .when(test == "unique", F.col("dup_groups"))
             .otherwise(F.col("rows")))
    n_failed = F.coalesce(raw_n, F.lit(0)).cast("long")
    return joined.select(
        "check_id", "model", "test", "column_name",
        n_failed.alias("n_failed"), (n_failed == 0).alias("passed"),
    )


# -- the declared checks of the two marts -------------------------------------
# Columns, tests and bounds must equal the source pipeline's, kept in its order.

def report_checks() -> list[Check]:
    m = "weather_report"
    out = [Check(m, "unique", "id"), Check(m, "not_null", "id")]
    out += [Check(m, "not_null", "city"), Check(m, "accepted_values", "city", tuple(CITIES))]
    out += [Check(m, "not_null", "temperature")]
    out += [
        Check(m, "not_null", "weather_description"),
        Check(m, "accepted_values", "weather_description", tuple(WEATHER_DESCRIPTIONS)),
    ]
    out += [Check(m, "not_null", c) for c in
            ("wind_speed", "humidity", "pressure", "weather_time_utc", "weather_time_local")]
    out += [Check(m, "not_null", "is_forecast"),
            Check(m, "accepted_values", "is_forecast", (True, False))]
    return out


def daily_checks() -> list[Check]:
    m = "daily_average"
    out = [Check(m, "not_null", c) for c in
           ("city", "date", "avg_temperature", "avg_wind_speed")]
    out += [
        Check(m, "not_null", "avg_humidity"),
        Check(m, "accepted_values", "avg_humidity", (0, 100),
              where="avg_humidity >= 0 AND avg_humidity <= 100"),
        Check(m, "not_null", "avg_pressure"),
        Check(m, "accepted_values", "avg_pressure", (1000, 1025),
              where="avg_pressure >= 1000 AND avg_pressure <= 1025"),
        Check(m, "not_null", "has_forecast_data"),
        Check(m, "accepted_values", "has_forecast_data", (0, 1)),
    ]
    return out


def range_checks() -> list[Check]:
    """Ranges stated in the column descriptions (report measures, daily means)."""
    out = [Check("weather_report", "in_range", c, low=lo, high=hi)
           for c, (lo, hi) in DOCUMENTED_RANGES.items()]
    out += [
        Check("daily_average", "in_range", "avg_humidity", low=0.0, high=100.0),
        Check("daily_average", "in_range", "avg_pressure", low=1000.0, high=1025.0),
    ]
    return out


def declared_checks() -> list[Check]:
    """The 24 declared column tests: 17 not_null, 1 unique, 6 accepted_values."""
    return report_checks() + daily_checks()
