"""Plan shapes that the scale design depends on (read from ``explain``)."""

import contextlib
import io

import __spark_entry__ as contract
from conftest import SF001


def plan(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def q(spark, name):
    return contract.queries()[name](spark, SF001)


def test_staging_one_shuffle_partial_limit_broadcast_pruned_scan(spark):
    text = plan(q(spark, "staging"))
    assert text.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "BroadcastHashJoin" in text
    assert "props" not in text.split("ReadSchema")[1].split("\n")[0]


def test_daily_rollup_partial_hash_aggregation(spark):
    text = plan(q(spark, "daily_average"))
    assert "partial_sum" in text and "SortAggregate" not in text
    assert text.count("Exchange hashpartitioning") == 2  # dedup key, then (city, date)


def test_star_join_uses_semi_joins(spark):
    text = plan(q(spark, "star_join_distinct"))
    assert text.count("LeftSemi") == 2 and "Inner" not in text


def test_bridge_join_pre_aggregates_fact_rows(spark):
    text = plan(q(spark, "bridge_join_count"))
    first_join = text.index("Join")
    assert "partial_count" in text[first_join:]  # lineitem collapsed below the joins


def test_quality_suite_one_shuffle_per_table(spark):
    from tidemark.operators import quality as dq
    from tidemark.plans.catalog import AS_OF
    from tidemark.plans.marts import report
    from tidemark.plans.staging import staging
    from tidemark.sources.raw import observations

    rep = report(staging(observations(spark, SF001), as_of=AS_OF)).checkpoint(eager=True)
    text = plan(dq.run_suite(spark, {"weather_report": rep}, dq.report_checks()))
    assert text.count("Exchange hashpartitioning(check_id") == 2  # (check, value), then check


def test_no_python_udfs_anywhere(spark):
    for name in ("staging", "daily_average", "payload_extract", "hourly_spine", "dq_suite"):
        text = plan(q(spark, name))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
