"""Read-time orders (the driver compares rows order-insensitively)."""

from conftest import SF001

from tidemark.plans.catalog import AS_OF
from tidemark.plans.marts import daily_average, daily_sorted, report, report_sorted
from tidemark.plans.staging import staging, staging_sorted
from tidemark.sources.raw import observations


def test_sorted_reads(spark):
    stg = staging(observations(spark, SF001), as_of=AS_OF)
    rep = [(r.city, r.weather_time_local) for r in report_sorted(report(stg)).collect()]
    assert rep == sorted(rep, key=lambda x: (x[0], -x[1].timestamp()))
    day = [(r.city, r.date) for r in daily_sorted(daily_average(stg)).collect()]
    assert day == sorted(day, key=lambda x: (x[0], -x[1].toordinal()))
    st = [(r.city, r.weather_time_utc) for r in staging_sorted(stg).collect()]
    assert st == sorted(st)
