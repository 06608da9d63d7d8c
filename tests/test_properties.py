
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import raw_df
from tidemark.operators.dedup import latest_by_aggregate, latest_per_key

slot = st.tuples(st.sampled_from(["London", "Paris", "Tokyo"]), st.integers(0, 3),
                 st.one_of(st.none(), st.integers(0, 5)))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(slot, min_size=1, max_size=30), st.randoms())
def test_dedup_unique_idempotent_order_free(spark, rows, rnd):
    recs = [dict(id=i, city=c, time=f"2026-01-01 0{h}:00:00",
                 inserted_at=None if ins is None else f"2026-01-02 0{ins}:00:00")
            for i, (c, h, ins) in enumerate(rows)]
    df = raw_df(spark, recs)
    once = latest_per_key(df)
    keys = [(r.city, r.time) for r in once.collect()]
    assert len(keys) == len(set(keys))
    twice = latest_per_key(once)
    assert sorted(r.id for r in once.collect()) == sorted(r.id for r in twice.collect())
    shuffled = recs[:]
    rnd.shuffle(shuffled)
    again = latest_per_key(raw_df(spark, shuffled).repartition(3))
    assert sorted(r.id for r in again.collect()) == sorted(r.id for r in once.collect())
    agg = latest_by_aggregate(df)
    assert sorted(r.id for r in agg.collect()) == sorted(r.id for r in once.collect())
