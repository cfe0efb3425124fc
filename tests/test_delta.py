from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from forumlens.operators.delta import shared_columns, snapshot_delta

T0, T1 = datetime(2025, 2, 10), datetime(2025, 2, 11)
COLUMNS = "id string, extracted_at timestamp_ntz, upvote_count int, downvote_count int"


def snapshot(spark, rows, columns=COLUMNS):
    return spark.createDataFrame(rows, columns)


def test_delta_rules(spark):
    before = snapshot(spark, [("a", T0, 10, None), ("b", T0, 5, 1), ("d", T0, 9, 9)])
    after = snapshot(spark, [("a", T1, 13, 4), ("b", T1, 5, None), ("c", T1, 7, 0)])
    got = {r.id: (r.extracted_at, r.v_upvote_count, r.v_downvote_count) for r in snapshot_delta(before, after).collect()}
    assert got == {"a": (T1, 3, 4), "b": (T1, 0, None), "c": (T1, 7, 0)}


def test_first_batch_counts_in_full(spark):
    got = snapshot_delta(None, snapshot(spark, [("a", T1, 13, 4)]))
    assert got.columns == ["id", "extracted_at", "v_upvote_count", "v_downvote_count"]
    assert got.first().v_upvote_count == 13


def test_shared_columns_keep_the_newer_order(spark):
    before = snapshot(spark, [], "id string, b int, a int, gone int")
    after = snapshot(spark, [], "id string, a int, new int, b int")
    assert shared_columns(before, after, ["id"]) == ["a", "b"]


def test_plan_is_one_left_join_without_outer(spark):
    before, after = snapshot(spark, [("a", T0, 1, 1)]), snapshot(spark, [("a", T1, 2, 2)])
    plan = snapshot_delta(before, after)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "FullOuter" not in plan


ids = st.sampled_from("abcdef")
counter = st.one_of(st.none(), st.integers(0, 50))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(ids, counter), st.dictionaries(ids, counter))
def test_before_plus_delta_is_after(spark, old, new):
    before = snapshot(spark, [(k, T0, v, 0) for k, v in old.items()])
    after = snapshot(spark, [(k, T1, v, 0) for k, v in new.items()])
    got = {r.id: r.v_upvote_count for r in snapshot_delta(before, after).collect()}
    assert set(got) == set(new)
    for key, value in new.items():
        assert got[key] is None if value is None else got[key] + (old.get(key) or 0) == value
