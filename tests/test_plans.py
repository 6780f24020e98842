"""The physical plans have the shape the operators are designed for."""

from __future__ import annotations

from change_log import SF

from tidemark import scenarios as S
from tidemark.operators import latest_current, scd2_from_log
from tidemark.sources import read_as_of


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # run it: final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_current_limits_rows_before_the_shuffle(spark):
    plan = _plan(latest_current(S.change_log(spark, SF), as_of=S.AS_OF))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "LessThan(ts," in plan  # the as-of day filter reaches the Parquet scan as a range


def test_as_of_read_pushes_a_range(spark):
    plan = _plan(read_as_of(spark, f"{SF}/events.parquet", date_column="ts", as_of="2024-01-10"))
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts,2024-01-11T00:00)]" in plan


def test_scd2_from_log_single_shuffle_without_hot_keys(spark):
    plan = _plan(scd2_from_log(S.change_log(spark, SF)))
    assert plan.count("Exchange hashpartitioning") == 1


def test_top_users_combines_map_side(spark):
    plan = _plan(S.q_top_users(spark, SF))
    assert "partial_sum((l_extendedprice" in plan
    assert "partial_count(1)" in plan
    assert "TakeOrderedAndProject" in plan or "limit=10" in plan.lower()


def test_scans_read_only_needed_columns(spark):
    plan = _plan(S.q_top_users(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan


def test_hourly_batch_splits_off_the_untouched_state(spark):
    plan = _plan(S.q_latest_current_hourly_split(spark, SF))
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan


def test_hourly_merge_runs_its_full_outer_join_on_touched_keys_only(spark):
    plan = _plan(S.q_merge_current_hourly_split(spark, SF))
    assert "FullOuter" in plan and "LeftAnti" in plan and "BroadcastHashJoin" in plan


def test_hourly_batch_on_a_small_state_keeps_one_shuffle_join(spark):
    plan = _plan(S.q_latest_current_hourly(spark, SF))
    assert "LeftAnti" not in plan
