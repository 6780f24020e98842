"""The touched-key split: same results with and without it, and the state is not shuffled with it."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from change_log import LOG_SCHEMA
from pyspark.sql import functions as F

from tidemark.operators import fold_latest, latest_current, merge_close_and_insert, merge_current, scd2_apply
from tidemark.operators import touched as touched_mod
from tidemark.operators.scd import scd2_from_log
from tidemark.sinks import commit_scd2_batch, read_scd2_table

ACTIONS = ["INSERT", "UPDATE", "UPDATE", "DELETE"]


def _random_log(spark, seed=7, n=400, n_keys=40, days=10):
    rnd = random.Random(seed)
    rows = []
    for seq in range(1, n + 1):
        key = rnd.randint(1, n_keys)
        day = rnd.randint(1, days)
        t = dt.datetime(2024, 1, day, rnd.randint(0, 3), 0)  # few distinct times: many ties, broken by seq
        rows.append((seq, key, f"n{seq}", f"m{seq}@x", rnd.choice(ACTIONS), t, t.date()))
    return spark.createDataFrame(rows, LOG_SCHEMA)


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _frozen(df, path):
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


@pytest.fixture(autouse=True)
def force_split(monkeypatch):
    """The fixtures' states are small and their batches touch most keys, which would not be split:
    split them anyway (the results must not depend on the choice)."""
    monkeypatch.setattr(touched_mod, "MAX_TOUCHED_SHARE", float("inf"))
    monkeypatch.setattr(touched_mod, "MIN_SPLIT_STATE_ROWS", 0)


@pytest.fixture()
def no_broadcast(monkeypatch):
    """Force the fallback: no batch key set fits the broadcast bound."""
    monkeypatch.setattr(touched_mod, "MAX_BROADCAST_KEYS", -1)


def _day(log, lo, hi):
    return log.filter((F.col("partition_date") >= F.lit(dt.date(2024, 1, lo)))
                      & (F.col("partition_date") <= F.lit(dt.date(2024, 1, hi))))


def _fold(spark, scratch):
    log = _random_log(spark)
    state, _ = fold_latest(None, _day(log, 1, 6))
    state = _frozen(state, f"{scratch}/state")
    new_state, current = fold_latest(state, _day(log, 7, 8))
    return log, new_state, current


def test_fold_latest_split_equals_full_recompute(spark, scratch):
    log, _state, current = _fold(spark, scratch)
    _same(current, latest_current(_day(log, 1, 8)))


def test_fold_latest_fallback_equals_split(spark, scratch, no_broadcast):
    log, _state, current = _fold(spark, scratch)
    _same(current, latest_current(_day(log, 1, 8)))


def test_fold_latest_does_not_shuffle_the_state(spark, scratch):
    _log, new_state, _ = _fold(spark, scratch)
    new_state.write.format("noop").mode("overwrite").save()
    plan = new_state._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan


def _open_current(spark, log, scratch):
    cur = latest_current(_day(log, 1, 6)).select(
        "id", "name", "email", "action", F.col("updated_timestamp").alias("valid_from"),
        F.expr("TIMESTAMP_NTZ '9999-12-31 00:00:00'").alias("valid_to"))
    closed = _day(log, 1, 2).filter(F.col("seq") <= 60).select(  # a few closed rows ride along untouched
        (F.col("id") + 1000).alias("id"), "name", "email", "action", F.col("updated_timestamp").alias("valid_from"),
        F.col("updated_timestamp").alias("valid_to"))
    return _frozen(cur.unionByName(closed), f"{scratch}/current")


def _merges(spark, scratch):
    log = _random_log(spark, seed=11)
    cur = _open_current(spark, log, scratch)
    batch = _day(log, 7, 7)
    return (merge_current(cur, batch).collect(),
            merge_close_and_insert(cur, batch, as_of="2024-01-07").collect(), cur.schema)


def test_merges_fallback_equals_split(spark, scratch, monkeypatch):
    split_m1, split_m2, _ = _merges(spark, scratch)
    monkeypatch.setattr(touched_mod, "MAX_BROADCAST_KEYS", -1)
    full_m1, full_m2, _ = _merges(spark, scratch + "-b")
    assert sorted(map(tuple, split_m1)) == sorted(map(tuple, full_m1))
    assert sorted(map(tuple, split_m2)) == sorted(map(tuple, full_m2))


def _apply(spark, scratch):
    log = _random_log(spark, seed=3)
    target = _frozen(scd2_from_log(_day(log, 1, 5)), f"{scratch}/scd2")
    result, late = scd2_apply(target, _day(log, 6, 10))
    return log, result, late


def test_scd2_apply_split_and_fallback_equal_full_log(spark, scratch, monkeypatch):
    log, split, late = _apply(spark, scratch)
    assert late.count() == 0
    full = scd2_from_log(_day(log, 1, 10))
    _same(split, full)
    monkeypatch.setattr(touched_mod, "MAX_BROADCAST_KEYS", -1)
    _log, fallback, _ = _apply(spark, scratch + "-b")
    _same(fallback, full)


@pytest.mark.parametrize("broadcast", [True, False])
def test_scd2_commits_equal_full_log(spark, scratch, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(touched_mod, "MAX_BROADCAST_KEYS", -1)
    log = _random_log(spark, seed=5)
    root = f"{scratch}/layout"
    for batch_id, (lo, hi) in enumerate([(1, 3), (4, 4), (5, 8), (9, 10)], start=1):
        commit_scd2_batch(spark, root, _frozen(_day(log, lo, hi), f"{scratch}/batch{batch_id}"), batch_id)
    _same(read_scd2_table(spark, root), scd2_from_log(_day(log, 1, 10)))


def test_split_is_skipped_when_the_batch_touches_most_keys(spark, scratch, monkeypatch):
    monkeypatch.setattr(touched_mod, "MAX_TOUCHED_SHARE", 0.2)
    _log, new_state, current = _fold(spark, scratch)
    new_state.write.format("noop").mode("overwrite").save()
    assert "LeftAnti" not in new_state._jdf.queryExecution().executedPlan().toString()
    prof = touched_mod.profile_keys(_day(_random_log(spark), 7, 8), ["id"], 10, state=spark.read.parquet(
        f"{scratch}/state"))
    assert prof.state_rows == spark.read.parquet(f"{scratch}/state").count() and not touched_mod.worth_splitting(prof)


def _hot_log(spark, seed=13, n=1500, n_keys=60):
    """Key 0 holds about 40% of the changes: the batch's hot key takes the sliced chaining path."""
    rnd = random.Random(seed)
    rows = []
    for seq in range(1, n + 1):
        key = 0 if rnd.random() < 0.4 else rnd.randint(1, n_keys)
        t = dt.datetime(2024, 1, rnd.randint(1, 10), rnd.randint(0, 23), rnd.choice([0, 0, 30]))
        rows.append((seq, key, f"n{seq}", f"m{seq}@x", rnd.choice(ACTIONS), t, t.date()))
    return spark.createDataFrame(rows, LOG_SCHEMA)


@pytest.mark.parametrize("split", [True, False])
def test_scd2_apply_with_hot_batch_key_equals_full_log(spark, scratch, monkeypatch, split):
    if not split:
        monkeypatch.setattr(touched_mod, "MAX_BROADCAST_KEYS", -1)
    log = _hot_log(spark)
    target = _frozen(scd2_from_log(_day(log, 1, 4)), f"{scratch}/scd2")
    result, late = scd2_apply(target, _day(log, 5, 10), split_rows=40)
    assert late.count() == 0
    _same(result, scd2_from_log(_day(log, 1, 10)))


def test_merge_current_split_keeps_the_full_outer_join_off_untouched_rows(spark, scratch):
    log = _random_log(spark, seed=11)
    cur = _open_current(spark, log, scratch)
    out = merge_current(cur, _day(log, 7, 7))
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" in plan and "LeftAnti" in plan and "LeftSemi" in plan and "BroadcastHashJoin" in plan


def test_split_is_skipped_for_a_small_state(spark, scratch, monkeypatch):
    monkeypatch.setattr(touched_mod, "MIN_SPLIT_STATE_ROWS", 1_000_000)
    prof = touched_mod.KeyProfile(keys=10, hot=0, hot_rows=0, state_rows=5_000)
    assert not touched_mod.worth_splitting(prof)
    big = touched_mod.KeyProfile(keys=10, hot=0, hot_rows=0, state_rows=5_000_000)
    assert touched_mod.worth_splitting(big)


# --- key profile ------------------------------------------------------------------------------------

def _counted(rows, split_rows):
    from collections import Counter
    n = Counter(r[1] for r in rows)
    hot = {k: c for k, c in n.items() if c > split_rows}
    return len(n), len(hot), sum(hot.values())


@pytest.mark.parametrize("split_rows, most", [(5, None), (40, None), (400, None), (10**6, None), (5, 10)])
def test_the_sketched_profile_finds_exactly_the_hot_keys(spark, monkeypatch, split_rows, most):
    if most:
        monkeypatch.setattr(touched_mod, "MAX_SKETCH", most)   # too many candidates for a sketch: all keys are counted
    rnd = random.Random(split_rows)
    rows = [(i, None if i % 50 == 0 else int(rnd.paretovariate(0.8))) for i in range(3000)]
    df = spark.createDataFrame(rows, "seq long, id long")
    keys, hot, hot_rows = _counted(rows, split_rows)
    prof = touched_mod.profile_keys(df, ["id"], split_rows)
    assert (prof.hot, prof.hot_rows) == (hot, hot_rows)
    assert keys * 0.98 <= prof.keys <= keys * 1.25 + 1
    assert prof.key_bytes >= sum(len(str(k)) for k in {r[1] for r in rows} if k is not None)


def test_the_profile_exchanges_no_keys(spark, monkeypatch):
    df = spark.range(10_000).select((F.col("id") % 5000).alias("id"))
    plans = []
    for name in ("collect", "first"):
        real = getattr(type(df), name)
        monkeypatch.setattr(type(df), name, lambda self, *a, _r=real: (plans.append(self._jdf.queryExecution().executedPlan().toString()), _r(self, *a))[1])
    prof = touched_mod.profile_keys(df, ["id"], 100)
    assert prof.hot == 0 and len(plans) >= 2
    assert all("hashpartitioning" not in p and "Exchange SinglePartition" in p for p in plans)


def test_an_empty_batch_has_an_empty_profile(spark):
    prof = touched_mod.profile_keys(spark.createDataFrame([], "id long"), ["id"], 10, state=spark.range(3))
    assert (prof.keys, prof.hot, prof.hot_rows, prof.state_rows, prof.key_bytes) == (0, 0, 0, 3, 0)
