"""Snapshot differences, the bucketed MERGE and the offset ledger against plain Python."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from change_log import LOG_SCHEMA, literal_rows
from pyspark.sql import functions as F

from tidemark.operators import merge_current, merge_current_bucketed, snapshot_changes, snapshot_intervals
from tidemark.operators import snapshots as module
from tidemark.sinks import write_bucketed
from tidemark.streaming import offset_ranges, offset_report

END = dt.datetime(9999, 12, 31)


def random_snapshots(seed):
    """day -> key -> payload; day 4 is missing; a null key and null payloads among them."""
    rnd, days, now = random.Random(seed), {}, {}
    for d in range(1, 9):
        for k in [None, *range(1, 8)]:
            x = rnd.random()
            if x < 0.25:
                now.pop(k, None)
            elif x < 0.6:
                now[k] = (rnd.choice([None, "a", "b"]), rnd.choice([None, 1]))
        if d != 4:
            days[dt.date(2024, 1, d)] = dict(now)
    return days


def frame(spark, days, extra=()):
    rows = [(k, *v, d) for d, snap in days.items() for k, v in snap.items()] + list(extra)
    return spark.createDataFrame(rows, "id long, name string, n int, partition_date date").orderBy(F.rand(1))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("most", [100_000, 0])
def test_changes_and_intervals_equal_a_walk_over_the_days(spark, monkeypatch, seed, most):
    monkeypatch.setattr(module, "MAX_BROADCAST_DAYS", most)
    days = {d: s for d, s in random_snapshots(seed).items() if s}
    last, changes, open_, closed = {}, [], {}, []
    for d, snap in days.items():
        at = dt.datetime.combine(d, dt.time())
        for k in set(last) | set(snap):
            if last.get(k) == snap.get(k):
                continue
            if k in open_:
                closed.append((k, *open_.pop(k), at, False))
            if k in snap:
                open_[k] = (*snap[k], at)
            changes.append((k, *(snap.get(k) or last[k]), "DELETE" if k not in snap else "UPDATE" if k in last else "INSERT", d))
        last = snap
    closed += [(k, *v, END, True) for k, v in open_.items()]
    # rows that repeat a key and day, and a row without a day
    some = [(k, *v, d) for d, snap in days.items() for k, v in snap.items()][::3]
    df = frame(spark, days, [*some, (5, "x", 1, None)])
    assert sorted(map(str, map(tuple, snapshot_changes(df).collect()))) == sorted(map(str, changes))
    assert sorted(map(str, map(tuple, snapshot_intervals(df).collect()))) == sorted(map(str, closed))


def test_repeated_rows_of_a_day_have_one_winner_and_one_exchange_by_key(spark):
    rows = [(1, "a", 1, dt.date(2024, 1, 1)), (1, "b", 2, dt.date(2024, 1, 1)), (1, "b", 2, dt.date(2024, 1, 2))]
    df = spark.createDataFrame(rows, "id long, name string, n int, partition_date date")
    assert {tuple(r) for r in snapshot_changes(df, tie=("n",)).select("name", "action").collect()} == {("b", "INSERT")}
    assert snapshot_intervals(df).count() == 1 and snapshot_changes(df.limit(0)).count() == 0
    for out in (snapshot_changes(df), snapshot_intervals(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(id") == 1


# --- bucketed MERGE -------------------------------------------------------------------------------

@pytest.fixture()
def database(spark):
    name = f"bucketed_{random.randrange(10**9)}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def state_of(spark, rows):
    kinds = "id long, name string, email string, action string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    return spark.createDataFrame(rows, kinds)


@pytest.mark.parametrize("seed", range(3))
def test_bucketed_merge_equals_the_merge(spark, database, seed):
    rnd = random.Random(seed)
    t = lambda d: dt.datetime(2024, 1, d)
    rows = [(k, f"n{k}", "e", "INSERT", t(1), END) for k in [None, *range(1, 30)]] + [(3, "old", "e", "DELETE", t(1), t(2))]
    changes = literal_rows([(i, rnd.choice([None, *range(1, 40)]), rnd.choice(["INSERT", "UPDATE", "DELETE"]), f"2024-01-03 1{rnd.randint(0, 9)}:00:00")
                            for i in range(60)])
    batch = spark.createDataFrame(changes, LOG_SCHEMA)
    write_bucketed(spark, state_of(spark, rows).repartition(4, "id"), f"{database}.t1", ["id"], 4)
    merged = merge_current_bucketed(spark.table(f"{database}.t1"), batch, 4)
    assert sorted(map(str, merged.collect())) == sorted(map(str, merge_current(state_of(spark, rows), batch).collect()))
    write_bucketed(spark, merged, f"{database}.t2", ["id"], 4)
    again = merge_current_bucketed(spark.table(f"{database}.t2"), batch.limit(0), 4)
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_the_bucketed_side_is_not_exchanged(spark, database):
    rows = [(k, f"n{k}", "e", "INSERT", dt.datetime(2024, 1, 1), END) for k in range(1, 200)]
    write_bucketed(spark, state_of(spark, rows).repartition(4, "id"), f"{database}.t", ["id"], 4)
    batch = spark.createDataFrame(literal_rows([(i, i, "UPDATE", "2024-01-03 10:00:00") for i in range(1, 9)]), LOG_SCHEMA)
    merged = merge_current_bucketed(spark.table(f"{database}.t"), batch, 4)
    # union of: closed rows, merged rows, rows with null keys; the table is the first scan below the merge's join
    merge = merged._jdf.queryExecution().executedPlan().toString().split("Union")[1]
    join = merge[merge.index("SortMergeJoin"):]
    above, scan = join[:join.index("FileScan")], join[join.index("FileScan"):].splitlines()[0]
    assert "Bucketed: true" in scan and "Exchange" not in above
    assert "REPARTITION_BY_NUM" in join   # the batch


def test_bucketed_tables_are_not_overwritten(spark, database):
    write_bucketed(spark, spark.range(5), f"{database}.t", ["id"], 2)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        write_bucketed(spark, spark.range(5), f"{database}.t", ["id"], 2)


# --- offsets --------------------------------------------------------------------------------------

def walk(batches):
    seen = {}
    for p, o in [x for b in batches for x in b if None not in x]:
        seen[p, o] = seen.get((p, o), 0) + 1
    out = []
    for p in sorted({p for p, _ in seen}):
        offsets = sorted(o for q, o in seen if q == p)
        start = offsets[0]
        for a, b in zip(offsets, [*offsets[1:], None]):
            if b != a + 1:
                out.append(("range", p, start, a, a - start + 1))
                if n := sum(seen[p, o] - 1 for o in range(start, a + 1)):
                    out.append(("repeat", p, start, a, n))
                if b is not None:
                    out.append(("gap", p, a + 1, b - 1, b - a - 1))
                    start = b
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_ledger_equals_a_walk_over_all_offsets(spark, monkeypatch, seed):
    from tidemark.streaming import offsets
    monkeypatch.setattr(offsets, "BLOCK_OFFSETS", 8)
    rnd = random.Random(seed)
    batches = [[(rnd.choice([0, 0, 0, 1]), rnd.randint(lo, lo + 25)) for _ in range(30)] for lo in (0, 15, 60)]
    batches[1] += [(None, 5), (1, None)]
    ranges = None
    for b in batches:
        one = offset_ranges(spark.createDataFrame(b, "partition int, offset long"))
        ranges = one if ranges is None else ranges.unionByName(one)
    assert sorted(map(tuple, offset_report(ranges).collect())) == walk(batches)


def test_a_contiguous_batch_is_one_range(spark):
    one = offset_ranges(spark.range(1000).selectExpr("CAST(id % 2 AS INT) AS partition", "id DIV 2 AS offset"))
    assert sorted(map(tuple, one.collect())) == [(0, 0, 499, 0), (1, 0, 499, 0)]
    assert offset_report(one.limit(0)).count() == 0
