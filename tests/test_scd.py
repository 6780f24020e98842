from __future__ import annotations

import datetime as dt
import random

from change_log import LOG_SCHEMA, literal_rows, ts
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import as_of_view, latest_current, scd2_apply, scd2_from_log, scd2_init, snapshot_current
from tidemark.operators.sequence import next_in_key

OPEN = dt.datetime(9999, 12, 31)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_latest_current_literal(literal_log):
    got = rows(latest_current(literal_log, as_of="2024-01-04", keep_tie=True), "id", "seq", "action")
    # key 1 re-inserted, key 2's late change is older than its insert, key 3 deleted, tie on key 5 -> seq 10
    assert got == [(1, 5, "INSERT"), (2, 6, "INSERT"), (4, 8, "UPDATE"), (5, 10, "UPDATE")]


def test_latest_current_as_of_drops_deleted_key(literal_log):
    got = rows(latest_current(literal_log, as_of="2024-01-03"), "id")
    assert got == [(2,), (4,), (5,)]


def test_latest_current_has_no_helper_columns(literal_log):
    assert latest_current(literal_log).columns == ["id", "name", "email", "action", "updated_timestamp",
                                                   "partition_date"]


def test_scd2_from_log_literal(literal_log):
    got = rows(scd2_from_log(literal_log), "id", "name", "valid_from", "valid_to", "is_current")
    assert got == [
        (1, "name1", ts("2024-01-01 10:00:00"), ts("2024-01-02 10:00:00"), False),
        (1, "name2", ts("2024-01-02 10:00:00"), ts("2024-01-02 11:00:00"), False),
        (1, "name3", ts("2024-01-02 11:00:00"), ts("2024-01-03 10:00:00"), False),
        (1, "name5", ts("2024-01-04 10:00:00"), OPEN, True),
        (2, "name11", ts("2023-12-31 10:00:00"), ts("2024-01-01 10:00:00"), False),
        (2, "name6", ts("2024-01-01 10:00:00"), OPEN, True),
        (4, "name8", ts("2024-01-02 10:00:00"), OPEN, True),
        (5, "name10", ts("2024-01-02 10:00:00"), OPEN, True),
        (5, "name9", ts("2024-01-02 10:00:00"), ts("2024-01-02 10:00:00"), False),
    ]


def _daily_fold(spark, log):
    days = sorted({r[0] for r in log.select("partition_date").distinct().collect()})
    target = None
    for d in days:
        target, late = scd2_apply(target, log.filter(F.col("partition_date") == F.lit(d)))
        assert late.count() == 0
        target = spark.createDataFrame(target.collect(), target.schema)  # freeze, like a written table
    return target


def test_scd2_apply_daily_fold_equals_full_log(spark, literal_log):
    folded = _daily_fold(spark, literal_log)
    full = scd2_from_log(literal_log)
    assert folded.exceptAll(full).count() == 0 and full.exceptAll(folded).count() == 0


def test_scd2_apply_reports_late_changes_and_replay_is_noop(spark, literal_log):
    on_time = literal_log.filter(F.col("seq") != 11)
    target = scd2_from_log(on_time)
    late_batch = literal_log.filter(F.col("seq") == 11)
    result, late = scd2_apply(target, late_batch)
    assert [r.seq for r in late.collect()] == [11]
    assert result.exceptAll(target).count() == 0 and target.exceptAll(result).count() == 0
    # replaying an already applied batch changes nothing
    again, late2 = scd2_apply(target, on_time.filter(F.col("partition_date") == F.lit(dt.date(2024, 1, 4))))
    assert late2.count() == 1
    assert again.exceptAll(target).count() == 0


def test_scd2_apply_close_only(literal_log):
    target = scd2_from_log(literal_log.filter(F.col("partition_date") <= F.lit(dt.date(2024, 1, 1))))
    batch = literal_log.filter(F.col("partition_date") == F.lit(dt.date(2024, 1, 2)))
    result, _ = scd2_apply(target, batch, close_only=True)
    got = rows(result, "id", "valid_from", "valid_to")
    assert (1, ts("2024-01-01 10:00:00"), ts("2024-01-02 10:00:00")) in got
    assert len(got) == target.count()


def test_scd2_apply_reinsert_of_live_key_closes_previous(spark):
    log = spark.createDataFrame(literal_rows([(1, 7, "INSERT", "2024-01-01 00:00:00"),
                                              (2, 7, "INSERT", "2024-01-02 00:00:00")]), LOG_SCHEMA)
    target = scd2_from_log(log.filter("seq = 1"))
    result, _ = scd2_apply(target, log.filter("seq = 2"))
    assert rows(result, "name", "valid_to") == [("name1", ts("2024-01-02 00:00:00")), ("name2", OPEN)]


def test_as_of_view(literal_log):
    scd2 = scd2_from_log(literal_log)
    got = rows(as_of_view(scd2, "2024-01-02 10:30:00"), "id", "name")
    assert got == [(1, "name2"), (2, "name6"), (4, "name8"), (5, "name10")]


def test_scd2_init_and_snapshot_current(literal_log):
    init = scd2_init(literal_log.drop("seq"), as_of="2024-01-05")
    assert init.filter("valid_to = TIMESTAMP_NTZ '9999-12-31 00:00:00'").count() == 11
    snap = snapshot_current(literal_log, as_of="2024-01-05")
    assert snap.count() == 9 and {r[0] for r in snap.select("partition_date").collect()} == {dt.date(2024, 1, 5)}
    assert "seq" not in snap.columns


def _random_log(spark, n_rows, n_keys, hot_share, seed):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    data = []
    for seq in range(n_rows):
        key = 0 if rnd.random() < hot_share else rnd.randrange(1, n_keys)
        t = base + dt.timedelta(seconds=rnd.randrange(0, 86400 * 5))
        if rnd.random() < 0.05:
            t = base + dt.timedelta(days=2)  # timestamp ties
        data.append((seq, key, f"n{seq}", "e", rnd.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]), t, t.date()))
    return spark.createDataFrame(data, LOG_SCHEMA)


def test_next_in_key_with_hot_key_split_matches_plain_lead(spark):
    log = _random_log(spark, 3000, 20, hot_share=0.4, seed=7)
    split = next_in_key(log, ["id"], "updated_timestamp", ["seq"], "nxt", split_rows=50)
    w = Window.partitionBy("id").orderBy("updated_timestamp", "seq")
    plain = log.withColumn("nxt", F.lead("updated_timestamp").over(w))
    assert split.columns == plain.columns
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0


def test_scd2_from_log_hot_key_split(spark):
    log = _random_log(spark, 2000, 10, hot_share=0.5, seed=11)
    a = scd2_from_log(log, split_rows=40)
    b = scd2_from_log(log)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_latest_current_equals_open_scd2_rows(spark):
    log = _random_log(spark, 1500, 50, hot_share=0.2, seed=3)
    cur = latest_current(log).select("id", "name")
    open_rows = scd2_from_log(log).filter("is_current").select("id", "name")
    assert cur.exceptAll(open_rows).count() == 0 and open_rows.exceptAll(cur).count() == 0


def _burst_log(spark):
    t = dt.datetime(2024, 1, 1, 12)
    data = [(seq, 0, f"n{seq}", "e", "UPDATE", t, t.date()) for seq in range(2000)]  # one key, one instant
    data += [(2000 + i, 1 + i % 30, f"c{i}", "e", "UPDATE", t + dt.timedelta(seconds=i), t.date()) for i in range(300)]
    return spark.createDataFrame(data, LOG_SCHEMA)


def test_hot_key_burst_is_cut_into_balanced_slices(spark):
    from tidemark.operators.sequence import hot_keys, hot_slices
    log = _burst_log(spark)
    hot = hot_keys(log, ["id"], 100)
    sliced = hot_slices(log, ["id"], "updated_timestamp", ["seq"], hot, 1, 2000, 100)
    sizes = [r["count"] for r in sliced.groupBy("id", "__slice").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 300  # ~100 rows each, not one task for the burst
    split = next_in_key(log, ["id"], "updated_timestamp", ["seq"], "nxt", split_rows=100)
    w = Window.partitionBy("id").orderBy("updated_timestamp", "seq")
    plain = log.withColumn("nxt", F.lead("updated_timestamp").over(w))
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0


def test_fold_latest_equals_full_recompute_and_keeps_tombstones(spark, literal_log):
    from tidemark.operators import fold_latest
    days = sorted({r[0] for r in literal_log.select("partition_date").distinct().collect()})
    state = None
    for d in days:
        state, current = fold_latest(state, literal_log.filter(F.col("partition_date") == F.lit(d)))
        state = spark.createDataFrame(state.collect(), state.schema)
    full = latest_current(literal_log)
    assert current.exceptAll(full).count() == 0 and full.exceptAll(current).count() == 0
    # key 3's delete is kept as a tombstone: an older update arriving late does not bring it back
    late = spark.createDataFrame(literal_rows([(12, 3, "UPDATE", "2024-01-01 00:00:00")]), LOG_SCHEMA)
    _, current = fold_latest(state, late)
    assert current.filter("id = 3").count() == 0
