"""As-of joins and truncates against plain Python."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import as_of_join, close_at_truncates, point_in_time, scd2_from_log
from tidemark.operators.truncates import with_next_truncate

LEFT = "k long, t timestamp_ntz, n long, right_ string"
RIGHT = "k long, at timestamp_ntz, tie long, v string"


def when(rnd):
    return None if rnd.random() < 0.1 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randint(0, 15))


def tables(seed, n=70):
    rnd = random.Random(seed)
    key = lambda: rnd.choice([None, 1, 1, 1, 2, 3])
    return ([(key(), when(rnd), i, "x") for i in range(n)], [(key(), when(rnd), rnd.randint(0, 3), None if rnd.random() < 0.2 else f"v{i}") for i in range(n)])


def brute(left, right, exact, direction):
    out = []
    for k, t, n, x in left:
        fits = [(r[1], r[2]) for r in right if r[0] == k and t is not None and r[1] is not None
                and ((r[1] < t if direction == "backward" else r[1] > t) or (exact and r[1] == t))]
        out.append((k, t, n, x, *((max if direction == "backward" else min)(fits) if fits else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("split_rows", [10**6, 5])
@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact", [True, False])
def test_as_of_join_equals_brute_force(spark, split_rows, direction, exact):
    left, right = tables(split_rows + exact)
    found = as_of_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t", "at", ("tie",), "r_", exact,
                       direction, split_rows)
    assert found.columns == ["k", "t", "n", "right_", "r_at", "r_tie", "r_v"]
    assert sorted([tuple(r)[:6] for r in found.collect()], key=str) == brute(left, right, exact, direction)


def test_as_of_join_without_tie_has_one_winner_and_empty_sides(spark):
    left, right = tables(3)
    a, b = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    runs = {tuple(sorted(map(str, as_of_join(a, b.orderBy(F.rand(s)), ["k"], "t", "at").collect()))) for s in range(3)}
    assert len(runs) == 1
    assert as_of_join(a, b.limit(0), ["k"], "t", "at").where("right_v IS NULL").count() == len(left)
    assert as_of_join(a.limit(0), b, ["k"], "t", "at").count() == 0
    with pytest.raises(ValueError):
        as_of_join(a, b, ["k"], "t", "at", direction="nearest")
    with pytest.raises(ValueError):
        as_of_join(a.withColumnRenamed("n", "right_v"), b, ["k"], "t", "at")


def test_as_of_join_shuffles_once_without_a_range_join(spark):
    left, right = tables(4)
    found = as_of_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t", "at")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "Cartesian" not in plan


def test_point_in_time_reads_the_interval_that_holds(spark):
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    end = dt.datetime(9999, 12, 31)
    dim = [(1, "a", day(1), day(2)), (1, "b", day(2), day(3)), (1, "c", day(4), end), (None, "n", day(1), end), (2, "z", day(1), day(1)), (2, "y", day(1), end)]
    facts = [(1, day(1), 1), (1, day(2), 2), (1, day(3), 3), (1, day(5), 4), (None, day(9), 5), (1, dt.datetime(2023, 1, 1), 6), (2, day(1), 7), (9, day(1), 8),
             (1, None, 9)]
    found = point_in_time(spark.createDataFrame(facts, "k long, at timestamp_ntz, n long"),
                          spark.createDataFrame(dim, "k long, v string, valid_from timestamp_ntz, valid_to timestamp_ntz"), ["k"], "at")
    assert {r["n"]: r["dim_v"] for r in found.collect()} == {1: "a", 2: "b", 3: None, 4: "c", 5: "n", 6: None, 7: "y", 8: None, 9: None}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("broadcast", [True, False])
def test_intervals_end_at_the_next_truncate(spark, monkeypatch, seed, broadcast):
    from tidemark.operators import truncates as module
    monkeypatch.setattr(module, "MAX_BROADCAST_TRUNCATES", 10**5 if broadcast else 0)
    rnd = random.Random(seed)
    at = lambda: dt.datetime(2024, 1, 1 + rnd.randint(0, 4), 6 * rnd.randint(0, 3))
    rows = [(s, rnd.choice([None, 1, 2, 3]), rnd.choice(["INSERT", "UPDATE", "DELETE"]), at()) for s in range(0, 120, 2)]
    cuts = [(at(), s) for s in rnd.sample(range(1, 121, 2), 6)]
    log = spark.createDataFrame(rows, "seq long, id long, action string, updated_timestamp timestamp_ntz")
    events = spark.createDataFrame([*cuts, cuts[0], (None, 3)], "updated_timestamp timestamp_ntz, seq long")
    found = close_at_truncates(scd2_from_log(log.withColumn("change_seq", F.col("seq"))), events, tie=("seq",), position=("change_seq",))
    end, want = dt.datetime(9999, 12, 31), []
    for s, k, a, t in rows:
        if a != "DELETE":
            later = [(r[3], r[0]) for r in rows if r[1] == k and (r[3], r[0]) > (t, s)]
            to = min([end, *[x for x, _ in [min(later)]]] if later else [end])
            to = min([to, *[x for x, q in cuts if (x, q) > (t, s)]])
            want.append((k, s, t, to, to == end))
    assert sorted([(r["id"], r["change_seq"], r["valid_from"], r["valid_to"], r["is_current"]) for r in found.collect()], key=str) == sorted(want, key=str)


def test_truncates_cost_one_row_each_and_no_range_join(spark):
    rows = spark.range(100).select(F.col("id").alias("seq"), F.expr("timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00')").alias("t"))
    events = rows.where("seq % 10 = 0").withColumnRenamed("t", "updated_timestamp")
    found = with_next_truncate(rows, events, ["t", "seq"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert found.where("__truncated IS NULL").count() == 10 and found.columns == ["seq", "t", "__truncated"]
    assert with_next_truncate(rows, events.limit(0), ["t", "seq"]).where("__truncated IS NULL").count() == 100


def test_rows_and_truncates_are_read_once_to_find_the_next_truncate(spark):
    t = lambda s: dt.datetime(2024, 1, 3) + dt.timedelta(seconds=s)
    rnd = random.Random(8)
    # a burst, some of one instant, and single ones days apart
    cuts = [(t(rnd.choice([1, 2, 2.5, 3, 90_000, 400_000])), s) for s in range(1, 60, 2)] + [(t(-900_000), 61)]
    rows = [(s, t(rnd.choice([-2_000_000, -900_000, 0, 1, 2, 2.5, 2.6, 3, 80_000, 90_000, 300_000, 400_000, 900_000]))) for s in range(0, 300, 2)] + [(5, None)]
    counts = {k: spark.sparkContext.accumulator(0) for k in ("rows", "cuts")}

    def counted(name, data, schema):
        seen = counts[name]

        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return spark.createDataFrame(data, schema).mapInArrow(run, schema)
    found = with_next_truncate(counted("rows", rows, "seq long, t timestamp_ntz"), counted("cuts", cuts, "updated_timestamp timestamp_ntz, seq long"), ["t", "seq"])
    want = [(s, at, at and min([x for x, q in cuts if (x, q) > (at, s)], default=None)) for s, at in rows]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert counts["rows"].value == len(rows) and counts["cuts"].value == len(cuts)
