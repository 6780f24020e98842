"""Stream deduplication and the incremental mart."""

from __future__ import annotations

import glob
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import top_users
from tidemark.operators.envelope import DEFAULT_FIELDS
from tidemark.sinks import mart, state
from tidemark.sinks.mart import commit_orders, read_top_users
from tidemark.streaming import drop_redelivered, read_truncated_table, run_stream_spec, stream_scd2


def message(key, ms, op="c", seq=None):
    image = {"id": str(key), "name": f"n{ms}", "email": "e"}
    source = {"ts_ms": ms} | ({} if seq is None else {"lsn": seq})
    return json.dumps({"op": op, "after": image if op not in "dt" else None, "before": image if op == "d" else None, "source": source})


def send(spark, inbox, messages):
    spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.mode("append").text(inbox)


def drain(spark, inbox, out, ckpt, within):
    query = (drop_redelivered(spark.readStream.schema("value string").text(inbox), within).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    query.awaitTermination()
    return query.recentProgress


def test_redelivered_messages_pass_once_across_batches_and_restarts(spark, scratch):
    inbox, out, ckpt = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt"
    for batch in (["a", "b", "a"], ["b", "c", "", ""], ["a", "c", "d", "d"]):
        send(spark, inbox, batch)
        drain(spark, inbox, out, ckpt, "1 day")
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == ["", "a", "b", "c", "d"]


def test_old_state_is_evicted(spark, scratch):
    inbox, out, ckpt = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt"
    progress = []
    for batch in (["a", "b"], ["c"], ["a", "d"]):
        send(spark, inbox, batch)
        progress += drain(spark, inbox, out, ckpt, "1 second")
        time.sleep(2.5)
    states = [p["stateOperators"][0] for p in progress if p["stateOperators"]]
    assert sum(s["numRowsRemoved"] for s in states) >= 2
    assert states[-1]["numRowsTotal"] <= 3
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == ["a", "a", "b", "c", "d"]   # "a" came back after its time


def test_tombstones_cannot_be_told_apart_and_all_pass(spark, scratch):
    source = f"{scratch}/in"
    spark.createDataFrame([(None,), (None,), ("x",), ("x",)], "value string").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("value string").parquet(source)
    (drop_redelivered(stream).writeStream.format("parquet").option("path", f"{scratch}/out")
     .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start().awaitTermination())
    assert sorted(str(r[0]) for r in spark.read.parquet(f"{scratch}/out").collect()) == ["None", "None", "x"]


def test_old_changes_are_not_dropped_as_late(spark, scratch):
    inbox, bronze = f"{scratch}/in", f"{scratch}/bronze"
    spec = {"extract": {"path": inbox}, "load": {"path": bronze, "checkpoint_location": f"{scratch}/ckpt", "dedup_within": "1 second"}}
    for batch in ([message(1, 1_700_000_000_000)], [message(2, 1_000)], [message(3, 2_000), message(3, 2_000)]):
        send(spark, inbox, batch)
        run_stream_spec(spark, spec, trigger="availableNow", await_termination=True)
    assert sorted(r.id for r in spark.read.parquet(bronze).collect()) == ["1", "2", "3"]


def test_truncates_of_a_stream_end_what_is_open_and_late_ones_count(spark, scratch):
    inbox, root = f"{scratch}/in", f"{scratch}/t"
    batches = [[message(1, 1000, seq=1), message(2, 2000, seq=2)], [message(1, 9000, "u", seq=5), message(0, 5000, "t", seq=4), '{"op":"t"}'],
               [message(0, 3000, "t", seq=3), message(2, 9500, "d", seq=6)]]
    for batch in batches:
        send(spark, inbox, batch)
        for _ in range(2):
            stream_scd2(spark, {"path": inbox}, root, f"{scratch}/ckpt", fields=DEFAULT_FIELDS, seq_field="lsn", truncates=True).awaitTermination()
    found = {(r["id"], r["valid_from"].second): (r["valid_to"].year, r["valid_to"].second, r["is_current"]) for r in read_truncated_table(spark, root, seq_field="lsn").collect()}
    assert found == {("1", 1): (1970, 3, False), ("2", 2): (1970, 3, False), ("1", 9): (9999, 0, True)}
    assert [r["reason"] for r in spark.read.parquet(f"{root}/quarantine").collect()] == ["unsupported op"]   # a truncate without a time


# --- the mart ---------------------------------------------------------------------------------------

def random_loads(spark, seed, n_loads=4):
    """Loads and, after each, the orders and lines that are live."""
    rnd, live = random.Random(seed), {}
    for n in range(1, n_loads + 1):
        changed = {}
        for _ in range(40):
            o = rnd.randint(1, 60)
            if o in live and rnd.random() < 0.3:
                changed[o] = ("DELETE", live[o][0], [])
            else:
                changed[o] = (rnd.choice(["INSERT", "UPDATE"]), rnd.choice([None, *range(1, 9)]),
                              [(o, i, rnd.randint(100, 9999) / 100, rnd.randint(0, 10) / 100) for i in range(rnd.randint(0, 3))])
        for o, (action, cust, lines) in changed.items():
            live.pop(o, None)
            if action != "DELETE":
                live[o] = (cust, lines)
        orders = spark.createDataFrame([(o, c, a) for o, (a, c, _) in changed.items()], "o_orderkey long, o_custkey long, action string")
        lines = spark.createDataFrame([x for _, _, ls in changed.values() for x in ls], "l_orderkey long, l_linenumber int, l_extendedprice double, l_discount double")
        yield n, orders, lines, dict(live)


def recompute(spark, live):
    customer = spark.createDataFrame([(i, f"c{i}") for i in range(1, 9)], "c_custkey long, c_name string")
    orders = spark.createDataFrame([(o, c) for o, (c, _) in live.items()], "o_orderkey long, o_custkey long")
    lines = spark.createDataFrame([x for _, ls in live.values() for x in ls], "l_orderkey long, l_linenumber int, l_extendedprice double, l_discount double")
    return customer, sorted(map(tuple, top_users(customer, orders, lines, n=100).collect()))


def rounded(df):
    return sorted((r[0], r[1], r[2], round(r[3], 2)) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_the_mart_equals_the_recompute_after_every_load(spark, scratch, seed):
    for n, orders, lines, live in random_loads(spark, seed):
        for _ in range(2):   # the repeat does nothing
            commit_orders(spark, scratch, orders, lines, n)
        customer, want = recompute(spark, live)
        assert rounded(read_top_users(spark, scratch, customer)) == want
        top = [tuple(r) for r in read_top_users(spark, scratch, customer, 3).collect()]
        assert [t[0] for t in top] == [w[0] for w in sorted(want, key=lambda w: (-w[3], w[0]))[:3]]


@pytest.mark.parametrize("dies_at", [1, 2, 3])
def test_a_killed_load_is_invisible_and_repaired_by_its_repeat(spark, scratch, monkeypatch, dies_at):
    loads = list(random_loads(spark, 3, 2))
    commit_orders(spark, scratch, loads[0][1], loads[0][2], 1)
    customer, before = recompute(spark, loads[0][3])
    calls, real, mark = [], state.set_layout, state._set_mark

    def killed(*args):
        calls.append(1)
        if len(calls) == dies_at or (dies_at == 3 and args[2] == "committed"):
            raise OSError("lost")
        return (mark if args[2] in ("begun", "committed") else real)(*args)

    monkeypatch.setattr(state, "set_layout", killed if dies_at < 3 else real)
    monkeypatch.setattr(state, "_set_mark", mark if dies_at < 3 else killed)
    with pytest.raises(OSError):
        commit_orders(spark, scratch, loads[1][1], loads[1][2], 2)
    monkeypatch.setattr(state, "set_layout", real)
    monkeypatch.setattr(state, "_set_mark", mark)
    assert rounded(read_top_users(spark, scratch, customer)) == before
    with pytest.raises(RuntimeError):
        commit_orders(spark, scratch, loads[1][1], loads[1][2], 3)
    commit_orders(spark, scratch, loads[1][1], loads[1][2], 2)
    assert rounded(read_top_users(spark, scratch, customer)) == recompute(spark, loads[1][3])[1]


def test_only_buckets_of_changed_customers_are_read_and_written(spark, scratch, monkeypatch):
    monkeypatch.setattr(state, "BUCKET_BYTES", 300)
    orders = spark.range(400).select(F.col("id").alias("o_orderkey"), (F.col("id") % 200).alias("o_custkey"), F.lit("INSERT").alias("action"))
    lines = spark.range(400).select(F.col("id").alias("l_orderkey"), F.lit(10.0).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"))
    commit_orders(spark, scratch, orders, lines, 1)
    monkeypatch.setattr(state, "BUCKET_BYTES", 256 << 20)
    parts = set(glob.glob(f"{scratch}/customers/bucket=*/v=*"))
    read, real = [], state.read_buckets
    monkeypatch.setattr(state, "read_buckets", lambda s, p, lay, only=None: (read.append((p.rsplit("/", 1)[1], only)), real(s, p, lay, only))[1])
    # the customer of order 7 does not change, that of order 8 does
    commit_orders(spark, scratch, orders.where("o_orderkey IN (7, 8)").withColumn("o_custkey", F.expr("IF(o_orderkey = 8, 9, o_custkey)")), lines, 2)
    assert len(parts) > 4
    assert all(len(only) <= 2 for _, only in read) and {p for p, _ in read} == {"orders", "customers"}
    assert len(set(glob.glob(f"{scratch}/customers/bucket=*/v=*")) - parts) <= 2
    sums = {r["c_custkey"]: (r["n_orders"], r["revenue"]) for r in read_top_users(spark, scratch, spark.range(200).select(
        F.col("id").alias("c_custkey"), F.col("id").cast("string").alias("c_name"))).collect()}
    assert (sums[7], sums[8], sums[9]) == ((2, 18.0), (1, 9.0), (3, 27.0))
    assert mart.LINE == "decimal(18,4)"
