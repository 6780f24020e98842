from __future__ import annotations

import copy
import datetime as dt
import json
import os

import pytest
from change_log import LOG_SCHEMA, SF
from pyspark.sql import functions as F

from tidemark.plans import STEPS, run_spec, run_stages
from tidemark.scenarios import LOG_EXPRS
from tidemark.sinks import write_files, write_table
from tidemark.sources import read_as_of, read_file, read_partition
from tidemark.sources.jdbc import jdbc_options, one_day
from tidemark.streaming import read_scd2_table, stream_scd2, stream_to_bronze


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_read_prunes_and_keeps_column(spark, literal_log, scratch):
    path = write_files(spark, literal_log, f"{scratch}/bronze", partition_by="partition_date")
    day = read_partition(spark, path, as_of="2024-01-02")
    assert "partition_date" in day.columns and day.count() == 6
    assert "PartitionFilters: [isnotnull(partition_date" in _plan(day)
    upto = read_as_of(spark, path, date_column="partition_date", as_of="2024-01-02")
    assert upto.count() == 9


def test_latency_resolves_relative_to_today(spark, literal_log, scratch):
    today = dt.date.today()
    rows = [(1, 1, "n", "e", "INSERT", dt.datetime.combine(today - dt.timedelta(days=4), dt.time()),
             today - dt.timedelta(days=4))]
    path = write_files(spark, spark.createDataFrame(rows, LOG_SCHEMA), f"{scratch}/b", partition_by="partition_date")
    assert read_partition(spark, path, latency=-4).count() == 1
    assert read_partition(spark, path, latency=-3).count() == 0


def test_dynamic_overwrite_replaces_only_present_partitions(spark, literal_log, scratch):
    path = write_files(spark, literal_log, f"{scratch}/b", partition_by="partition_date")
    day = literal_log.filter("partition_date = DATE'2024-01-02'").withColumn("name", F.lit("rerun"))
    write_files(spark, day, path, partition_by="partition_date", mode="overwrite")
    back = spark.read.parquet(path)
    assert back.count() == 11
    assert back.filter("name = 'rerun'").count() == 6


def test_write_table_catalog_modes(spark, literal_log):
    spark.sql("DROP TABLE IF EXISTS silver_t.customer_hist")
    write_table(spark, literal_log, table_name="silver_t.customer_hist", mode="overwrite_partitions",
                partition_by="partition_date")
    write_table(spark, literal_log, table_name="silver_t.customer_hist", mode="overwrite_partitions",
                partition_by="partition_date")  # rerun: idempotent
    assert spark.table("silver_t.customer_hist").count() == 11
    write_table(spark, literal_log.limit(2), table_name="silver_t.customer_hist", mode="append",
                partition_by="partition_date")
    assert spark.table("silver_t.customer_hist").count() == 13
    # replace from a plan that reads the target itself goes through staging
    me = spark.table("silver_t.customer_hist").filter("action <> 'DELETE'")
    write_table(spark, me, table_name="silver_t.customer_hist", mode="replace", partition_by="partition_date")
    assert spark.table("silver_t.customer_hist").count() == 11


def test_write_table_path_replace_reading_itself(spark, literal_log, scratch):
    path = f"{scratch}/cur"
    write_table(spark, literal_log, path=path, mode="replace")
    me = spark.read.parquet(path).filter("id = 1")
    write_table(spark, me, path=path, mode="replace")
    assert spark.read.parquet(path).count() == 5
    # dynamic partition overwrite of a path the plan reads is staged too
    write_table(spark, literal_log, path=f"{scratch}/h", mode="overwrite_partitions", partition_by="partition_date")
    again = spark.read.parquet(f"{scratch}/h").filter("partition_date = DATE'2024-01-02'")
    write_table(spark, again, path=f"{scratch}/h", mode="overwrite_partitions", partition_by="partition_date")
    assert spark.read.parquet(f"{scratch}/h").count() == 11


def test_csv_reader_keeps_strings(spark, scratch):
    spark.read.parquet(f"{SF}/nation.parquet").write.option("header", "true").csv(f"{scratch}/csv")
    df = read_file(spark, f"{scratch}/csv", file_format="csv")
    assert df.columns == ["n_nationkey", "n_name", "n_regionkey"]
    assert {f.dataType.typeName() for f in df.schema.fields} == {"string"}


def test_jdbc_options_and_day_filter(spark, literal_log):
    opts = jdbc_options("jdbc:x", "public.customer", {"user": "u"}, "id", 0, 100, 8)
    assert opts["numPartitions"] == "8" and opts["partitionColumn"] == "id" and opts["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")
    assert one_day(literal_log, "updated_timestamp", dt.date(2024, 1, 2)).count() == 6


# --- specs ------------------------------------------------------------------------------------------

def _spec(events_path):
    return {
        "extract_dfs": {"log": {"type": "read_file", "file_path": events_path}},
        "transform_dfs": {"log": [
            {"op": "selectExpr", "args": {"exprs": LOG_EXPRS}},
            {"op": "filter", "args": {"condition": "partition_date <= :as_of"}},
            {"op": "latest_current", "args": {"keys": ["id"], "tie": ["seq"]}},
        ]},
    }


def test_spec_is_not_mutated_and_can_run_twice(spark):
    spec = _spec(f"{SF}/events.parquet")
    frozen = copy.deepcopy(spec)
    a = run_spec(spark, spec, as_of="2024-01-15")["log"].count()
    b = run_spec(spark, spec, as_of="2024-01-15")["log"].count()
    assert spec == frozen and a == b > 0


def test_spec_rejects_unknown_steps(spark):
    spec = _spec(f"{SF}/events.parquet")
    spec["transform_dfs"]["log"].append({"op": "rdd", "args": {}})
    with pytest.raises(ValueError, match="not allowed"):
        run_spec(spark, spec, as_of="2024-01-15")
    assert "eval" not in STEPS


def test_spec_transform_keeps_extracted_frames(spark):
    spec = {"extract_dfs": {"a": {"type": "read_file", "file_path": f"{SF}/nation.parquet"},
                            "b": {"type": "read_file", "file_path": f"{SF}/region.parquet"}},
            "transform_dfs": {"a": [{"op": "sql", "args": {"view_name": "n", "query":
                                     "SELECT n.n_name, b.r_name FROM n JOIN b ON n.n_regionkey = b.r_regionkey"}}]}}
    frames = run_spec(spark, spec)
    assert set(frames) == {"a", "b"} and frames["a"].count() == 25


class _ClassTransform:
    def __init__(self, frames):
        self.frames = frames

    def transform(self):
        return {"top": self.frames["n"].limit(3)}


def test_spec_callable_and_class_transforms(spark):
    base = {"extract_dfs": {"n": {"type": "read_file", "file_path": f"{SF}/nation.parquet"}}}
    out = run_spec(spark, {**base, "transform_dfs": lambda frames, ctx: {"x": frames["n"].filter("n_regionkey = 1")}})
    assert out["x"].count() == 5
    out = run_spec(spark, {**base, "transform_dfs": _ClassTransform})
    assert out["top"].count() == 3


def test_spec_load_kinds_and_stages(spark, scratch):
    events = f"{SF}/events.parquet"
    cur, hist = f"{scratch}/cur", f"{scratch}/hist"
    stage1 = {
        "extract_dfs": {"c": {"type": "read_file", "file_path": events}},
        "transform_dfs": {"c": [{"op": "selectExpr", "args": {"exprs": LOG_EXPRS}},
                                {"op": "latest_current", "args": {"tie": ["seq"]}},
                                {"op": "withColumn", "args": {"colName": "partition_date", "col": ":as_of"}}]},
        "load": {"c": {"type": "scd4a_current", "path": cur, "partition_by": "partition_date"}},
    }
    stage2 = {
        "extract_dfs": {"h": {"type": "read_iceberg", "file_path": cur, "date_column": "partition_date"}},
        "load": {"h": {"type": "scd4a_hist", "path": hist, "partition_by": "partition_date",
                       "mode": "overwrite_partitions"}},
    }
    run_stages(spark, [stage1, stage2], as_of="2024-01-20")
    run_stages(spark, [stage1, stage2], as_of="2024-01-20")  # rerun is idempotent
    n_cur = spark.read.parquet(cur).count()
    assert n_cur > 0 and spark.read.parquet(hist).count() == n_cur


# --- streaming --------------------------------------------------------------------------------------

def _write_msgs(path, name, msgs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write("\n".join(msgs) + "\n")


def _env(op, key, ts_ms, lsn, name="n"):
    img = {"id": str(key), "name": name, "email": "e"}
    body = {"before": img if op in ("u", "d") else None, "after": img if op != "d" else None,
            "op": op, "source": {"ts_ms": ts_ms, "lsn": lsn}}
    return json.dumps({"payload": body})


def test_stream_to_bronze_restart_and_quarantine(spark, scratch):
    inbox, bronze, ckpt, quar = (f"{scratch}/{n}" for n in ("inbox", "bronze", "ckpt", "quar"))
    day = 86_400_000
    _write_msgs(inbox, "a.json", [_env("c", 1, 1704103200000, 1), "broken", _env("t", 1, 1704103200000, 2)])
    for q in stream_to_bronze(spark, {"path": inbox}, bronze, ckpt, quarantine_path=quar):
        q.awaitTermination()
    _write_msgs(inbox, "b.json", [_env("u", 1, 1704103200000 + day, 3), _env("u", 2, 1704103200000 - 5 * day, 4)])
    for q in stream_to_bronze(spark, {"path": inbox}, bronze, ckpt, quarantine_path=quar):
        q.awaitTermination()
    out = spark.read.parquet(bronze)
    assert out.count() == 3  # no duplicates after the restart
    parts = {r[0] for r in out.select("partition_date").distinct().collect()}
    assert dt.date(2023, 12, 27) in parts  # the late change has its own old partition
    assert spark.read.parquet(quar).count() == 2


def test_stream_scd2_batches(spark, scratch):
    inbox, target, ckpt = (f"{scratch}/{n}" for n in ("inbox", "t", "ckpt"))
    t = 1704103200000
    _write_msgs(inbox, "a.json", [_env("c", 1, t, 1, "a"), _env("u", 1, t + 1000, 2, "b"), _env("c", 2, t, 3, "x")])
    stream_scd2(spark, {"path": inbox}, target, ckpt, seq_field="lsn").awaitTermination()
    _write_msgs(inbox, "b.json", [_env("d", 1, t + 5000, 4, "b"), _env("u", 2, t + 6000, 5, "y")])
    stream_scd2(spark, {"path": inbox}, target, ckpt, seq_field="lsn").awaitTermination()
    got = sorted((r.id, r.name, r.is_current) for r in read_scd2_table(spark, target).collect())
    assert got == [("1", "a", False), ("1", "b", False), ("2", "x", False), ("2", "y", True)]


def test_spec_latency_is_relative_to_the_run_date(spark, literal_log, scratch):
    path = write_files(spark, literal_log, f"{scratch}/bronze", partition_by="partition_date")
    spec = {"extract_dfs": {"day": {"type": "read_bronze", "file_path": path, "latency": -1}}}
    assert run_spec(spark, spec, as_of="2024-01-03")["day"].count() == 6   # the 2024-01-02 partition


def test_scd4_load_with_state_folds_current_forward(spark, scratch):
    from tidemark.operators import latest_current
    events = f"{SF}/events.parquet"
    hist, cur, state = (f"{scratch}/{n}" for n in ("hist", "cur", "state"))

    def day_spec(day):
        return {
            "extract_dfs": {"c": {"type": "read_file", "file_path": events}},
            "transform_dfs": {"c": [{"op": "selectExpr", "args": {"exprs": LOG_EXPRS}},
                                    {"op": "filter", "args": {"condition": "partition_date = :as_of"}}]},
            "load": {"c": {"type": "scd4", "path_hist": hist, "path_current": cur, "path_state": state,
                           "partition_by": "partition_date", "keys": ["id"], "tie": ["seq"], "load_id": day}},
        }

    for day in ("2024-01-10", "2024-01-11", "2024-01-12", "2024-01-12"):  # last run is a rerun
        run_spec(spark, day_spec(day), as_of=day)
    log = spark.read.parquet(events).selectExpr(*LOG_EXPRS).filter(
        "partition_date BETWEEN DATE'2024-01-10' AND DATE'2024-01-12'")
    expected = latest_current(log)
    got = spark.read.parquet(cur).select(*expected.columns)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    assert spark.read.parquet(hist).count() == log.count()


class _StubConf:
    def get(self, key, default=None):
        return default


class _StubContext:
    def __init__(self, master):
        self.master = master

    def getConf(self):
        return _StubConf()

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, path):
        self.dir = path


class _StubSession:
    def __init__(self, master):
        self.sparkContext = _StubContext(master)
        self.conf = _StubConf()


def test_cluster_session_without_checkpoint_dir_is_refused():
    from tidemark.session import ensure_checkpoint_dir
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_StubSession("yarn"))
    local = _StubSession("local[2]")
    assert ensure_checkpoint_dir(local) == local.sparkContext.dir  # tests get a local folder


def test_spec_file_entry_point_runs_stages(spark, literal_log, scratch):
    from tidemark.plans import run_spec_file
    src = write_files(spark, literal_log, f"{scratch}/bronze", partition_by="partition_date")
    cur, hist = f"{scratch}/cur", f"{scratch}/hist"
    stages = [
        {"extract_dfs": {"c": {"type": "read_as_of", "file_path": src, "date_column": "partition_date"}},
         "transform_dfs": {"c": [{"op": "latest_current", "args": {"keys": ["id"], "tie": ["seq"]}}]},
         "load": {"c": {"type": "table", "path": cur, "mode": "replace"}}},
        {"extract_dfs": {"h": {"type": "read_file", "file_path": cur}},
         "load": {"h": {"type": "table", "path": hist, "mode": "append"}}},
    ]
    spec_path = f"{scratch}/job.json"
    with open(spec_path, "w") as fh:
        json.dump(stages, fh)
    run_spec_file(spark, spec_path, as_of="2024-01-04")
    assert sorted(r.id for r in spark.read.parquet(hist).collect()) == [1, 2, 4, 5]


def test_stream_spec_resumes_from_its_topic_checkpoint(spark, scratch):
    from tidemark.scenarios import ENVELOPE_FIELDS, change_log, envelopes
    from tidemark.session import scratch_path
    from tidemark.streaming import run_stream_spec
    inbox, bronze = f"{scratch}/inbox", f"{scratch}/bronze"
    topic = scratch_path(spark, "topic").rsplit("/", 1)[-1]  # a fresh checkpoint name for this run
    spec = {"extract": {"path": inbox}, "load": {"topic": topic, "format": "parquet", "path": bronze,
                                                 "partition_by": "partition_date"}}
    log = change_log(spark, SF)
    first, second = log.filter("partition_date <= DATE'2024-01-10'"), log.filter("partition_date > DATE'2024-01-10'")
    envelopes(first).write.mode("append").text(inbox)
    run_stream_spec(spark, spec, fields=ENVELOPE_FIELDS, trigger="availableNow", await_termination=True)
    envelopes(second).write.mode("append").text(inbox)
    run_stream_spec(spark, spec, fields=ENVELOPE_FIELDS, trigger="availableNow", await_termination=True)
    assert spark.read.parquet(bronze).count() == log.count()  # each envelope once: the restart resumed


def test_stream_spec_scd2_type_keeps_the_scd2_table(spark, scratch):
    from tidemark.operators import scd2_from_log
    from tidemark.scenarios import ENVELOPE_FIELDS, change_log, envelopes
    from tidemark.session import scratch_path
    from tidemark.streaming import read_scd2_table, run_stream_spec
    inbox, target = f"{scratch}/inbox", f"{scratch}/scd2"
    topic = scratch_path(spark, "topic").rsplit("/", 1)[-1]
    spec = {"extract": {"path": inbox},
            "load": {"type": "scd2", "topic": topic, "path": target, "seq_field": "lsn"}}
    log = change_log(spark, SF)
    for part in (log.filter("partition_date <= DATE'2024-01-10'"), log.filter("partition_date > DATE'2024-01-10'")):
        envelopes(part).write.mode("append").text(inbox)
        run_stream_spec(spark, spec, fields=ENVELOPE_FIELDS, trigger="availableNow", await_termination=True)
    from tidemark.functions.temporal import millis_to_ntz
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    in_ms = log.withColumn("updated_timestamp",  # envelopes carry epoch milliseconds
                           millis_to_ntz(F.timestamp_diff("MILLISECOND", epoch, F.col("updated_timestamp"))))
    got, want = read_scd2_table(spark, target), scd2_from_log(in_ms)
    got = got.select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
