"""The registered queries: every operator of the inventory run over the provided tables.

The CDC feed is derived from ``events`` (one change per event):
    id = user_id, name = 'user_<id>', email = 'u<id>@<event_type>',
    action = INSERT for signup, DELETE for error, UPDATE otherwise,
    updated_timestamp = ts, partition_date = date(ts), seq = event_id (tie-break).
Jobs that write (bronze layers, history tables, stream sinks) write under a fresh folder below the
session's ``spark.checkpoint.dir`` and return a DataFrame read back from what they wrote.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.functions.temporal import open_end
from tidemark.functions.vocab import op_from_action
from tidemark.operators import (
    as_of_join,
    as_of_view,
    close_at_truncates,
    current_of_state,
    fold_latest,
    latest_current,
    merge_close_and_insert,
    merge_close_and_insert_with_archive,
    merge_current,
    merge_current_bucketed,
    merge_current_with_history,
    normalize_after_image,
    normalize_envelope,
    normalize_envelope_evolving,
    point_in_time,
    scd2_apply,
    scd2_from_log,
    scd2_init,
    snapshot_changes,
    snapshot_current,
    snapshot_intervals,
    stamp_partition,
    top_users,
    truncate_events,
)
from tidemark.operators.envelope import parse_envelopes
from tidemark.operators.touched import MIN_SPLIT_STATE_ROWS
from tidemark.plans import raw_to_bronze, run_spec, run_spec_file, run_stages
from tidemark.session import scratch_path
from tidemark.sinks import (
    commit_scd2_batch,
    fold_state,
    read_late,
    read_scd2_table,
    read_state,
    write_bucketed,
    write_files,
    write_table,
)
from tidemark.sinks.mart import commit_orders, read_top_users
from tidemark.sources import even_ranges, read_as_of, read_file, read_partition, read_ranges, read_table
from tidemark.streaming import offset_report, read_truncated_table, run_stream_spec, stream_scd2, stream_to_bronze

AS_OF = dt.date(2024, 1, 15)
PREV_DAY = dt.date(2024, 1, 14)
VIEW_AT = "2024-01-15 12:00:00"
HOUR_END = "2024-01-15 01:00:00"

LOG_EXPRS = [
    "user_id AS id",
    "concat('user_', CAST(user_id AS STRING)) AS name",
    "concat('u', CAST(user_id AS STRING), '@', event_type) AS email",
    "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS action",
    "ts AS updated_timestamp",
    "CAST(ts AS DATE) AS partition_date",
    "event_id AS seq",
]

ENVELOPE_FIELDS = StructType([
    StructField("id", LongType()),
    StructField("name", StringType()),
    StructField("email", StringType()),
])
LEGACY_FIELDS = StructType(ENVELOPE_FIELDS.fields + [StructField("update_timestamp", StringType())])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*LOG_EXPRS)


def _day(df: DataFrame, day: dt.date, how: str = "eq") -> DataFrame:
    c = F.col("partition_date")
    return df.filter(c == F.lit(day) if how == "eq" else (c <= F.lit(day) if how == "le" else c >= F.lit(day)))


def write_bronze(spark: SparkSession, sf_dir: str, name: str = "bronze") -> str:
    """The change log as a date-partitioned bronze layer (what the ingestion jobs produce)."""
    return write_files(spark, change_log(spark, sf_dir), scratch_path(spark, name), partition_by="partition_date")


def _open_current(log: DataFrame, as_of: dt.date) -> DataFrame:
    """Current rows with explicit validity: latest live change per key as of a day, open-ended."""
    cur = latest_current(log, as_of=as_of)
    return cur.select("id", "name", "email", "action", F.col("updated_timestamp").alias("valid_from"),
                      open_end().alias("valid_to"))


# --- history / current builders -------------------------------------------------------------------

def q_latest_current(spark, sf_dir):
    return latest_current(change_log(spark, sf_dir), as_of=AS_OF)


def q_latest_current_incremental(spark, sf_dir):
    """The state after day 14, as the previous run left it, folded with day 15's changes (twice: a rerun)."""
    log = change_log(spark, sf_dir)
    state_path = scratch_path(spark, "scd4_state")
    for batch in (_day(log, PREV_DAY, "le"), _day(log, AS_OF), _day(log, AS_OF)):
        state = fold_state(spark, state_path, batch)
    return current_of_state(state)


def _hourly_state(spark, sf_dir, min_state_rows):
    """The state after day 14 and the changes of 00:00-01:00 on day 15, folded; with a floor of 0 rows the fold
    splits the untouched state off (``operators.touched``)."""
    log = change_log(spark, sf_dir)
    state_path = scratch_path(spark, "scd4_state")
    fold_state(spark, state_path, _day(log, PREV_DAY, "le"))
    _new_state, current = fold_latest(read_state(spark, state_path), _first_hour(log), min_state_rows=min_state_rows)
    return current


def q_latest_current_hourly(spark, sf_dir):
    return _hourly_state(spark, sf_dir, MIN_SPLIT_STATE_ROWS)


def q_latest_current_hourly_split(spark, sf_dir):
    return _hourly_state(spark, sf_dir, 0)


def _first_hour(log: DataFrame) -> DataFrame:
    """The changes of 00:00-01:00 on day 15: an hourly batch, which touches a small share of the keys."""
    return _day(log, AS_OF).filter(F.col("updated_timestamp") < F.expr(f"TIMESTAMP_NTZ '{HOUR_END}'"))


def q_scd2_from_log(spark, sf_dir):
    return scd2_from_log(change_log(spark, sf_dir))


def q_scd2_apply(spark, sf_dir):
    log = change_log(spark, sf_dir)
    target = scd2_from_log(_day(log, PREV_DAY, "le"))
    result, _late = scd2_apply(target, _day(log, AS_OF, "ge"))
    return result


def q_scd2_incremental_commits(spark, sf_dir):
    """Three batch commits (days 1-10, 11-20, 21-30) into the history/current layout, read back whole."""
    log = change_log(spark, sf_dir)
    root = scratch_path(spark, "scd2_layout")
    bounds = [dt.date(2024, 1, 1), dt.date(2024, 1, 11), dt.date(2024, 1, 21), dt.date(2100, 1, 1)]
    for batch_id, (lo, hi) in enumerate(zip(bounds, bounds[1:]), start=1):
        batch = log.filter((F.col("partition_date") >= F.lit(lo)) & (F.col("partition_date") < F.lit(hi)))
        commit_scd2_batch(spark, root, batch, batch_id)
    return read_scd2_table(spark, root)


def _hourly_commit(spark, sf_dir, min_state_rows):
    """Days 1-14 committed as one batch, then the first hour of day 15 as the next."""
    log = change_log(spark, sf_dir)
    root = scratch_path(spark, "scd2_layout")
    commit_scd2_batch(spark, root, _day(log, PREV_DAY, "le"), 1)
    commit_scd2_batch(spark, root, _first_hour(log), 2, min_state_rows=min_state_rows)
    return read_scd2_table(spark, root)


def q_scd2_hourly_commit(spark, sf_dir):
    return _hourly_commit(spark, sf_dir, MIN_SPLIT_STATE_ROWS)


def q_scd2_hourly_commit_split(spark, sf_dir):
    return _hourly_commit(spark, sf_dir, 0)


def _coarse_log(spark, sf_dir):
    """The log with change times cut to six hours: many ties per key, resolved by ``seq``; every 17th user has a null id."""
    return change_log(spark, sf_dir).withColumn("updated_timestamp", F.expr(
        "timestampadd(HOUR, CAST(floor(hour(updated_timestamp) / 6) * 6 AS INT), CAST(CAST(updated_timestamp AS DATE) AS TIMESTAMP_NTZ))")).withColumn(
        "id", F.expr("CASE WHEN id % 17 = 0 THEN NULL ELSE id END"))


def q_scd2_any_batching(spark, sf_dir):
    """The log cut by rank inside tied instants into batches of very different size, committed one by one (one of
    them twice), equals SCD2 of the whole log."""
    log = _coarse_log(spark, sf_dir)
    root = scratch_path(spark, "scd2_cuts")
    first = log.agg(F.min("seq").alias("a"), F.max("seq").alias("b")).first()
    ranked = log.withColumn("__pos", F.struct("updated_timestamp", "seq"))
    cuts = log.select("updated_timestamp", "seq").orderBy("updated_timestamp", "seq")
    marks = [r for i, r in enumerate(cuts.where(F.col("seq") % max(1, (first["b"] - first["a"]) // 5) == 3).collect()) if i < 6]
    low = None
    for n, mark in enumerate([*marks, None], start=1):
        batch = ranked
        if low is not None:
            batch = batch.where(F.col("__pos") > F.struct(F.lit(low[0]).alias("updated_timestamp"), F.lit(low[1]).alias("seq")))
        if mark is not None:
            batch = batch.where(F.col("__pos") <= F.struct(F.lit(mark[0]).alias("updated_timestamp"), F.lit(mark[1]).alias("seq")))
        for _ in range(2 if n == 2 else 1):
            commit_scd2_batch(spark, root, batch.drop("__pos"), n)
        low = mark
    return read_scd2_table(spark, root)


def q_scd2_late_rows(spark, sf_dir):
    """Even days committed first, odd days after them: changes not after their key's last one come out as late."""
    log = change_log(spark, sf_dir)
    root = scratch_path(spark, "scd2_late")
    odd = F.dayofmonth("partition_date") % 2 == 1
    commit_scd2_batch(spark, root, log.where(~odd), 1)
    commit_scd2_batch(spark, root, log.where(odd), 2)
    return read_late(spark, root).drop("batch_id")


def q_scd2_apply_state(spark, sf_dir):
    """``scd2_apply`` with the state of the keys, over tied change times, with the partition column."""
    log = _coarse_log(spark, sf_dir)
    before, batch = log.where("seq % 2 = 0 AND partition_date < DATE '2024-01-15'"), log.where("partition_date >= DATE '2024-01-15'")
    state, _ = fold_latest(None, before)
    result, _late = scd2_apply(scd2_from_log(before), batch, state=state, date_column="partition_date")
    return result


def q_scd2_close_only(spark, sf_dir):
    log = change_log(spark, sf_dir)
    result, _late = scd2_apply(scd2_from_log(_day(log, PREV_DAY, "le")), _day(log, AS_OF), close_only=True)
    return result


def q_scd2_init(spark, sf_dir):
    return scd2_init(change_log(spark, sf_dir).drop("seq"), as_of=AS_OF)


def q_scd2_as_of_view(spark, sf_dir):
    return as_of_view(scd2_from_log(change_log(spark, sf_dir)), VIEW_AT)


def q_merge_current(spark, sf_dir):
    log = change_log(spark, sf_dir)
    return merge_current(_open_current(log, PREV_DAY), _day(log, AS_OF))


def q_merge_current_hourly(spark, sf_dir):
    """The SCD4 MERGE with an hourly batch."""
    log = change_log(spark, sf_dir)
    return merge_current(_open_current(log, PREV_DAY), _first_hour(log))


def q_merge_current_hourly_split(spark, sf_dir):
    """The same with the untouched rows split off: its full outer join runs on the touched keys only."""
    log = change_log(spark, sf_dir)
    return merge_current(_open_current(log, PREV_DAY), _first_hour(log), min_state_rows=0)


BUCKETS = 8


def q_merge_current_bucketed(spark, sf_dir):
    """The SCD4 MERGE with a table bucketed by its keys, written bucketed again."""
    name = "tide_" + scratch_path(spark, "x")[-12:]
    log = change_log(spark, sf_dir)
    try:
        write_bucketed(spark, _open_current(log, PREV_DAY).repartition(BUCKETS, "id"), f"{name}.current_1", ["id"], BUCKETS)
        merged = merge_current_bucketed(read_table(spark, f"{name}.current_1"), _day(log, AS_OF), BUCKETS)
        write_bucketed(spark, merged, f"{name}.current_2", ["id"], BUCKETS)
        kept = write_files(spark, read_table(spark, f"{name}.current_2"), scratch_path(spark, "current"))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    return spark.read.parquet(kept)


def _sides(spark, current, history, hist_path):
    """Both halves of an upkeep job: history appended first (one load, repeatable), then the current rows."""
    for _ in range(2):   # a rerun of the load replaces its own rows
        write_table(spark, history, path=hist_path, partition_by="partition_date", load_id=AS_OF.isoformat())
    cols = ["id", "name", "email", "action", "valid_from", "valid_to"]
    return (spark.read.parquet(hist_path).select(*cols).withColumn("side", F.lit("history"))
            .unionByName(current.select(*cols).withColumn("side", F.lit("current"))))


def q_merge_current_with_history(spark, sf_dir):
    log = change_log(spark, sf_dir)
    current, history = merge_current_with_history(_open_current(log, PREV_DAY), _day(log, AS_OF), as_of=AS_OF)
    return _sides(spark, current, history, scratch_path(spark, "scd4_hist"))


def q_merge_close_and_insert_with_archive(spark, sf_dir):
    log = change_log(spark, sf_dir)
    before = _open_current(log, PREV_DAY).withColumn("partition_date", F.lit(PREV_DAY))
    current, archive = merge_close_and_insert_with_archive(before, _day(log, AS_OF), as_of=AS_OF)
    return _sides(spark, current, archive, scratch_path(spark, "scd4a_hist"))


def q_merge_close_and_insert(spark, sf_dir):
    log = change_log(spark, sf_dir)
    return merge_close_and_insert(_open_current(log, PREV_DAY), _day(log, AS_OF), as_of=AS_OF)


def q_snapshot_current(spark, sf_dir):
    return snapshot_current(_day(change_log(spark, sf_dir), AS_OF), as_of=AS_OF)


def daily_snapshots(log: DataFrame) -> DataFrame:
    """The live rows at the end of every day; day 20 was not delivered, and day 7 holds its rows twice."""
    end = _days(log)[-1]
    ends = F.least(F.date_sub(F.to_date("valid_to"), 1), F.lit(end))
    first = F.to_date("valid_from")
    rows = scd2_from_log(log).where(first <= ends).select(
        "id", "name", "email", F.explode(F.sequence(first, ends)).alias("partition_date"))
    rows = rows.where(F.dayofmonth("partition_date") != 20)
    return rows.unionByName(rows.where(F.dayofmonth("partition_date") == 7))


def q_snapshot_changes(spark, sf_dir):
    return snapshot_changes(daily_snapshots(change_log(spark, sf_dir)))


def q_snapshot_intervals(spark, sf_dir):
    return snapshot_intervals(daily_snapshots(change_log(spark, sf_dir)))


# --- readers / writers ------------------------------------------------------------------------------

def q_read_partition_day(spark, sf_dir):
    return read_partition(spark, write_bronze(spark, sf_dir), as_of=AS_OF)


def q_read_as_of(spark, sf_dir):
    return read_as_of(spark, write_bronze(spark, sf_dir), date_column="partition_date", as_of=AS_OF)


def q_even_ranges(spark, sf_dir):
    """The events read range by range over a skewed key: a third of the rows in one value, others null."""
    events = table(spark, sf_dir, "events").select("event_id", F.expr(
        "CASE WHEN user_id % 3 = 0 THEN 1 WHEN user_id % 11 = 0 THEN NULL ELSE user_id END").alias("k"))
    return read_ranges(events, even_ranges(events, "k", 12, split_by="event_id")).drop("range")


def q_raw_to_bronze_incremental(spark, sf_dir):
    """Every day's increment into bronze, the first day twice."""
    raw, path = change_log(spark, sf_dir).drop("partition_date"), scratch_path(spark, "bronze")
    days = _days(change_log(spark, sf_dir))
    for day in [*days, days[0]]:
        raw_to_bronze(spark, raw, path, as_of=day)
    return spark.read.parquet(path)


def q_raw_to_bronze_snapshot(spark, sf_dir):
    """Three days' snapshots of a table into bronze, the last day twice."""
    raw, path = table(spark, sf_dir, "customer"), scratch_path(spark, "bronze")
    for n in (0, 1, 2, 2):
        raw_to_bronze(spark, raw, path, kind="snapshot", as_of=AS_OF, latency=n)
    return spark.read.parquet(path)


def q_bootstrap_bronze(spark, sf_dir):
    """The bronze layer laid down from raw rows by a spec, as the first job of a deployment."""
    path = scratch_path(spark, "bronze")
    run_spec(spark, {"extract_dfs": {"customer": _events_source(sf_dir)},
                     "transform_dfs": {"customer": [{"op": "selectExpr", "args": {"exprs": LOG_EXPRS}}]},
                     "load": {"customer": {"type": "file", "path": path, "mode": "overwrite", "partition_by": "partition_date"}}}, as_of=AS_OF)
    return spark.read.parquet(path)


def q_run_spec_date_sub(spark, sf_dir):
    """The days from four before the run date up to it."""
    spec = {"extract_dfs": {"c": {"type": "read_file", "file_path": write_bronze(spark, sf_dir)}},
            "transform_dfs": {"c": [{"op": "filter", "args": {"condition": "partition_date BETWEEN DATE_SUB(:as_of, 4) AND :as_of"}}]}}
    return run_spec(spark, spec, as_of=AS_OF)["c"]


def q_run_spec_set_steps(spark, sf_dir):
    """The steps exceptAll, intersectAll, replace, pivot and unpivot."""
    src = {"type": "read_file", "file_path": f"{sf_dir.rstrip('/')}/orders.parquet"}
    cols = {"op": "select", "args": {"cols": ["o_custkey AS k", "o_orderstatus AS status", "o_orderpriority AS priority"]}}
    spec = {
        "extract_dfs": {"a": src, "b": src, "orders": src},
        "transform_dfs": {
            "a": [{"op": "filter", "args": {"condition": "o_orderkey % 3 = 0"}}, cols],
            "b": [{"op": "filter", "args": {"condition": "o_orderkey % 2 = 0"}}, cols, {"op": "intersectAll", "args": {"other": "a"}}],
            "orders": [cols, {"op": "exceptAll", "args": {"other": "b"}},
                       {"op": "replace", "args": {"to_replace": {"F": "done", "O": "open"}, "subset": ["status"]}},
                       {"op": "pivot", "args": {"by": "priority", "on": "status", "values": ["done", "open"], "aggs": {"n": "count(*)"}}},
                       {"op": "unpivot", "args": {"ids": "priority", "values": ["done", "open"], "variableColumnName": "status", "valueColumnName": "n"}}],
        },
    }
    return run_spec(spark, spec, as_of=AS_OF)["orders"]


def _upkeep(spark, sf_dir, kind):
    """Both tables of an upkeep load of day 15, run by a spec."""
    log = change_log(spark, sf_dir)
    cur, hist = scratch_path(spark, "current"), scratch_path(spark, "hist")
    first = _open_current(log, PREV_DAY)
    write_files(spark, first.withColumn("partition_date", F.lit(PREV_DAY)) if kind == "scd4a_upkeep" else first, cur)
    bronze = write_files(spark, _day(log, AS_OF), scratch_path(spark, "bronze"))
    run_spec(spark, {"extract_dfs": {"c": {"type": "read_file", "file_path": bronze}}, "load": {"c": {
        "type": kind, "path_current": cur, "path_hist": hist, "tie": ["seq"], "load_id": AS_OF.isoformat(), "partition_by": "partition_date"}}}, as_of=AS_OF)
    cols = ["id", "name", "email", "action", "valid_from", "valid_to"]
    return (spark.read.parquet(hist).select(*cols).withColumn("side", F.lit("history"))
            .unionByName(spark.read.parquet(cur).select(*cols).withColumn("side", F.lit("current"))))


def q_run_spec_scd4_upkeep(spark, sf_dir):
    return _upkeep(spark, sf_dir, "scd4_upkeep")


def q_run_spec_scd4a_upkeep(spark, sf_dir):
    return _upkeep(spark, sf_dir, "scd4a_upkeep")


def q_read_csv_header(spark, sf_dir):
    path = scratch_path(spark, "csv")
    cust = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    cust.write.option("header", "true").mode("overwrite").csv(path)
    return read_file(spark, path, file_format="csv")


def q_csv_to_table(spark, sf_dir):
    """A CSV file with header loaded into a catalog table by a spec."""
    path, name = scratch_path(spark, "csv"), "tide_" + scratch_path(spark, "x")[-12:]
    table(spark, sf_dir, "nation").write.option("header", "true").csv(path)
    try:
        run_spec(spark, {"extract_dfs": {"n": {"type": "read_file", "file_path": path, "file_format": "csv"}},
                         "load": {"n": {"type": "table", "table_name": f"{name}.nation", "mode": "replace"}}})
        kept = write_files(spark, read_table(spark, f"{name}.nation"), scratch_path(spark, "nation"))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    return spark.read.parquet(kept)


def q_sql_partition_scan(spark, sf_dir):
    """A partition-filtered scan inside a SQL step, through a CTE over two frames of the spec."""
    spec = {
        "extract_dfs": {"changes": {"type": "read_file", "file_path": write_bronze(spark, sf_dir)},
                        "customer": {"type": "read_file", "file_path": f"{sf_dir.rstrip('/')}/customer.parquet"}},
        "transform_dfs": {"changes": [{"op": "sql", "args": {"view_name": "day_rows", "query": DAY_MARKET_SQL}}]},
    }
    return run_spec(spark, spec, as_of=AS_OF)["changes"]


DAY_MARKET_SQL = """WITH of_day AS (SELECT id, action FROM day_rows WHERE partition_date = :as_of)
SELECT c_mktsegment, action, count(*) AS n_changes, count(DISTINCT of_day.id) AS n_customers
FROM of_day JOIN customer ON c_custkey = of_day.id GROUP BY c_mktsegment, action"""


def q_run_spec_more_steps(spark, sf_dir):
    """The steps orderBy, limit, distinct, dropDuplicates, fillna, dropna, join and unionByName."""
    src = lambda t: {"type": "read_file", "file_path": f"{sf_dir.rstrip('/')}/{t}.parquet"}
    spec = {
        "extract_dfs": {"orders": src("orders"), "customer": src("customer"), "top": src("customer"), "nation": src("nation")},
        "transform_dfs": {
            "top": [{"op": "orderBy", "args": {"cols": ["c_custkey"]}}, {"op": "limit", "args": {"num": 100}},
                    {"op": "select", "args": {"cols": ["c_custkey AS k", "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS seg"]}}],
            "customer": [{"op": "select", "args": {"cols": ["c_custkey AS k", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS seg"]}},
                         {"op": "dropna", "args": {"subset": ["seg"]}},
                         {"op": "unionByName", "args": {"other": "top"}},
                         {"op": "fillna", "args": {"value": "none", "subset": ["seg"]}},
                         {"op": "distinct", "args": {}}],
            "orders": [{"op": "select", "args": {"cols": ["o_custkey AS k", "o_orderstatus AS status"]}},
                       {"op": "dropDuplicates", "args": {"subset": ["k", "status"]}},
                       {"op": "join", "args": {"other": "customer", "on": "k"}},
                       {"op": "groupBy_agg", "args": {"by": ["seg", "status"], "aggs": {"n": "count(*)"}}}],
        },
    }
    return run_spec(spark, spec, as_of=AS_OF)["orders"]


def q_spec_file(spark, sf_dir):
    """A spec file with a transform given by its dotted path, run from disk."""
    path = scratch_path(spark, "spec")
    spec = {"extract_dfs": {"orders": {"type": "read_file", "file_path": f"{sf_dir.rstrip('/')}/orders.parquet"}},
            "transform_dfs": "tidemark.scenarios.order_summaries"}
    spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.text(path)
    return run_spec_file(spark, path, as_of=AS_OF)["by_status"]


def q_run_stream_spec(spark, sf_dir):
    """The streaming entry point: the bronze layer that a stream spec fills."""
    inbox, bronze = scratch_path(spark, "inbox"), scratch_path(spark, "spec_bronze")
    envelopes(change_log(spark, sf_dir)).write.text(inbox)
    spec = {"extract": {"path": inbox}, "load": {"topic": scratch_path(spark, "t")[-12:], "path": bronze}}
    run_stream_spec(spark, spec, fields=ENVELOPE_FIELDS, trigger="availableNow", await_termination=True)
    return spark.read.parquet(bronze).drop("batch_id")


def q_write_dynamic_overwrite(spark, sf_dir):
    log = change_log(spark, sf_dir)
    path = write_files(spark, log, scratch_path(spark, "bronze"), partition_by="partition_date")
    # rerun of one day: only that partition is replaced, the others stay
    write_files(spark, _day(log, AS_OF), path, partition_by="partition_date", mode="overwrite")
    return spark.read.parquet(path)


def q_append_history(spark, sf_dir):
    log = change_log(spark, sf_dir)
    hist = scratch_path(spark, "hist")
    days = _days(log)
    for load, part in ((1, days[:10]), (2, days[10:20]), (3, days[20:]), (2, days[10:20])):  # the last is a rerun
        rows = stamp_partition(log.where(F.col("partition_date").isin(part)))
        write_table(spark, rows, path=hist, partition_by="partition_date", load_id=load)
    return spark.read.parquet(hist).drop("load_id")


def _hour_batches(log):
    """Three loads of one day and, in the third, late rows of older days."""
    hour = F.hour("updated_timestamp")
    day, old = F.col("partition_date") == F.lit(AS_OF), F.col("partition_date") < F.lit(AS_OF)
    late = old & (F.col("seq") % 7 == 0)
    return [log.where(old & ~late), log.where(day & (hour < 8)), log.where(day & (hour >= 8) & (hour < 16)), log.where((day & (hour >= 16)) | late)]


def _scd4_multi_batch_day(spark, sf_dir, with_state):
    hist, cur, state = (scratch_path(spark, n) for n in ("scd4_hist", "scd4_current", "scd4_state"))
    for n, batch in enumerate([*_hour_batches(change_log(spark, sf_dir)), None]):
        n, batch = (n, batch) if batch is not None else (2, _hour_batches(change_log(spark, sf_dir))[2])   # load 2 again
        bronze = write_files(spark, batch, scratch_path(spark, "bronze"), partition_by="partition_date")
        run_spec(spark, {"extract_dfs": {"c": {"type": "read_file", "file_path": bronze}}, "load": {"c": {
            "type": "scd4", "path_hist": hist, "path_current": cur, "partition_by": "partition_date", "keys": ["id"], "tie": ["seq"],
            "load_id": n, **({"path_state": state} if with_state else {})}}}, as_of=AS_OF)
    cols = ["id", "name", "email", "action", "updated_timestamp", "partition_date"]
    return (spark.read.parquet(hist).select(*cols).withColumn("sink", F.lit("hist"))
            .unionByName(spark.read.parquet(cur).select(*cols).withColumn("sink", F.lit("current"))))


def q_scd4_multi_batch_day(spark, sf_dir):
    """Several loads of one day and late rows on old days through load type ``scd4``."""
    return _scd4_multi_batch_day(spark, sf_dir, False)


def q_scd4_multi_batch_day_state(spark, sf_dir):
    return _scd4_multi_batch_day(spark, sf_dir, True)


def _days(log):
    """The days of the log, in order (one row per day)."""
    return [r[0] for r in log.select("partition_date").distinct().orderBy("partition_date").collect()]


def q_catalog_kinds(spark, sf_dir):
    """All table kinds as catalog tables (create, append, replace) over all days, then read back by name."""
    name = "tide_" + scratch_path(spark, "x")[-12:]
    log = change_log(spark, sf_dir)
    base = f"{name}.customer"
    last = _days(log)[-1]
    views = [(day, write_files(spark, _day(log, last, how) if how == "eq" else log.where(F.col("partition_date") < F.lit(last)), scratch_path(spark, "rows")))
             for day, how in ((last - dt.timedelta(days=1), "lt"), (last, "eq"))]
    out = None
    try:
        for kind in ("scd2", "scd4_hist", "scd4a_hist", "scd4_current", "scd4a_current"):
            for day, view in views:
                run_spec(spark, {"extract_dfs": {"c": {"type": "read_file", "file_path": view}},
                                 "load": {"c": {"type": kind, "table_name": base, "partition_by": "partition_date"}}}, as_of=day)
            part = read_table(spark, f"{base}_{kind}").withColumn("kind", F.lit(kind))
            out = part if out is None else out.unionByName(part)
        kept = write_files(spark, out, scratch_path(spark, "kinds"))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    return spark.read.parquet(kept)


def q_snapshot_append(spark, sf_dir):
    """Every day's snapshot: current replaced, then appended to the history."""
    log = change_log(spark, sf_dir)
    current, hist = scratch_path(spark, "scd4a_current"), scratch_path(spark, "scd4a_hist")
    for day in _days(log):
        write_table(spark, snapshot_current(_day(log, day), as_of=day), path=current, mode="replace",
                    partition_by="partition_date")
        write_table(spark, read_as_of(spark, current, date_column="partition_date", as_of=day), path=hist,
                    mode="overwrite_partitions", partition_by="partition_date")
    return spark.read.parquet(hist)


# --- envelopes and streams ------------------------------------------------------------------------

def envelopes(log: DataFrame, legacy: bool = False) -> DataFrame:
    """Change envelopes built from the log: even ``seq`` wrapped in ``payload``, odd ones bare."""
    op = op_from_action(F.col("action"))
    fields = [F.col("id"), F.col("name"), F.col("email")]
    if legacy:
        fields.append(F.date_format("updated_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("update_timestamp"))
    image = F.struct(*fields)
    ms = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("updated_timestamp"))
    body = F.struct(
        F.when(op != "c", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        op.alias("op"),
        F.struct(ms.alias("ts_ms"), F.col("seq").alias("lsn")).alias("source"),
    )
    value = F.when(F.col("seq") % 2 == 0, F.to_json(F.struct(body.alias("payload")))).otherwise(F.to_json(body))
    return log.select(value.alias("value"))


def q_normalize_envelope(spark, sf_dir):
    good, _quarantine = normalize_envelope(envelopes(change_log(spark, sf_dir)), fields=ENVELOPE_FIELDS)
    return good


def q_normalize_envelope_quarantine(spark, sf_dir):
    """Envelopes mixed with messages that are JSON but not envelopes (the events' ``props``)."""
    mixed = envelopes(change_log(spark, sf_dir)).unionByName(
        table(spark, sf_dir, "events").select(F.col("props").alias("value")))
    _good, quarantine = normalize_envelope(mixed, fields=ENVELOPE_FIELDS)
    return quarantine


def q_normalize_after_image(spark, sf_dir):
    return normalize_after_image(envelopes(change_log(spark, sf_dir), legacy=True), fields=LEGACY_FIELDS)


def drifting_envelopes(log: DataFrame) -> DataFrame:
    """Envelopes whose images change: from day 11 on with a number ``tier``, from day 21 on with text in ``id`` and ``tier``."""
    ms = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("updated_timestamp"))
    d, op, out = F.dayofmonth("partition_date"), op_from_action(F.col("action")), None
    old, mid = F.struct("id", "name", "email"), F.struct("id", "name", "email", (F.col("seq") % 5).alias("tier"))
    new = F.struct(F.concat(F.lit("u"), F.col("id")).alias("id"), "name", "email", F.lit("gold").alias("tier"))
    for image, days in ((old, d <= 10), (mid, (d > 10) & (d <= 20)), (new, d > 20)):
        body = F.struct(F.when(op != "c", image).alias("before"), F.when(op != "d", image).alias("after"), op.alias("op"), F.struct(ms.alias("ts_ms")).alias("source"))
        part = log.where(days).select(F.to_json(F.struct(body.alias("payload"))).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def q_normalize_envelope_evolving(spark, sf_dir):
    good, _quarantine, _fields = normalize_envelope_evolving(drifting_envelopes(change_log(spark, sf_dir)))
    return good


def _write_envelope_ranges(spark, sf_dir, inbox):
    """Yield after each arrival: the envelope files of days 1-10, 11-20 and 21-30 land in turn."""
    log = change_log(spark, sf_dir)
    bounds = [dt.date(2024, 1, 1), dt.date(2024, 1, 11), dt.date(2024, 1, 21), dt.date(2100, 1, 1)]
    for lo, hi in zip(bounds, bounds[1:]):
        part = log.filter((F.col("partition_date") >= F.lit(lo)) & (F.col("partition_date") < F.lit(hi)))
        envelopes(part).write.mode("append").text(inbox)
        yield


def q_stream_to_bronze(spark, sf_dir):
    inbox, bronze = scratch_path(spark, "inbox"), scratch_path(spark, "stream_bronze")
    ckpt = scratch_path(spark, "ckpt")
    for _ in _write_envelope_ranges(spark, sf_dir, inbox):
        # each arrival is picked up by a restart from the same checkpoint (exactly-once file sink)
        for q in stream_to_bronze(spark, {"path": inbox}, bronze, ckpt, fields=ENVELOPE_FIELDS):
            q.awaitTermination()
    return spark.read.parquet(bronze).drop("batch_id")


def q_stream_to_bronze_quarantine(spark, sf_dir):
    """Good and rejected messages of one stream, which parses each message once."""
    inbox, bronze = scratch_path(spark, "inbox"), scratch_path(spark, "stream_bronze")
    log = change_log(spark, sf_dir)
    (envelopes(log).unionByName(table(spark, sf_dir, "events").select(F.col("props").alias("value")))
     .unionByName(log.select(F.expr("""'{"op":"d","source":{"ts_ms":1},"seq":' || seq || '}'""").alias("value")))).write.text(inbox)
    for q in stream_to_bronze(spark, {"path": inbox}, bronze, scratch_path(spark, "ckpt"), fields=ENVELOPE_FIELDS):
        q.awaitTermination()
    return spark.read.parquet(f"{bronze}_quarantine").drop("batch_id")


def q_stream_scd2(spark, sf_dir):
    inbox, target = scratch_path(spark, "inbox"), scratch_path(spark, "stream_scd2")
    ckpt = scratch_path(spark, "ckpt")
    for _ in _write_envelope_ranges(spark, sf_dir, inbox):
        stream_scd2(spark, {"path": inbox}, target, ckpt, fields=ENVELOPE_FIELDS,
                    seq_field="lsn").awaitTermination()
    return read_scd2_table(spark, target)


def q_stream_dedup(spark, sf_dir):
    """Three arrivals, each drained by a restart from the checkpoint: the second and third also bring everything of the
    arrival before again, and all bring some messages twice."""
    inbox, bronze, ckpt = (scratch_path(spark, n) for n in ("inbox", "stream_bronze", "ckpt"))
    log = change_log(spark, sf_dir)
    days = _days(log)
    before = None
    for part in (days[:10], days[10:20], days[20:]):
        new = log.where(F.col("partition_date").isin(part))
        sent = envelopes(new).unionByName(envelopes(new.where(F.col("seq") % 3 == 0)))
        (sent if before is None else sent.unionByName(envelopes(before))).write.mode("append").text(inbox)
        for q in stream_to_bronze(spark, {"path": inbox}, bronze, ckpt, fields=ENVELOPE_FIELDS, dedup_within="1 day"):
            q.awaitTermination()
        before = new
    return spark.read.parquet(bronze).drop("batch_id")


def q_stream_offset_ranges(spark, sf_dir):
    """The ledger of a stream in three arrivals: some offsets are missing, some come again with the next arrival."""
    inbox, bronze, ledger, ckpt = (scratch_path(spark, n) for n in ("inbox", "stream_bronze", "ledger", "ckpt"))
    log = change_log(spark, sf_dir).withColumn("partition", (F.col("id") % 4).cast("int"))
    log = log.withColumn("offset", F.col("seq") * 2 + F.col("partition")).where("seq % 211 <> 0")
    days, again = _days(log), None
    for part in (days[:10], days[10:20], days[20:]):
        new = log.where(F.col("partition_date").isin(part))
        sent = new if again is None else new.unionByName(again)
        # an envelope beside its position
        value = F.to_json(F.struct(F.lit("c").alias("op"), F.struct("id", "name", "email").alias("after"), F.struct(F.lit(1).alias("ts_ms")).alias("source")))
        sent.select(value.alias("value"), "partition", "offset").write.mode("append").parquet(inbox)
        source = {"path": inbox, "file_format": "parquet", "schema": "value string, partition int, offset long", "position": True}
        for q in stream_to_bronze(spark, source, bronze, ckpt, fields=ENVELOPE_FIELDS, ledger_path=ledger):
            q.awaitTermination()
        again = new.where("seq % 97 = 0")
    return offset_report(spark.read.parquet(ledger))


TRUNCATE_EVERY, TRUNCATE_REST = 997, 5


def truncate_messages(log: DataFrame) -> DataFrame:
    """A truncate message at the position of every ``TRUNCATE_EVERY``-th change."""
    ms = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("updated_timestamp"))
    body = F.struct(F.lit("t").alias("op"), F.struct(ms.alias("ts_ms"), F.col("seq").alias("lsn")).alias("source"))
    return log.where(F.col("seq") % TRUNCATE_EVERY == TRUNCATE_REST).select(F.to_json(body).alias("value"))


def q_scd2_with_truncates(spark, sf_dir):
    """Intervals of a log with truncates: built from the whole log, and by a stream in three arrivals whose truncates
    come one arrival late."""
    log = change_log(spark, sf_dir)
    parsed = parse_envelopes(envelopes(log).unionByName(truncate_messages(log)), "value", ENVELOPE_FIELDS, "lsn")
    good, _quarantine = normalize_envelope(parsed, "value", ENVELOPE_FIELDS, seq_field="lsn", parsed=True, truncates=True)
    whole = scd2_from_log(good.drop("operation").withColumn("change_seq", F.col("seq")))
    whole = close_at_truncates(whole, truncate_events(parsed, seq_field="lsn"), tie=("seq",), position=("change_seq",))
    inbox, target, ckpt = (scratch_path(spark, n) for n in ("inbox", "stream_scd2", "ckpt"))
    days, late = _days(log), None
    for part in (days[:10], days[10:20], days[20:], []):
        new = log.where(F.col("partition_date").isin(part)) if part else log.limit(0)
        sent = envelopes(new) if late is None else envelopes(new).unionByName(truncate_messages(late))
        sent.write.mode("append").text(inbox)
        stream_scd2(spark, {"path": inbox}, target, ckpt, fields=ENVELOPE_FIELDS, seq_field="lsn", truncates=True).awaitTermination()
        late = new
    batches = read_truncated_table(spark, target, seq_field="lsn")
    return (whole.withColumn("built_from", F.lit("log")).unionByName(batches.withColumn("built_from", F.lit("batches")))
            .drop("change_seq"))


def q_as_of_join(spark, sf_dir):
    """The last click before every purchase, and the first after it."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = events.where("event_type = 'click'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("click"))
    found = as_of_join(bought, clicks, ["user_id"], "ts", "at", ("click",), "last_", exact=False)
    return as_of_join(found, clicks, ["user_id"], "ts", "at", ("click",), "next_", exact=False, direction="forward")


def q_point_in_time(spark, sf_dir):
    """Every purchase with the customer's row as it was at that time."""
    log = change_log(spark, sf_dir)
    facts = log.where("seq % 2 = 0").select("seq", "id", F.expr("updated_timestamp - INTERVAL '1' HOUR").alias("at"))
    dim = scd2_from_log(log).select("id", "email", "action", "valid_from", "valid_to")
    return point_in_time(facts, dim, ["id"], "at")


# --- declarative specs ------------------------------------------------------------------------------

def _events_source(sf_dir):
    return {"type": "read_file", "file_path": f"{sf_dir.rstrip('/')}/events.parquet", "file_format": "parquet"}


LATEST_SQL = """WITH newest AS (SELECT id, max(struct(updated_timestamp, seq, name, email, action, partition_date)) AS last
                FROM changes GROUP BY id)
SELECT id, last.name, last.email, last.action, last.updated_timestamp, last.partition_date
FROM newest WHERE last.action <> 'DELETE'"""


def q_run_spec_sql_step(spark, sf_dir):
    spec = {
        "extract_dfs": {"users": _events_source(sf_dir)},
        "transform_dfs": {"users": [
            {"op": "selectExpr", "args": {"exprs": LOG_EXPRS}},
            {"op": "filter", "args": {"condition": "partition_date <= :as_of"}},
            {"op": "sql", "args": {"query": LATEST_SQL, "view_name": "changes"}},
        ]},
    }
    return run_spec(spark, spec, as_of=AS_OF)["users"]


def q_run_spec_steps(spark, sf_dir):
    spec = {
        "extract_dfs": {"changes": _events_source(sf_dir)},
        "transform_dfs": {"changes": [
            {"op": "withColumn", "args": {"colName": "partition_date", "col": "to_date(ts)"}},
            {"op": "filter", "args": {"condition": "partition_date = :as_of OR event_type IN ('signup', 'error')"}},
            {"op": "withColumn", "args": {"colName": "action", "col":
                "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END"}},
            {"op": "withColumnRenamed", "args": {"existing": "user_id", "new": "id"}},
            {"op": "drop", "args": {"cols": ["props", "value"]}},
            {"op": "select", "args": {"cols": ["id", "action", "ts AS updated_timestamp", "partition_date"]}},
            {"op": "groupBy_agg", "args": {"by": ["id", "action", "partition_date"],
                                           "aggs": {"n_changes": "count(*)",
                                                    "last_change": "max(updated_timestamp)"}}},
        ]},
    }
    return run_spec(spark, spec, as_of=AS_OF)["changes"]


def order_summaries(frames, ctx):
    """A whole-spec transform: two summaries of the orders frame."""
    orders = frames["orders"]
    by_status = orders.groupBy(F.col("o_orderstatus").alias("grp")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    by_priority = orders.groupBy(F.col("o_orderpriority").alias("grp")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return {"by_status": by_status, "by_priority": by_priority}


def q_run_spec_callable(spark, sf_dir):
    spec = {
        "extract_dfs": {"orders": {"type": "read_file", "file_path": f"{sf_dir.rstrip('/')}/orders.parquet"}},
        "transform_dfs": order_summaries,
    }
    frames = run_spec(spark, spec, as_of=AS_OF)
    return (frames["by_status"].withColumn("kind", F.lit("status"))
            .unionByName(frames["by_priority"].withColumn("kind", F.lit("priority"))))


def q_multi_sink(spark, sf_dir):
    hist, cur, copy = (scratch_path(spark, n) for n in ("scd4_hist", "scd4_current", "bronze_copy"))
    spec = {
        "extract_dfs": {"customer_scd4": _events_source(sf_dir)},
        "transform_dfs": {"customer_scd4": [
            {"op": "selectExpr", "args": {"exprs": LOG_EXPRS}},
            {"op": "filter", "args": {"condition": "partition_date <= :as_of"}},
        ]},
        "load": {
            "customer_scd4": {"type": "scd4", "path_hist": hist, "path_current": cur,
                              "partition_by": "partition_date", "keys": ["id"], "tie": ["seq"]},
            "bronze_copy": {"type": "file", "frame": "customer_scd4", "path": copy,
                            "partition_by": "partition_date", "mode": "overwrite"},
        },
    }
    run_spec(spark, spec, as_of=AS_OF)
    cols = ["id", "name", "email", "action", "updated_timestamp", "partition_date"]
    return (spark.read.parquet(hist).select(*cols).withColumn("sink", F.lit("hist"))
            .unionByName(spark.read.parquet(cur).select(*cols).withColumn("sink", F.lit("current")))
            .unionByName(spark.read.parquet(copy).select(*cols).withColumn("sink", F.lit("copy"))))


def q_two_stage_snapshot(spark, sf_dir):
    cur, hist = scratch_path(spark, "scd4a_current"), scratch_path(spark, "scd4a_hist")
    stage_current = {
        "extract_dfs": {"customer_scd4a_current": _events_source(sf_dir)},
        "transform_dfs": {"customer_scd4a_current": [
            {"op": "selectExpr", "args": {"exprs": LOG_EXPRS}},
            {"op": "filter", "args": {"condition": "partition_date <= :as_of"}},
            {"op": "latest_current", "args": {"keys": ["id"], "tie": ["seq"]}},
            {"op": "withColumn", "args": {"colName": "partition_date", "col": ":as_of"}},
        ]},
        "load": {"customer_scd4a_current": {"type": "table", "path": cur, "mode": "replace",
                                            "partition_by": "partition_date"}},
    }
    stage_history = {
        "extract_dfs": {"customer_scd4a_hist": {"type": "read_as_of", "file_path": cur,
                                                "date_column": "partition_date"}},
        "transform_dfs": {},
        "load": {"customer_scd4a_hist": {"type": "table", "path": hist, "mode": "overwrite_partitions",
                                         "partition_by": "partition_date"}},
    }
    run_stages(spark, [stage_current, stage_history], as_of=AS_OF)
    return spark.read.parquet(hist)


# --- gold ---------------------------------------------------------------------------------------------

def q_top_users(spark, sf_dir):
    return top_users(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"),
                     table(spark, sf_dir, "lineitem"), n=10)



def _order_loads(orders, lines):
    """Three loads of changed orders with their lines: two thirds of the orders; the others, and every fifth replaced by
    a version for another customer with fewer lines; every seventh deleted, and every tenth as it was."""
    key = F.col("o_orderkey")
    plain = orders.select("o_orderkey", "o_custkey", F.lit("INSERT").alias("action"))
    moved = orders.where(key % 5 == 0).select("o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"), F.lit("UPDATE").alias("action"))
    first, rest = plain.where(key % 3 != 0), plain.where(key % 3 == 0)
    yield first, lines
    yield (rest.where(key % 5 != 0).unionByName(moved),
           lines.where("l_orderkey % 5 <> 0 OR l_linenumber <= 2"))
    yield (plain.where((key % 7 == 0) | (key % 10 == 0)).withColumn("action", F.when(key % 7 == 0, "DELETE").otherwise("UPDATE"))), lines


def q_top_users_incremental(spark, sf_dir):
    """The whole mart after three loads, the second of which is committed twice."""
    root = scratch_path(spark, "mart")
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    for n, (changed, of_them) in enumerate(_order_loads(orders, lines), start=1):
        for _ in range(2 if n == 2 else 1):
            commit_orders(spark, root, changed, of_them, n)
    return read_top_users(spark, root, table(spark, sf_dir, "customer"))


QUERIES = {
    "latest_current": q_latest_current,
    "latest_current_incremental": q_latest_current_incremental,
    "latest_current_hourly": q_latest_current_hourly,
    "scd2_from_log": q_scd2_from_log,
    "scd2_apply": q_scd2_apply,
    "scd2_incremental_commits": q_scd2_incremental_commits,
    "scd2_hourly_commit": q_scd2_hourly_commit,
    "scd2_as_of_view": q_scd2_as_of_view,
    "merge_current": q_merge_current,
    "merge_current_hourly": q_merge_current_hourly,
    "merge_close_and_insert": q_merge_close_and_insert,
    "snapshot_current": q_snapshot_current,
    "read_partition_day": q_read_partition_day,
    "read_as_of": q_read_as_of,
    "read_csv_header": q_read_csv_header,
    "write_dynamic_overwrite": q_write_dynamic_overwrite,
    "append_history": q_append_history,
    "snapshot_append": q_snapshot_append,
    "two_stage_snapshot": q_two_stage_snapshot,
    "normalize_envelope": q_normalize_envelope,
    "normalize_envelope_quarantine": q_normalize_envelope_quarantine,
    "normalize_after_image": q_normalize_after_image,
    "stream_to_bronze": q_stream_to_bronze,
    "stream_scd2": q_stream_scd2,
    "run_spec_sql_step": q_run_spec_sql_step,
    "run_spec_steps": q_run_spec_steps,
    "run_spec_callable": q_run_spec_callable,
    "multi_sink": q_multi_sink,
    "top_users": q_top_users,
    "latest_current_hourly_split": q_latest_current_hourly_split,
    "scd2_hourly_commit_split": q_scd2_hourly_commit_split,
    "scd2_any_batching": q_scd2_any_batching,
    "scd2_late_rows": q_scd2_late_rows,
    "scd2_apply_state": q_scd2_apply_state,
    "scd2_close_only": q_scd2_close_only,
    "scd2_init": q_scd2_init,
    "merge_current_hourly_split": q_merge_current_hourly_split,
    "merge_current_with_history": q_merge_current_with_history,
    "merge_close_and_insert_with_archive": q_merge_close_and_insert_with_archive,
    "scd4_multi_batch_day": q_scd4_multi_batch_day,
    "scd4_multi_batch_day_state": q_scd4_multi_batch_day_state,
    "catalog_kinds": q_catalog_kinds,
    "csv_to_table": q_csv_to_table,
    "sql_partition_scan": q_sql_partition_scan,
    "run_spec_more_steps": q_run_spec_more_steps,
    "spec_file": q_spec_file,
    "run_stream_spec": q_run_stream_spec,
    "stream_to_bronze_quarantine": q_stream_to_bronze_quarantine,
    "stream_dedup": q_stream_dedup,
    "scd2_with_truncates": q_scd2_with_truncates,
    "as_of_join": q_as_of_join,
    "point_in_time": q_point_in_time,
    "top_users_incremental": q_top_users_incremental,
    "snapshot_changes": q_snapshot_changes,
    "snapshot_intervals": q_snapshot_intervals,
    "merge_current_bucketed": q_merge_current_bucketed,
    "stream_offset_ranges": q_stream_offset_ranges,
    "normalize_envelope_evolving": q_normalize_envelope_evolving,
    "even_ranges": q_even_ranges,
    "raw_to_bronze_incremental": q_raw_to_bronze_incremental,
    "raw_to_bronze_snapshot": q_raw_to_bronze_snapshot,
    "bootstrap_bronze": q_bootstrap_bronze,
    "run_spec_date_sub": q_run_spec_date_sub,
    "run_spec_set_steps": q_run_spec_set_steps,
    "run_spec_scd4_upkeep": q_run_spec_scd4_upkeep,
    "run_spec_scd4a_upkeep": q_run_spec_scd4a_upkeep,
}
