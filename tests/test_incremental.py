"""Incremental paths against the whole log: several batches a day, late rows, ties across batches, null keys,
deletes of unknown keys, crashes and replays."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from change_log import LOG_SCHEMA, literal_rows
from pyspark.sql import functions as F

from tidemark.operators import closed_intervals, fold_latest, latest_current, open_intervals, scd2_apply, scd2_from_log, scd2_step
from tidemark.operators.envelope import normalize_envelope
from tidemark.plans import run_spec
from tidemark.plans.spec import _bind
from tidemark.sinks import commit_scd2_batch, fold_state, read_late, read_scd2_state, read_scd2_table, write_files, write_table
from tidemark.sinks import state as state_module


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def log_rows(seed, n=160):
    """Few instants, so batches cut through ties; null keys; first changes that are deletes."""
    rnd = random.Random(seed)
    rows = []
    for seq in range(n):
        t = dt.datetime(2024, 1, 1 + rnd.randint(0, 4), 6 * rnd.randint(0, 3))
        key = None if rnd.random() < 0.15 else rnd.randint(1, 12)
        rows.append((seq, key, f"n{seq}", "e", rnd.choice(["INSERT", "UPDATE", "DELETE", "DELETE"]), t, t.date()))
    return sorted(rows, key=lambda r: (r[5], r[0]))


def batches_of(rows, seed):
    rnd = random.Random(seed)
    cuts = sorted(rnd.sample(range(1, len(rows)), 4))
    return [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]


@pytest.mark.parametrize("seed, split_rows, floor", [(1, 10**6, None), (2, 3, None), (3, 10**6, 0), (4, 3, 0)])
def test_commits_equal_the_full_log_for_any_batching(spark, scratch, monkeypatch, seed, split_rows, floor):
    from tidemark.operators import touched
    monkeypatch.setattr(touched, "MAX_TOUCHED_SHARE", float("inf"))
    rows = log_rows(seed)
    for n, part in enumerate(batches_of(rows, seed), start=1):
        late = commit_scd2_batch(spark, scratch, spark.createDataFrame(part, LOG_SCHEMA), n, split_rows=split_rows, buckets=5, min_state_rows=floor)
        assert late.count() == 0
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    assert same(read_scd2_table(spark, scratch), scd2_from_log(log))
    assert read_scd2_state(spark, scratch).count() == log.select("id").distinct().count()


@pytest.mark.parametrize("split_rows", [10**6, 3])
def test_apply_with_state_equals_the_full_log(spark, split_rows):
    rows = log_rows(9)
    table = state = None
    for part in batches_of(rows, 9):
        batch = spark.createDataFrame(part, LOG_SCHEMA)
        new, late = scd2_apply(table, batch, split_rows=split_rows, state=state)
        assert late.count() == 0
        state, _ = fold_latest(state, batch)
        table = spark.createDataFrame(new.collect(), new.schema)
        state = spark.createDataFrame(state.collect(), state.schema)
    assert same(table, scd2_from_log(spark.createDataFrame(rows, LOG_SCHEMA)))
    again, late = scd2_apply(table, batch, split_rows=split_rows, state=state)   # a replay is a no-op
    assert same(again, table) and late.count() == batch.count()


def test_step_reports_late_rows_and_remembers_deletes_of_unknown_keys(spark):
    log = lambda rows: spark.createDataFrame(literal_rows(rows), LOG_SCHEMA).drop("partition_date")
    step = scd2_step(None, log([(5, 1, "DELETE", "2024-01-05 10:00:00")]))
    state = step.where("__next IS NULL").drop("__next", "__late")
    step = scd2_step(state, log([(1, 1, "INSERT", "2024-01-04 10:00:00"), (6, 1, "DELETE", "2024-01-05 10:00:00")]))
    assert [r.seq for r in step.where("__late").collect()] == [1]
    assert closed_intervals(step).count() == 0
    new = step.where("NOT __late AND __next IS NULL").drop("__next", "__late")
    assert [r.seq for r in new.collect()] == [6] and open_intervals(new).count() == 0


def test_insert_then_delete_of_one_instant_in_two_batches_closes(spark, scratch):
    for n, row in enumerate([(1, 1, "INSERT", "2024-01-01 10:00:00"), (2, 1, "DELETE", "2024-01-01 10:00:00")], start=1):
        commit_scd2_batch(spark, scratch, spark.createDataFrame(literal_rows([row]), LOG_SCHEMA), n)
    assert read_scd2_table(spark, scratch).where("is_current").count() == 0


def test_a_crash_before_the_marker_shows_nothing_and_is_repaired_by_a_replay(spark, scratch, monkeypatch):
    first = spark.createDataFrame(literal_rows([(1, 1, "INSERT", "2024-01-01 10:00:00"), (2, 2, "INSERT", "2024-01-01 10:00:00")]), LOG_SCHEMA)
    second = spark.createDataFrame(literal_rows([(3, 1, "UPDATE", "2024-01-02 10:00:00"), (4, 3, "INSERT", "2024-01-02 10:00:00")]), LOG_SCHEMA)
    commit_scd2_batch(spark, scratch, first, 1)
    before = sorted(map(str, read_scd2_table(spark, scratch).collect()))
    mark = state_module._set_mark

    def crash(spark, root, kind, batch_id):
        if kind == "committed":
            raise OSError("lost")
        mark(spark, root, kind, batch_id)

    monkeypatch.setattr(state_module, "_set_mark", crash)
    with pytest.raises(OSError):
        commit_scd2_batch(spark, scratch, second, 2)
    monkeypatch.setattr(state_module, "_set_mark", mark)
    assert sorted(map(str, read_scd2_table(spark, scratch).collect())) == before
    with pytest.raises(RuntimeError):   # batch 2 was begun: nothing else may be built on it
        commit_scd2_batch(spark, scratch, second, 3)
    for _ in range(2):   # a replay of a committed batch does nothing
        commit_scd2_batch(spark, scratch, second, 2)
        assert same(read_scd2_table(spark, scratch), scd2_from_log(first.unionByName(second)))


def test_a_batch_rewrites_only_the_buckets_of_its_keys(spark, scratch):
    import glob
    import os
    rows = [(i, i, "INSERT", "2024-01-01 10:00:00") for i in range(60)]
    commit_scd2_batch(spark, scratch, spark.createDataFrame(literal_rows(rows), LOG_SCHEMA), 1, buckets=16)
    files = {f: os.stat(f).st_ino for f in glob.glob(f"{scratch}/state/bucket=*/v=*/*.parquet")}
    commit_scd2_batch(spark, scratch, spark.createDataFrame(literal_rows([(99, 7, "UPDATE", "2024-01-02 10:00:00")]), LOG_SCHEMA), 2, buckets=16)
    now = {f: os.stat(f).st_ino for f in glob.glob(f"{scratch}/state/bucket=*/v=*/*.parquet")}
    bucket = lambda f: os.path.dirname(os.path.dirname(f))
    assert len({bucket(f) for f in files.keys() ^ now.keys()}) == 1 and len({bucket(f) for f in files}) > 8
    assert files.items() <= now.items()   # the part it replaces stays until the next commit


def test_late_rows_are_kept_by_batch(spark, scratch):
    new = spark.createDataFrame(literal_rows([(2, 1, "INSERT", "2024-01-02 10:00:00")]), LOG_SCHEMA)
    old = spark.createDataFrame(literal_rows([(1, 1, "INSERT", "2024-01-01 10:00:00")]), LOG_SCHEMA)
    commit_scd2_batch(spark, scratch, new, 1)
    for _ in range(2):
        assert commit_scd2_batch(spark, scratch, old, 2).count() == 1
    assert read_late(spark, scratch).count() == 1


def test_several_loads_of_a_day_and_a_late_row_all_stay(spark, scratch):
    hist = f"{scratch}/hist"
    loads = [[(1, 1, "INSERT", "2024-01-01 10:00:00"), (2, 2, "INSERT", "2024-01-01 10:00:00")], [(3, 3, "INSERT", "2024-01-01 11:00:00")],
             [(4, 4, "INSERT", "2024-01-02 10:00:00"), (5, 5, "INSERT", "2024-01-01 09:00:00")]]
    for n, rows in [*enumerate(loads), (1, loads[1])]:   # the last is a rerun
        frame = write_files(spark, spark.createDataFrame(literal_rows(rows), LOG_SCHEMA), f"{scratch}/in{n}")
        run_spec(spark, {"extract_dfs": {"c": {"type": "read_file", "file_path": frame}}, "load": {"c": {
            "type": "scd4", "path_hist": hist, "path_current": f"{scratch}/cur", "path_state": f"{scratch}/state", "tie": ["seq"],
            "partition_by": "partition_date", "load_id": n}}}, as_of="2024-01-02")
    assert sorted(r.seq for r in spark.read.parquet(hist).collect()) == [1, 2, 3, 4, 5]
    assert sorted(r.id for r in spark.read.parquet(f"{scratch}/cur").collect()) == [1, 2, 3, 4, 5]


def test_history_kinds_append_to_a_day(spark, scratch):
    for rows in ([(1, 1, "INSERT", "2024-01-01 10:00:00")], [(2, 2, "INSERT", "2024-01-01 11:00:00")]):
        frame = write_files(spark, spark.createDataFrame(literal_rows(rows), LOG_SCHEMA), f"{scratch}/in{rows[0][0]}")
        run_spec(spark, {"extract_dfs": {"c": {"type": "read_file", "file_path": frame}},
                         "load": {"c": {"type": "scd4_hist", "path": f"{scratch}/hist", "partition_by": "partition_date"}}})
    assert spark.read.parquet(f"{scratch}/hist").count() == 2


def test_folding_a_batch_twice_or_with_null_keys(spark, scratch):
    rows = log_rows(4)
    for part in batches_of(rows, 4):
        for _ in range(2):
            state = fold_state(spark, f"{scratch}/s", spark.createDataFrame(part, LOG_SCHEMA), buckets=7)
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    assert same(state.where("action <> 'DELETE'").drop("seq"), latest_current(log))
    half, rest = spark.createDataFrame(rows[:80], LOG_SCHEMA), spark.createDataFrame(rows[80:], LOG_SCHEMA)
    before = fold_latest(None, half)[0]
    before = spark.createDataFrame(before.collect(), before.schema)
    a, b = fold_latest(before, rest, min_state_rows=0)[1], fold_latest(before, rest)[1]
    assert same(a, b) and same(a, latest_current(log))


def test_two_sinks_one_of_which_replaces_the_source(spark, scratch):
    path = write_files(spark, spark.range(20).withColumn("v", F.lit("a")), f"{scratch}/p")
    run_spec(spark, {"extract_dfs": {"f": {"type": "read_file", "file_path": path}}, "load": {
        "f": {"type": "table", "path": path, "mode": "replace"},
        "copy": {"type": "table", "frame": "f", "path": f"{scratch}/copy", "mode": "replace"}}})
    assert spark.read.parquet(path).count() == spark.read.parquet(f"{scratch}/copy").count() == 20


def test_a_cached_frame_may_replace_its_source(spark, scratch):
    path = write_files(spark, spark.range(20).withColumn("v", F.lit("a")), f"{scratch}/p")
    df = spark.read.parquet(path).where("id < 15").persist()
    write_table(spark, df, path=path, mode="replace")
    df.unpersist()
    assert spark.read.parquet(path).count() == 15


def test_unknown_arguments_and_columns_are_errors(spark, scratch, literal_log):
    path = write_files(spark, literal_log, f"{scratch}/p")
    read = {"c": {"type": "read_file", "file_path": path}}
    for spec in ({"extract_dfs": {"c": {**read["c"], "file_formt": "csv"}}},
                 {"extract_dfs": read, "load": {"c": {"type": "table", "path": f"{scratch}/q", "partition_bye": "id"}}}):
        with pytest.raises(TypeError):
            run_spec(spark, spec)
    with pytest.raises(ValueError):
        fold_latest(literal_log, literal_log.withColumn("extra", F.lit(1)))
    name = f"t_strict_{abs(hash(scratch)) % 10**8}"
    write_table(spark, literal_log, table_name=name)
    try:
        with pytest.raises(ValueError):
            write_table(spark, literal_log.withColumn("extra", F.lit(1)), table_name=name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_the_run_date_is_not_bound_inside_literals_or_names():
    day = dt.date(2024, 1, 2)
    assert _bind("a = :as_of AND b = ':as_of' AND c = \":as_of\" AND d = :as_of_x", day) == (
        "a = DATE '2024-01-02' AND b = ':as_of' AND c = \":as_of\" AND d = :as_of_x")


def test_without_tie_columns_equal_instants_have_one_defined_winner(spark):
    rows = literal_rows([(i, 1, "UPDATE", "2024-01-01 10:00:00") for i in range(1, 30)])
    names = {latest_current(spark.createDataFrame(random.Random(s).sample(rows, 29), LOG_SCHEMA), tie=()).first().name for s in range(4)}
    assert len(names) == 1


def test_envelopes_without_an_image_or_key_are_rejected(spark):
    rows = ['{"op":"d","after":{"id":"1"},"source":{"ts_ms":1}}', '{"op":"u","after":{"name":"x"},"source":{"ts_ms":1}}',
            '{"op":"c","after":{"id":"1"},"source":{"ts_ms":1}}']
    good, bad = normalize_envelope(spark.createDataFrame([(r,) for r in rows], "value string"))
    assert good.count() == 1 and sorted(r.reason for r in bad.collect()) == ["missing key", "missing row image"]


def test_apply_without_hot_keys_shuffles_once(spark, scratch):
    rows = log_rows(3)
    table = write_files(spark, scd2_from_log(spark.createDataFrame(rows[:80], LOG_SCHEMA)), f"{scratch}/t")
    batch = write_files(spark, spark.createDataFrame(rows[80:], LOG_SCHEMA), f"{scratch}/b")
    result, _ = scd2_apply(spark.read.parquet(table), spark.read.parquet(batch))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_sql_steps_see_earlier_views_and_leave_none_behind(spark, literal_log, scratch):
    path = write_files(spark, literal_log, f"{scratch}/p")
    spark.range(3).createOrReplaceTempView("kept")
    spec = {"extract_dfs": {"a": {"type": "read_file", "file_path": path}, "kept": {"type": "read_file", "file_path": path}},
            "transform_dfs": {"a": [
                {"op": "sql", "args": {"view_name": "v1", "query": "SELECT id, count(*) AS n FROM v1 GROUP BY id"}},
                {"op": "sql", "args": {"view_name": "v2", "query": "SELECT v2.id, n, v1.seq FROM v2 JOIN v1 ON v1.id = v2.id JOIN kept ON kept.seq = v1.seq"}}]}}
    assert run_spec(spark, spec)["a"].count() == literal_log.count()
    assert spark.table("kept").count() == 3
    assert not {"a", "v1", "v2"} & {t.name for t in spark.catalog.listTables()}
    spark.catalog.dropTempView("kept")
