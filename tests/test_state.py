"""The bucketed state: crashes, sizes, checks; the dated state of load type ``scd4``; run-date binding."""

from __future__ import annotations

import datetime as dt
import glob
import random

import pytest
from change_log import LOG_SCHEMA, literal_rows

from tidemark.operators import latest_current, scd2_from_log
from tidemark.plans import run_spec
from tidemark.plans.spec import _bind
from tidemark.sinks import commit_scd2_batch, fold_state, read_scd2_table, read_state, write_files
from tidemark.sinks import state as state_module


def log(spark, rows):
    return spark.createDataFrame(literal_rows(rows), LOG_SCHEMA)


def random_rows(n, seed):
    rnd = random.Random(seed)
    return [(i, rnd.randint(1, 25), rnd.choice(["INSERT", "UPDATE", "DELETE"]), f"2024-01-0{1 + rnd.randint(0, 4)} 1{rnd.randint(0, 9)}:00:00") for i in range(n)]


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def live(state):
    return state.where("action <> 'DELETE'").drop("seq")


@pytest.mark.parametrize("step", ["write_buckets", "set_layout", "write_small", "remove"])
def test_a_fold_killed_at_any_step_is_repaired_by_its_repeat(spark, scratch, monkeypatch, step):
    rows = random_rows(120, 1)
    first, second, third = log(spark, rows[:60]), log(spark, rows[60:90]), log(spark, rows[90:])
    fold_state(spark, scratch, first, buckets=4)
    fold_state(spark, scratch, first)   # so that there are older parts to remove
    before, real = rows_of(read_state(spark, scratch)), getattr(state_module, step)
    calls = []

    def killed(*args, **kwargs):
        calls.append(1)
        if step == "write_buckets":   # the files are there, nothing else is
            real(*args, **kwargs)
        raise OSError("lost")

    monkeypatch.setattr(state_module, step, killed)
    with pytest.raises(OSError):
        fold_state(spark, scratch, second)
    monkeypatch.setattr(state_module, step, real)
    assert calls and (step == "remove" or rows_of(read_state(spark, scratch)) == before)
    fold_state(spark, scratch, second)
    fold_state(spark, scratch, third)
    assert rows_of(live(read_state(spark, scratch))) == rows_of(latest_current(log(spark, rows)))


def test_a_commit_killed_after_its_parts_were_written_keeps_every_key(spark, scratch, monkeypatch):
    rows = sorted(random_rows(150, 2), key=lambda r: (r[3], r[0]))
    real = state_module.set_layout
    for n, part in enumerate([rows[:60], rows[60:110], rows[110:]], start=1):
        if n > 1:
            before = rows_of(read_scd2_table(spark, scratch))
            monkeypatch.setattr(state_module, "set_layout", lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                commit_scd2_batch(spark, scratch, log(spark, part), n)
            monkeypatch.setattr(state_module, "set_layout", real)
            assert rows_of(read_scd2_table(spark, scratch)) == before
        commit_scd2_batch(spark, scratch, log(spark, part), n, buckets=3)
    assert rows_of(read_scd2_table(spark, scratch)) == rows_of(scd2_from_log(log(spark, rows)))


def test_a_reader_opened_before_a_fold_still_reads(spark, scratch):
    rows = random_rows(40, 3)
    reader = fold_state(spark, scratch, log(spark, rows[:20]))
    before = rows_of(reader)
    fold_state(spark, scratch, log(spark, rows[20:]))
    assert rows_of(reader) == before


def test_another_number_of_buckets_or_other_keys_are_errors(spark, scratch):
    rows = log(spark, random_rows(30, 4))
    fold_state(spark, f"{scratch}/s", rows, buckets=8)
    for wrong in ({"buckets": 16}, {"keys": ("id", "name")}):
        with pytest.raises(ValueError):
            fold_state(spark, f"{scratch}/s", rows, **wrong)
    commit_scd2_batch(spark, f"{scratch}/t", rows, 1, buckets=8)
    with pytest.raises(ValueError):
        commit_scd2_batch(spark, f"{scratch}/t", rows, 2, buckets=16)
    commit_scd2_batch(spark, f"{scratch}/t", rows, 2, buckets=8)   # the refused call has not begun the batch


def test_buckets_follow_the_size_of_the_state(spark, scratch, monkeypatch):
    small = random_rows(30, 5)
    fold_state(spark, scratch, log(spark, small))
    assert len(glob.glob(f"{scratch}/bucket=*")) == 1
    monkeypatch.setattr(state_module, "BUCKET_BYTES", 1500)   # as if the state had grown
    more = [(1000 + i, 100 + i, "INSERT", "2024-01-03 10:00:00") for i in range(200)]
    for part in (more[:150], more[150:]):
        fold_state(spark, scratch, log(spark, part))
    layout = state_module._layout(spark, scratch)
    assert layout["buckets"] > 1 and len(layout["parts"]) > 1
    assert rows_of(live(read_state(spark, scratch))) == rows_of(latest_current(log(spark, small + more)))


def test_the_first_write_of_a_large_state_is_dealt_by_its_size(spark, scratch, monkeypatch):
    monkeypatch.setattr(state_module, "BUCKET_BYTES", 1500)
    rows = [(i, i, "INSERT", "2024-01-03 10:00:00") for i in range(300)]
    fold_state(spark, scratch, log(spark, rows))
    assert state_module._layout(spark, scratch)["buckets"] > 1 and read_state(spark, scratch).count() == 300


def test_only_two_layouts_and_their_parts_stay(spark, scratch):
    for i in range(5):
        fold_state(spark, scratch, log(spark, [(i, 1, "UPDATE", f"2024-01-0{i + 1} 10:00:00")]))
    assert len(glob.glob(f"{scratch}/bucket=0/v=*")) == 2 and len(glob.glob(f"{scratch}/_layout/*")) == 2


def test_current_by_a_state_equals_current_from_history_at_every_run_date(spark, scratch):
    """Rows dated after the run date, late rows, a run for an earlier date and a repeated load."""
    rows = random_rows(200, 6)
    runs = [(rows[:50], "2024-01-02"), (rows[50:90], "2024-01-03"), (rows[90:130], "2024-01-02"), (rows[90:130], "2024-01-02"),
            (rows[130:170], "2024-01-04"), (rows[170:], "2024-01-05")]
    for n, (part, as_of) in enumerate(runs):
        frame = write_files(spark, log(spark, part), f"{scratch}/in{n}")
        found = []
        for kind, state in (("a", {}), ("b", {"path_state": f"{scratch}/state"})):
            run_spec(spark, {"extract_dfs": {"c": {"type": "read_file", "file_path": frame}}, "load": {"c": {
                "type": "scd4", "path_hist": f"{scratch}/{kind}/hist", "path_current": f"{scratch}/{kind}/cur", "tie": ["seq"],
                "partition_by": "partition_date", "load_id": [0, 1, 2, 2, 4, 5][n], **state}}}, as_of=as_of)
            found.append(rows_of(spark.read.parquet(f"{scratch}/{kind}/cur")))
        assert found[0] == found[1]


def test_binding_skips_literals_comments_and_raw_strings(spark):
    day = dt.date(2024, 1, 2)
    bound = "DATE '2024-01-02'"
    for text in [r"name rlike '\w' AND d <= :as_of AND a = 'INSERT'", "SELECT 1 -- it's :as_of here\n, :as_of", r"a = r'\' AND d = :as_of",
                 "/* don't */ :as_of", "x = 'it\\'s :as_of' OR d = :as_of", "\"a\\\"b\" = :as_of", "'' = :as_of"]:
        assert bound in _bind(text, day)
    assert _bind("SELECT 1 -- it's :as_of here\n, :as_of", day) == f"SELECT 1 -- it's :as_of here\n, {bound}"
    frame = spark.createDataFrame([("a1", dt.date(2024, 1, 1), "INSERT"), ("b", dt.date(2024, 1, 5), "INSERT")], "name string, d date, a string")
    assert frame.where(_bind(r"name rlike '\\w' AND d <= :as_of AND a = 'INSERT'", day)).count() == 1
