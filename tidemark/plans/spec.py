"""Declarative job specs: ``extract_dfs`` -> ``transform_dfs`` -> ``load``.

    {
      "extract_dfs":   {"<frame>": {"type": "<reader>", ...reader args}},
      "transform_dfs": {"<frame>": [{"op": "<step>", "args": {...}}, ...]}   # or a callable / dotted path
      "load":          {"<frame or sink name>": {"type": "<sink kind>", ...writer args}}
    }

* Steps come from an allow-list (``STEPS``); expressions are Spark SQL strings given to ``F.expr``
  (nothing is ``eval``ed).  The reserved parameter ``:as_of`` is the run date.
* ``sql`` registers every frame of the spec as a temp view under its name (and the current frame
  under ``view_name``) and replaces the current frame with the query result.
* A transform may instead be a callable ``f(frames, ctx) -> frames`` or the dotted path of one
  (a class taking ``frames`` with a ``transform()`` method is accepted too).
* Load entries pick a writer by ``type``; a frame read by several sinks is computed once.  Arguments that a reader, step or
  writer does not know are errors.
* The spec is never mutated, so one spec can be run any number of times.
"""

from __future__ import annotations

import copy
import datetime as dt
import importlib
import inspect
import json
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.temporal import day_window_filter, resolve_as_of
from tidemark.operators.merge import merge_close_and_insert_with_archive, merge_current_with_history
from tidemark.operators.scd import current_of_state, latest_current
from tidemark.session import scratch_path
from tidemark.sinks import TABLE_KINDS, fold_state, state_note, write_files, write_table
from tidemark.sources import READERS

Frames = dict[str, DataFrame]


# raw and plain literals, quoted names and comments are skipped
_PARAMETER = re.compile(r"""\b[rR]'[^']*'|\b[rR]"[^"]*"|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|(?<![\w:]):as_of\b""", re.S)


def _bind(text: str, as_of: dt.date) -> str:
    """The run date for the parameter ``:as_of``; literals, quoted names, comments and longer names stay as
    they are."""
    return _PARAMETER.sub(lambda m: f"DATE '{as_of.isoformat()}'" if m[0] == ":as_of" else m[0], text)


def _expr(text: str | Column, as_of: dt.date) -> Column:
    return text if isinstance(text, Column) else F.expr(_bind(text, as_of))


def _cols(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


# --- transform steps ----------------------------------------------------------------------------

def _with_column(ctx, df, colName, col):
    return df.withColumn(colName, _expr(col, ctx["as_of"]))


def _filter(ctx, df, condition):
    return df.filter(_expr(condition, ctx["as_of"]))


def _drop(ctx, df, cols):
    return df.drop(*_cols(cols))


def _select(ctx, df, cols):
    return df.select(*[_expr(c, ctx["as_of"]) for c in _cols(cols)])


def _select_expr(ctx, df, exprs):
    return df.selectExpr(*[_bind(e, ctx["as_of"]) for e in _cols(exprs)])


def _sql(ctx, df, query, view_name):
    """The frames, the views of earlier ``sql`` steps and the current frame are views while the query is analysed; session
    views they shadow come back afterwards."""
    spark: SparkSession = ctx["spark"]
    ctx["views"] = {**ctx.get("views", {}), view_name: df}
    views = {**ctx["frames"], **ctx["views"]}
    before = {v: spark.table(v) for v in views if any(t.isTemporary for t in spark.catalog.listTables(pattern=v))}
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    try:
        return spark.sql(_bind(query, ctx["as_of"]))
    finally:
        for name in views:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def _limit(ctx, df, num):
    return df.limit(int(num))


def _distinct(ctx, df):
    return df.distinct()


def _drop_duplicates(ctx, df, subset=None):
    return df.dropDuplicates(subset)


def _rename(ctx, df, existing, new):
    return df.withColumnRenamed(existing, new)


def _fillna(ctx, df, value, subset=None):
    return df.fillna(value, subset)


def _dropna(ctx, df, how="any", subset=None):
    return df.dropna(how=how, subset=subset)


def _order_by(ctx, df, cols):
    return df.orderBy(*[_expr(c, ctx["as_of"]) for c in _cols(cols)])


def _join(ctx, df, other, on, how="inner"):
    return df.join(ctx["frames"][other], on=on if isinstance(on, str) else list(on), how=how)


def _union_by_name(ctx, df, other, allowMissingColumns=False):
    return df.unionByName(ctx["frames"][other], allowMissingColumns=allowMissingColumns)


def _except_all(ctx, df, other):
    return df.exceptAll(ctx["frames"][other])


def _intersect_all(ctx, df, other):
    return df.intersectAll(ctx["frames"][other])


def _unpivot(ctx, df, ids, values, variableColumnName, valueColumnName):
    return df.unpivot(_cols(ids), _cols(values), variableColumnName, valueColumnName)


def _pivot(ctx, df, by, on, values, aggs):
    """The values are given, so that no job has to look for them and the columns are known."""
    return df.groupBy(*_cols(by)).pivot(on, list(values)).agg(*[_expr(e, ctx["as_of"]).alias(a) for a, e in aggs.items()])


def _replace(ctx, df, to_replace, value=None, subset=None):
    return df.replace(to_replace, value, subset) if not isinstance(to_replace, dict) else df.replace(to_replace, subset=subset)


def _group_by_agg(ctx, df, by, aggs):
    return df.groupBy(*_cols(by)).agg(*[_expr(e, ctx["as_of"]).alias(a) for a, e in aggs.items()])


def _latest_current(ctx, df, keys=("id",), ts="updated_timestamp", tie=(), action="action"):
    return latest_current(df, keys=_cols(keys), ts=ts, tie=_cols(tie), action=action)


STEPS: dict[str, Callable] = {
    "withColumn": _with_column,
    "filter": _filter,
    "drop": _drop,
    "select": _select,
    "selectExpr": _select_expr,
    "sql": _sql,
    "limit": _limit,
    "distinct": _distinct,
    "dropDuplicates": _drop_duplicates,
    "withColumnRenamed": _rename,
    "fillna": _fillna,
    "dropna": _dropna,
    "orderBy": _order_by,
    "join": _join,
    "unionByName": _union_by_name,
    "exceptAll": _except_all,
    "intersectAll": _intersect_all,
    "unpivot": _unpivot,
    "pivot": _pivot,
    "replace": _replace,
    "groupBy_agg": _group_by_agg,
    "latest_current": _latest_current,
}


def apply_steps(ctx: dict, df: DataFrame, steps: Sequence[Mapping]) -> DataFrame:
    for step in steps:
        op = step["op"]
        if op not in STEPS:
            raise ValueError(f"step {op!r} is not allowed; allowed: {sorted(STEPS)}")
        df = STEPS[op](ctx, df, **dict(step.get("args", {})))
    return df


def _resolve_callable(ref: str | Callable) -> Callable:
    if callable(ref):
        return ref
    module, _, attr = ref.rpartition(".")
    return getattr(importlib.import_module(module), attr)


def transform(spark: SparkSession, frames: Frames, spec_transform, as_of: dt.date) -> Frames:
    ctx = {"spark": spark, "as_of": as_of, "frames": frames}
    if spec_transform is None:
        return dict(frames)
    if isinstance(spec_transform, (str,)) or callable(spec_transform):
        fn = _resolve_callable(spec_transform)
        if isinstance(fn, type):
            out = fn(dict(frames)).transform()
        else:
            out = fn(dict(frames), ctx)
        if not out:
            raise ValueError("transform returned no frames")
        return dict(out)
    out = dict(frames)
    for name, steps in spec_transform.items():
        ctx["frames"] = out
        out[name] = apply_steps(ctx, out[name], steps)
    return out


# --- extract / load -----------------------------------------------------------------------------

def extract(spark: SparkSession, spec_extract: Mapping, as_of: dt.date) -> Frames:
    """Build each named frame with its reader.  The run date ``as_of`` stands in for "today": an
    entry's ``latency`` (signed day offset) is applied to it, an explicit ``as_of`` in the entry wins."""
    frames: Frames = {}
    for name, source in spec_extract.items():
        args = dict(source)
        reader = READERS[args.pop("type")]
        latency = args.pop("latency", None)
        if "as_of" in inspect.signature(reader).parameters:
            args.setdefault("as_of", as_of + dt.timedelta(days=int(latency or 0)))
        frames[name] = reader(spark, **args)
    return frames


def _write_one(spark: SparkSession, df: DataFrame, entry: Mapping, as_of: dt.date) -> None:
    args = dict(entry)
    kind = args.pop("type")
    if kind in ("file", "files"):
        write_files(spark, df, **args)
    elif kind == "table":
        write_table(spark, df, **args)
    elif kind in TABLE_KINDS:
        default_mode, suffix = TABLE_KINDS[kind]
        args.setdefault("mode", default_mode)
        if "table_name" in args:
            args["table_name"] = args["table_name"] + suffix
        write_table(spark, df, **args)
    elif kind == "scd4":
        _write_scd4(spark, df, as_of, **args)
    elif kind in UPKEEP:
        _write_upkeep(spark, df, as_of, kind, **args)
    else:
        raise ValueError(f"unknown load type {kind!r}")


def _write_scd4(spark: SparkSession, df: DataFrame, as_of: dt.date, tbl_hist: str | None = None, path_hist: str | None = None,
                tbl_current: str | None = None, path_current: str | None = None, path_state: str | None = None,
                keys: str | Sequence[str] = ("id",), tie: str | Sequence[str] = (), mode: str = "append",
                load_id: int | str | None = None, partition_by: str | Sequence[str] | None = None,
                format: str = "parquet") -> None:
    """One change batch -> history, then the current table.

    History is appended to; with ``load_id`` a load that is written again replaces its own rows (the load type
    never replaces a day, which may hold rows of other loads).  Current is recomputed from the history up to
    ``as_of`` or, with ``path_state`` (the last change per key, deletes included, in key buckets), folded forward from
    it: O(touched buckets + batch).  The state holds the changes up to the run date it was folded at; a later run adds
    the load's and, from the history, those dated between the two run dates.  Folding a load twice changes nothing; a
    state that was never written is built from the whole history, and a run for an earlier date than the state's
    recomputes current from history.
    """
    keys, tie = _cols(keys), _cols(tie)
    common = {"partition_by": partition_by, "format": format}
    write_table(spark, df, tbl_hist, path_hist, mode=mode, load_id=load_id, **common)
    hist = spark.table(tbl_hist) if path_hist is None else spark.read.format(format).load(path_hist)
    hist = hist.select(*df.columns)
    if path_state is None:
        current = latest_current(hist, keys=keys, tie=tie, as_of=as_of)
    else:
        date, folded = F.col("partition_date"), state_note(spark, path_state)
        upto, rows = as_of, hist
        if folded:
            before = dt.date.fromisoformat(folded["as_of"])
            upto, rows = max(as_of, before), df.unionByName(hist.where(day_window_filter(date, before, "gt")))
        state = fold_state(spark, path_state, rows.where(day_window_filter(date, upto, "le")), keys, tie=tie, note={"as_of": upto.isoformat()})
        current = current_of_state(state, tie=tie) if upto == as_of else latest_current(hist, keys=keys, tie=tie, as_of=as_of)
    write_table(spark, current, tbl_current, path_current, mode="replace", **common)


UPKEEP = {"scd4_upkeep": merge_current_with_history, "scd4a_upkeep": merge_close_and_insert_with_archive}


def _write_upkeep(spark: SparkSession, df: DataFrame, as_of: dt.date, kind: str, path_current: str, path_hist: str,
                  keys: str | Sequence[str] = ("id",), tie: str | Sequence[str] = (), load_id: int | str | None = None,
                  partition_by: str | Sequence[str] | None = None, format: str = "parquet") -> None:
    """One change batch merged into the current table at ``path_current``, which must exist, and the other half of the upkeep
    appended to history first: the batch's deletes (``scd4_upkeep``) or the table as it was (``scd4a_upkeep``).  The new
    current rows are staged before they replace the table that they are read from."""
    current = spark.read.format(format).load(path_current)
    new, history = UPKEEP[kind](current, df, _cols(keys), tie=_cols(tie), as_of=as_of)
    write_table(spark, history, path=path_hist, mode="append", load_id=load_id, partition_by=partition_by, format=format)
    write_table(spark, new.select(*[c for c in current.columns if c in new.columns], *[c for c in new.columns if c not in current.columns]),
                path=path_current, mode="replace", format=format)


def load(spark: SparkSession, frames: Frames, spec_load: Mapping, as_of: dt.date) -> None:
    consumers: dict[str, int] = {}
    for name, entry in spec_load.items():
        src = entry.get("frame", name)
        consumers[src] = consumers.get(src, 0) + 1
    # a frame with several sinks is written once to the shared scratch folder: a sink may replace what it was read from
    for name in [n for n, k in consumers.items() if k > 1]:
        path = scratch_path(spark, "shared-frame")
        frames[name].write.parquet(path)
        frames[name] = spark.read.schema(frames[name].schema).parquet(path)
    for name, entry in spec_load.items():
        entry = {k: v for k, v in entry.items() if k != "frame"}
        _write_one(spark, frames[spec_load[name].get("frame", name)], entry, as_of)


def run_spec(spark: SparkSession, spec: Mapping, as_of: dt.date | str | None = None) -> Frames:
    """Run one spec; returns the transformed frames (loads, if any, have been written)."""
    spec = copy.deepcopy(dict(spec)) if not callable(spec.get("transform_dfs")) else dict(spec)
    run_date = resolve_as_of(as_of)
    frames = extract(spark, spec.get("extract_dfs", {}), run_date)
    frames = transform(spark, frames, spec.get("transform_dfs"), run_date)
    if spec.get("load"):
        load(spark, frames, spec["load"], run_date)
    return frames


def run_stages(spark: SparkSession, specs: Sequence[Mapping], as_of: dt.date | str | None = None) -> Frames:
    """Run dependent specs in list order (e.g. history before current); returns the last frames."""
    frames: Frames = {}
    for spec in specs:
        frames = run_spec(spark, spec, as_of)
    return frames


def read_spec_file(spark: SparkSession, path: str) -> dict | list:
    """A JSON spec from any file system Spark reads (one small job; the spec is configuration, not data)."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def run_spec_file(spark: SparkSession, path: str, as_of: dt.date | str | None = None) -> Frames:
    """The job entry point: run the JSON spec at ``path`` (a list of specs runs as dependent stages)."""
    spec = read_spec_file(spark, path)
    return run_stages(spark, spec, as_of) if isinstance(spec, list) else run_spec(spark, spec, as_of)
