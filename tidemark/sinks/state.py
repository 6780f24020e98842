"""A per-key state kept in key buckets, and an SCD2 table kept up to date by batches.

A state is a folder of Parquet parts ``bucket=<b>/v=<write>/``, a bucket being a hash of the key.  A batch reads the buckets its
keys fall into and writes those anew, beside the old ones; then ``_layout/<n>``, one small file that appears at once, names
the part of every bucket.  So a write that is killed at any point leaves the state of the last layout, for readers
and for the repeat, and no reader meets a missing folder: parts go one commit after they were replaced.

The number of buckets, the keys and the columns are kept in the layout; another number or other keys are an error.  Buckets are
sized to about ``BUCKET_BYTES``: a small state has one, and a state that has outgrown its buckets is dealt anew.  One
writer at a time.

``fold_state`` keeps the last change per key (``operators.fold_latest``).  Folding the same batch again changes
nothing, so a run that failed half-way is simply repeated.

``commit_scd2_batch`` keeps an SCD2 table under ``root``:

    history/batch_id=<n>/   the intervals that batch n closed
    state/                  the last applied change of every key, deletes included; its layout n is that of batch n
    late/batch_id=<n>/      the batch's late rows
    begun/<n>, committed/<n>  the newest batch that was begun and committed

A batch that was begun must be committed before another one.  Readers take history and state of the committed batch, and a
repeat starts from them.  Repeating a committed batch does nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.scd import closed_intervals, fold_latest, open_intervals, scd2_step
from tidemark.operators.sequence import DEFAULT_SPLIT_ROWS
from tidemark.operators.touched import profile_keys, split_touched, touched_keys
from tidemark.session import (
    folder_bytes,
    list_names,
    path_exists,
    read_small,
    remove,
    scratch_path,
    touch,
    write_small,
)

BUCKET_BYTES = 256 << 20


# --- buckets ------------------------------------------------------------------------------------------

def _layouts(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in list_names(spark, f"{path}/_layout") if n.isdigit())


def _layout(spark: SparkSession, path: str, n: int | None = None) -> dict | None:
    """Layout ``n`` of the state, or its newest."""
    if n is None:
        n = max(_layouts(spark, path), default=None)
    return None if n is None else json.loads(read_small(spark, f"{path}/_layout/{n}"))


def _bucket(keys: Sequence[str], buckets: int):  # noqa: ANN202
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def _checked(layout: dict | None, keys: Sequence[str], buckets: int | None) -> dict | None:
    if layout is not None:
        if buckets not in (None, layout["buckets"]):
            raise ValueError(f"the state has {layout['buckets']} buckets, not {buckets}")
        if list(keys) != layout["keys"]:
            raise ValueError(f"the state has the keys {layout['keys']}, not {list(keys)}")
    return layout


def _outgrown(layout: dict) -> bool:
    return not layout["fixed"] and sum(layout["bytes"].values()) > 2 * BUCKET_BYTES * layout["buckets"]


def touched_buckets(batch: DataFrame, layout: dict) -> list[str]:
    """The buckets of the batch's keys; all where the state is to be dealt anew."""
    if layout["buckets"] == 1 or _outgrown(layout):
        return list(layout["parts"])
    rows = batch.select(_bucket(layout["keys"], layout["buckets"])).distinct().collect()   # at most one row per bucket
    return [str(r[0]) for r in rows if str(r[0]) in layout["parts"]]


def read_buckets(spark: SparkSession, path: str, layout: dict, only: Sequence[str] | None = None) -> DataFrame:
    """The rows of the state, or of some of its buckets."""
    schema = StructType.fromJson(layout["schema"])
    parts = [f"{path}/bucket={b}/v={layout['parts'][b]}" for b in (layout["parts"] if only is None else only)]
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*parts).select(*schema.names)


def write_buckets(spark: SparkSession, rows: DataFrame, path: str, keys: Sequence[str], n: int, before: dict | None = None,
                  touched: Sequence[str] = (), buckets: int | None = None, note: dict | None = None) -> dict:
    """Write ``rows``, the new content of the ``touched`` buckets of the layout ``before`` and of new ones, and return layout ``n``,
    which ``set_layout`` makes valid."""
    anew = before is None or _outgrown(before)
    if before is None:
        count, fixed = buckets or 1, buckets is not None
    else:
        count, fixed = before["buckets"], before["fixed"]
        if anew:
            count = -(-sum(before["bytes"].values()) // BUCKET_BYTES)
    while True:
        write = uuid.uuid4().hex[:12]
        (rows.select("*", _bucket(keys, count), F.lit(write).alias("v")).hint("rebalance", "bucket").write.mode("append")
         .partitionBy("bucket", "v").parquet(path))
        made = ({str(b) for b in range(count)} if count == 1 or anew else
                {x.split("=")[1] for x in list_names(spark, path, dirs_only=True) if x.startswith("bucket=")})
        sizes = {b: folder_bytes(spark, f"{path}/bucket={b}/v={write}") for b in made}
        sizes = {b: s for b, s in sizes.items() if s is not None}
        stay = {} if anew else {b: v for b, v in before["parts"].items() if b not in touched}
        layout = {"n": n, "buckets": count, "fixed": fixed, "keys": list(keys), "schema": json.loads(rows.schema.json()), "note": note,
                  "parts": {**stay, **{b: write for b in sizes}},
                  "bytes": {**{b: before["bytes"][b] for b in stay}, **sizes}}
        if not (anew and _outgrown(layout)):
            return layout
        # a first state, or one that has grown much: now its size is known
        first, count = layout, -(-sum(sizes.values()) // BUCKET_BYTES)
        rows = read_buckets(spark, path, first)


def set_layout(spark: SparkSession, path: str, layout: dict) -> None:
    """Make ``layout`` the newest, and remove what neither it nor the one before names."""
    n = layout["n"]
    write_small(spark, f"{path}/_layout/{n}", json.dumps(layout))
    older = [k for k in _layouts(spark, path) if k < n]
    last = _layout(spark, path, older[-1]) if older else {"parts": {}}
    for k in older[:-1]:
        remove(spark, f"{path}/_layout/{k}")
    changed = {b for b, v in layout["parts"].items() if last["parts"].get(b) != v} | (last["parts"].keys() - layout["parts"].keys())
    for b in changed:
        for name in list_names(spark, f"{path}/bucket={b}", dirs_only=True):
            if name.removeprefix("v=") not in (layout["parts"].get(b), last["parts"].get(b)):
                remove(spark, f"{path}/bucket={b}/{name}")


def scratch_copy(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written once to the shared scratch folder: for several readers, safe from lost executors."""
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


# --- the last change per key --------------------------------------------------------------------------

def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    layout = _layout(spark, path.rstrip("/"))
    return None if layout is None else read_buckets(spark, path.rstrip("/"), layout)


def state_note(spark: SparkSession, path: str) -> dict | None:
    """What the last ``fold_state`` noted (empty for nothing); None where there is no state."""
    layout = _layout(spark, path.rstrip("/"))
    return None if layout is None else layout["note"] or {}


def fold_state(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str] = ("id",),
               ts: str = "updated_timestamp", tie: Sequence[str] = ("seq",), action: str = "action",
               buckets: int | None = None, note: dict | None = None) -> DataFrame:
    """Fold a batch into the state at ``path`` and return a reader of the new state.  ``buckets`` fixes their number;
    ``note`` is kept with the new state."""
    path = path.rstrip("/")
    layout = _checked(_layout(spark, path), keys, buckets)
    touched = [] if layout is None else touched_buckets(changes, layout)
    before = None if layout is None else read_buckets(spark, path, layout, touched)
    new_state, _ = fold_latest(before, changes, keys, ts, tie, action)
    layout = write_buckets(spark, new_state, path, keys, 0 if layout is None else layout["n"] + 1, layout, touched, buckets, note)
    set_layout(spark, path, layout)
    return read_buckets(spark, path, layout)


# --- an SCD2 table ------------------------------------------------------------------------------------

def _mark(spark: SparkSession, root: str, kind: str) -> int | None:
    return max((int(n) for n in list_names(spark, f"{root}/{kind}") if n.isdigit()), default=None)


def _set_mark(spark: SparkSession, root: str, kind: str, batch_id: int) -> None:
    touch(spark, f"{root}/{kind}/{batch_id}")
    for n in list_names(spark, f"{root}/{kind}"):
        if n.isdigit() and int(n) < batch_id:
            remove(spark, f"{root}/{kind}/{n}")


def commit_scd2_batch(spark: SparkSession, root: str, batch: DataFrame, batch_id: int,
                      keys: Sequence[str] = ("id",), ts: str = "updated_timestamp", tie: Sequence[str] = ("seq",),
                      action: str = "action", drop: Sequence[str] = ("partition_date",),
                      split_rows: int = DEFAULT_SPLIT_ROWS, buckets: int | None = None,
                      min_state_rows: int | None = None) -> DataFrame | None:
    """Apply one batch of changes; returns a reader of its late rows (None where there is no such batch to read)."""
    root = root.rstrip("/")
    begun, done = _mark(spark, root, "begun"), _mark(spark, root, "committed")
    if done is not None and batch_id <= done:
        return read_late(spark, root, batch_id)
    if begun is not None and begun != batch_id and (done is None or begun > done):
        raise RuntimeError(f"batch {begun} was begun but not committed: repeat it before batch {batch_id}")
    path = f"{root}/state"
    layout = None if done is None else _checked(_layout(spark, path, done), keys, buckets)
    _set_mark(spark, root, "begun", batch_id)
    batch = batch.select([c for c in batch.columns if c not in drop])
    columns = batch.columns
    before = untouched = None
    touched: list[str] = []
    if layout is None:
        profile = profile_keys(batch, keys, split_rows)
    else:
        touched = touched_buckets(batch, layout)
        whole = read_buckets(spark, path, layout, touched)
        if set(columns) != set(whole.columns):
            raise ValueError(f"the table has columns {sorted(whole.columns)}, the batch {sorted(columns)}")
        profile = profile_keys(batch, keys, split_rows, state=whole)
        # keys of the bucket that the batch leaves alone go back as they are, without a shuffle where that pays off
        before, untouched = split_touched(whole, keys, touched_keys(batch, keys, profile, min_state_rows=min_state_rows))
    step = scd2_step(before, batch, keys, ts, tie, split_rows, profile)
    # three results are written from it: compute it once, where a lost executor cannot take it along
    scratch = scratch_path(spark, "scd2-step")
    step.write.parquet(scratch)
    step = spark.read.schema(step.schema).parquet(scratch)
    closed_intervals(step, keys, ts, tie, action, ()).write.mode("overwrite").parquet(f"{root}/history/batch_id={batch_id}")
    step.where("__late").select(*columns).write.mode("overwrite").parquet(f"{root}/late/batch_id={batch_id}")
    new = step.where("NOT __late AND __next IS NULL").select(*columns)
    if untouched is not None:
        new = new.unionByName(untouched)
    layout = write_buckets(spark, new, path, keys, batch_id, layout, touched, buckets)
    set_layout(spark, path, layout)
    _set_mark(spark, root, "committed", batch_id)
    remove(spark, scratch)
    return read_late(spark, root, batch_id)


def committed_batch(spark: SparkSession, root: str) -> int | None:
    """The newest committed batch of an SCD2 table or a mart."""
    return _mark(spark, root.rstrip("/"), "committed")


def read_late(spark: SparkSession, root: str, batch_id: int | None = None) -> DataFrame | None:
    """The late rows of one batch, or of all."""
    path = f"{root.rstrip('/')}/late" + ("" if batch_id is None else f"/batch_id={batch_id}")
    return spark.read.parquet(path) if path_exists(spark, path) else None


def read_scd2_state(spark: SparkSession, root: str) -> DataFrame | None:
    """The last committed change per key, deletes included."""
    root = root.rstrip("/")
    done = _mark(spark, root, "committed")
    return None if done is None else read_buckets(spark, f"{root}/state", _layout(spark, f"{root}/state", done))


def read_scd2_table(spark: SparkSession, root: str, keys: Sequence[str] = ("id",), ts: str = "updated_timestamp",
                    tie: Sequence[str] = ("seq",), action: str = "action") -> DataFrame | None:
    """The committed SCD2 table: the closed intervals and the state's open ones."""
    state = read_scd2_state(spark, root)
    if state is None:
        return None
    done = _mark(spark, root.rstrip("/"), "committed")
    current = open_intervals(state, keys, ts, tie, action, ())
    history = spark.read.parquet(f"{root.rstrip('/')}/history").where(F.col("batch_id") <= done)
    return history.select(*current.columns).unionByName(current)
