"""Row-level change application (the MERGE family) written as joins, so it runs on plain Parquet
tables as well as on table formats that support MERGE.

Both operators assume at most one change per key per batch, like a SQL MERGE does; the batch is
first reduced to the last change per key (top-1 with a partial limit before the shuffle).  After
that reduction both join inputs have at most one row per key, so the join cannot be skewed.

The current table is the large side.  ``merge_close_and_insert`` joins it with the batch broadcast
when the batch's key count is within ``touched.MAX_BROADCAST_KEYS`` (checked by a count), so the
table is not shuffled.  ``merge_current`` needs a full outer join, which cannot broadcast; when the
batch touches a small share of the table's keys it splits off the untouched rows with a map-side
anti join and runs the full outer join only on the touched rows (see ``touched``).  Otherwise both
join the whole table with the batch as one shuffle join.

* ``merge_current``          SCD4 current table upkeep (update in place, close on delete).
* ``merge_current_bucketed`` the same on a table bucketed by key, which is never exchanged.
* ``merge_close_and_insert`` SCD4a upkeep (close the open version, insert the new one, stamp all
                             rows with the run date).

Each has a form that also returns the rows its job appends to history: ``merge_current_with_history`` (the batch's
deletes) and ``merge_close_and_insert_with_archive`` (the current table before the rewrite).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.temporal import open_end, resolve_as_of
from tidemark.functions.vocab import DELETE, INSERT, UPDATE
from tidemark.operators.sequence import DEFAULT_SPLIT_ROWS, latest_per_key
from tidemark.operators.scd import tie_columns
from tidemark.operators.touched import fits_broadcast, profile_keys, same_keys, split_touched, touched_keys

Keys = Sequence[str]


def last_change_per_key(changes: DataFrame, keys: Keys, ts: str, tie: Keys) -> DataFrame:
    order = [F.col(ts).desc()] + [F.col(c).desc() for c in tie_columns(changes, keys, ts, tie)]
    return latest_per_key(changes, keys, order)


def _split_open(current: DataFrame, sentinel: Column) -> tuple[DataFrame, DataFrame]:
    is_open = F.col("valid_to") == sentinel
    return current.filter(is_open), current.filter(~is_open)


def merge_current(current: DataFrame, changes: DataFrame, keys: Keys = ("id",),
                  ts: str = "updated_timestamp", tie: Keys = ("seq",), action: str = "action",
                  min_state_rows: int | None = None) -> DataFrame:
    """SCD4 current upkeep, matched on key AND open target row.

    matched DELETE -> close (``valid_to`` = change time, ``action`` = DELETE), payload kept;
    matched UPDATE -> overwrite payload, action and ``valid_from``, stay open;
    matched INSERT -> unchanged;  unmatched change -> inserted as an open row whatever its action;
    target rows without a change and closed target rows -> unchanged.
    Output: keys, payload, action, valid_from, valid_to.
    """
    sentinel = open_end(changes.schema[ts].dataType)
    payload = [c for c in current.columns if c not in set(keys) | {action, "valid_from", "valid_to"}]
    out_cols = [*keys, *payload, action, "valid_from", "valid_to"]
    open_rows, closed_rows = _split_open(current.select(*out_cols), sentinel)

    src = last_change_per_key(changes, keys, ts, tie)
    src = _as_source(src, keys, payload, ts, action)
    # the table's row count (an unfiltered count, cheap on columnar files) sizes the state for the split choice
    profile = profile_keys(changes, keys, DEFAULT_SPLIT_ROWS, state=current)
    open_rows, untouched = split_touched(open_rows, keys, touched_keys(src, keys, profile, distinct=False, min_state_rows=min_state_rows))
    if untouched is not None:
        closed_rows = closed_rows.unionByName(untouched)
    merged = _merged(open_rows, src, keys, payload, action, sentinel, same_keys(keys, "__s_"))
    return closed_rows.unionByName(merged)


def _merged(open_rows: DataFrame, src: DataFrame, keys: Keys, payload: Keys, action: str, sentinel: Column, on: Column) -> DataFrame:
    """Open rows and the last changes per key (columns with ``__s_``) after the merge."""
    tgt = open_rows.withColumn("__t", F.lit(True))
    src = src.select(*[F.col(k).alias(f"__s_{k}") for k in keys], *[c for c in src.columns if c not in keys])
    j = tgt.join(src, on, "full_outer")

    t_missing = F.col("__t").isNull()
    matched = F.col("__t") & F.col("__s")
    is_update = matched & (F.col("__s_action") == UPDATE)
    is_delete = matched & (F.col("__s_action") == DELETE)
    take_src = t_missing | is_update

    return j.select(
        *[F.when(t_missing, F.col(f"__s_{k}")).otherwise(F.col(k)).alias(k) for k in keys],
        *[F.when(take_src, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) for c in payload],
        F.when(take_src | is_delete, F.col("__s_action_raw")).otherwise(F.col(action)).alias(action),
        F.when(take_src, F.col("__s_ts")).otherwise(F.col("valid_from")).alias("valid_from"),
        F.when(is_delete, F.col("__s_ts")).when(t_missing, sentinel).otherwise(F.col("valid_to")).alias("valid_to"),
    )


def merge_current_bucketed(table: DataFrame, changes: DataFrame, buckets: int, keys: Keys = ("id",),
                           ts: str = "updated_timestamp", tie: Keys = ("seq",), action: str = "action") -> DataFrame:
    """``merge_current`` on a table that is bucketed by its keys (``sinks.write_bucketed``): the table is scanned bucket by
    bucket and never exchanged; only the batch is, once, into as many partitions.  The result has the table's partitioning, so
    writing it with the same buckets needs no exchange either.

    Rows with a null in their keys are merged apart (null-safe): only plain equality keeps a bucketed scan in place."""
    sentinel = open_end(changes.schema[ts].dataType)
    payload = [c for c in table.columns if c not in set(keys) | {action, "valid_from", "valid_to"}]
    out_cols = [*keys, *payload, action, "valid_from", "valid_to"]
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    open_rows, closed_rows = _split_open(table.select(*out_cols).where(~null), sentinel)
    placed = changes.where(~null).repartition(buckets, *[F.col(k) for k in keys])   # the top-1 per key and the join keep it
    src = _as_source(last_change_per_key(placed, keys, ts, tie), keys, payload, ts, action)
    on = None
    for k in keys:
        one = F.col(k) == F.col(f"__s_{k}")
        on = one if on is None else on & one
    merged = _merged(open_rows, src, keys, payload, action, sentinel, on)
    rest = merge_current(table.select(*out_cols).where(null), changes.where(null), keys, ts, tie, action)
    return closed_rows.unionByName(merged).unionByName(rest)


def _as_source(src: DataFrame, keys: Keys, payload: Keys, ts: str, action: str) -> DataFrame:
    return src.select(*[F.col(k) for k in keys],
                      *[F.col(c).alias(f"__s_{c}") for c in payload],
                      F.upper(F.col(action)).alias("__s_action"), F.col(action).alias("__s_action_raw"),
                      F.col(ts).alias("__s_ts"), F.lit(True).alias("__s"))


def delete_history(changes: DataFrame, keys: Keys = ("id",), ts: str = "updated_timestamp", tie: Keys = ("seq",),
                   action: str = "action", as_of: dt.date | str | None = None,
                   date_column: str = "partition_date") -> DataFrame:
    """The history half of the SCD4 upkeep: every DELETE of the batch as an open-ended history row stamped with the
    run date.  Output: keys, payload, action, valid_from, valid_to, date_column."""
    payload = [c for c in changes.columns if c not in {*keys, *tie, ts, action, date_column}]
    return (changes.filter(F.upper(F.col(action)) == DELETE)
            .select(*keys, *payload, action, F.col(ts).alias("valid_from"), open_end(changes.schema[ts].dataType).alias("valid_to"),
                    F.lit(resolve_as_of(as_of)).alias(date_column)))


def merge_current_with_history(current: DataFrame, changes: DataFrame, keys: Keys = ("id",), ts: str = "updated_timestamp",
                               tie: Keys = ("seq",), action: str = "action", as_of: dt.date | str | None = None,
                               date_column: str = "partition_date") -> tuple[DataFrame, DataFrame]:
    """``(new current, rows to append to history)``: both halves of the SCD4 upkeep."""
    return (merge_current(current, changes, keys, ts, tie, action),
            delete_history(changes, keys, ts, tie, action, as_of, date_column))


def merge_close_and_insert_with_archive(current: DataFrame, changes: DataFrame, keys: Keys = ("id",),
                                        ts: str = "updated_timestamp", tie: Keys = ("seq",), action: str = "action",
                                        as_of: dt.date | str | None = None,
                                        date_column: str = "partition_date") -> tuple[DataFrame, DataFrame]:
    """``(new current, rows to append to history)``: the SCD4a upkeep.  The archive is the whole current table as it
    was before; append it before the current table is replaced."""
    return merge_close_and_insert(current, changes, keys, ts, tie, action, as_of, date_column), current


def merge_close_and_insert(current: DataFrame, changes: DataFrame, keys: Keys = ("id",),
                           ts: str = "updated_timestamp", tie: Keys = ("seq",), action: str = "action",
                           as_of: dt.date | str | None = None, date_column: str = "partition_date") -> DataFrame:
    """SCD4a current upkeep.

    open row, change DELETE -> closed at the change time, action = DELETE;
    open row, change UPDATE -> closed at the change time (action kept);
    every INSERT/UPDATE change -> a new open row (an INSERT of a live key opens a second row);
    changes for unknown keys that are not INSERT/UPDATE are ignored; closed rows stay;
    every row is stamped ``date_column = as_of``.
    Output: keys, payload, action, valid_from, valid_to, date_column.
    """
    run_date = resolve_as_of(as_of)
    sentinel = open_end(changes.schema[ts].dataType)
    payload = [c for c in current.columns
               if c not in set(keys) | {action, "valid_from", "valid_to", date_column}]
    base_cols = [*keys, *payload, action, "valid_from", "valid_to"]
    open_rows, closed_rows = _split_open(current.select(*base_cols), sentinel)

    src = last_change_per_key(changes, keys, ts, tie)
    s_action = F.upper(F.col("__s_action"))
    probe = src.select(*[F.col(k).alias(f"__s_{k}") for k in keys], F.col(action).alias("__s_action"), F.col(ts).alias("__s_ts"))
    if fits_broadcast(profile_keys(changes, keys, DEFAULT_SPLIT_ROWS)):
        probe = F.broadcast(probe)
    closed_now = (open_rows.join(probe, same_keys(keys, "__s_"), "left")
                  .select(*[F.col(k) for k in keys], *payload,
                          F.when(s_action == DELETE, F.col("__s_action")).otherwise(F.col(action)).alias(action),
                          F.col("valid_from"),
                          F.when(s_action.isin(DELETE, UPDATE), F.col("__s_ts"))
                          .otherwise(F.col("valid_to")).alias("valid_to")))
    inserted = (src.filter(F.upper(F.col(action)).isin(INSERT, UPDATE))
                .select(*[F.col(k) for k in keys], *payload, F.col(action),
                        F.col(ts).alias("valid_from"), sentinel.alias("valid_to")))
    return (closed_rows.unionByName(closed_now).unionByName(inserted)
            .withColumn(date_column, F.lit(run_date)))
