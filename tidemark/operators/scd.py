"""History and current-state builders over a change log.

A change log has one row per change: business key column(s), payload columns, an ``action``
(INSERT / UPDATE / DELETE, either case), the change time ``ts`` and optional tie-break columns
(``seq``) that order changes sharing a timestamp.  Every builder here is a lazy DataFrame plan.

* ``latest_current``   SCD4 current: last change per key as of a day, deleted keys dropped.
* ``fold_latest``      the same state maintained incrementally: previous state + one batch
                       (``current_of_state`` reads the current table off a written state).
* ``scd2_from_log``    SCD2 intervals: each non-delete change opens ``[ts, next change ts)``.
* ``scd2_step``        incremental SCD2 from a state (last change per key): the intervals a batch closes, the
                       new state and the late rows; equal to ``scd2_from_log`` for any batching.
* ``scd2_apply``       incremental SCD2 on a table: close open rows touched by a batch and add the batch's
                       intervals, chaining several changes of one key inside the batch.
* ``scd2_init``        bootstrap an SCD2 table from a plain table (every row open).
* ``as_of_view``       point-in-time rows of an SCD2 table.
* ``snapshot_current`` SCD4a current: live rows of one snapshot day stamped with the run date.
* ``stamp_partition``  bronze -> history: re-derive ``partition_date`` from the change time.

A null key is a key like any other: all grouping is null-safe, and so are the joins.  Where no ``tie`` columns
are given, changes of one instant are ordered by all their other columns, so results stay the same on reruns.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.temporal import day_window_filter, open_end, resolve_as_of
from tidemark.functions.vocab import DELETE, LIVE_ACTIONS
from tidemark.operators.sequence import DEFAULT_SPLIT_ROWS, MAX_BROADCAST_HOT_KEYS, hot_keys, latest_per_key, next_in_key
from tidemark.operators.touched import KeyProfile, profile_keys, same_keys, split_touched, touched_keys

Keys = Sequence[str]


def _is_live(action: str) -> Column:
    return F.upper(F.col(action)).isin(*LIVE_ACTIONS)


def _is_delete(action: str) -> Column:
    return F.upper(F.col(action)) == DELETE


def _open(df: DataFrame, ts: str) -> Column:
    return open_end(df.schema[ts].dataType)


def latest_current(hist: DataFrame, keys: Keys = ("id",), ts: str = "updated_timestamp",
                   tie: Keys = ("seq",), action: str = "action",
                   as_of: dt.date | str | None = None, date_column: str = "partition_date",
                   keep_tie: bool = False) -> DataFrame:
    """Current state per key: the latest change (by ``ts`` then ``tie``, descending) as of ``as_of``,
    kept only when that change is an INSERT or UPDATE.

    The window helper column never leaks into the output; tie columns are dropped unless asked.
    """
    df = hist
    if as_of is not None:
        df = df.filter(day_window_filter(F.col(date_column), resolve_as_of(as_of), "le"))
    order = [F.col(ts).desc()] + [F.col(c).desc() for c in tie_columns(df, keys, ts, tie)]
    out = latest_per_key(df, keys, order).filter(_is_live(action))
    return out if keep_tie else out.drop(*tie)


def fold_latest(state: DataFrame | None, changes: DataFrame, keys: Keys = ("id",), ts: str = "updated_timestamp",
                tie: Keys = ("seq",), action: str = "action",
                min_state_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Incremental SCD4 current: returns ``(new_state, current)``.

    ``state`` holds the last change of every key seen so far, deletes included (a tombstone keeps
    a late, older change from resurrecting a deleted key).  Taking the latest change per key is
    associative, so ``latest(state + batch)`` equals ``latest(whole history)``: a daily run costs
    O(keys + batch) instead of a scan of the whole history.  ``current`` is the state's live rows
    (what ``latest_current`` returns).  ``state`` and ``changes`` have the same columns.

    When the batch touches a small share of the state's keys (see ``touched``), only the state rows of
    those keys are shuffled: the other rows are split off by a map-side anti join and kept as they are.
    """
    order = [F.col(ts).desc()] + [F.col(c).desc() for c in tie_columns(changes, keys, ts, tie)]
    if state is not None and set(state.columns) != set(changes.columns):
        raise ValueError(f"state and changes differ in columns: {sorted(set(state.columns) ^ set(changes.columns))}")
    if state is None:
        new_state = latest_per_key(changes, keys, order)
    else:
        changes = changes.select(*state.columns)
        touched = touched_keys(changes, keys, profile_keys(changes, keys, DEFAULT_SPLIT_ROWS, state=state),
                               min_state_rows=min_state_rows)
        hit, rest = split_touched(state, keys, touched)
        new_state = latest_per_key(hit.unionByName(changes), keys, order)
        if rest is not None:
            new_state = rest.unionByName(new_state)
    return new_state, current_of_state(new_state, tie=tie, action=action)


def current_of_state(state: DataFrame, tie: Keys = ("seq",), action: str = "action") -> DataFrame:
    """The current table of a ``fold_latest`` state (one row per key): its live rows, no shuffle."""
    return state.filter(_is_live(action)).drop(*tie)


def tie_columns(df: DataFrame, keys: Keys, ts: str, tie: Keys) -> list[str]:
    """``tie``, or every other orderable column of ``df`` in the order of names."""
    if tie:
        return list(tie)
    return sorted(f.name for f in df.schema.fields if f.name not in {*keys, ts}
                  and f.dataType.typeName() not in ("map", "variant"))


def _payload(df: DataFrame, keys: Keys, ts: str, tie: Keys, drop: Keys) -> list[str]:
    skip = set(keys) | {ts} | set(tie) | set(drop)
    return [c for c in df.columns if c not in skip]


def scd2_from_log(log: DataFrame, keys: Keys = ("id",), ts: str = "updated_timestamp",
                  tie: Keys = ("seq",), action: str = "action", drop: Keys = ("partition_date",),
                  split_rows: int = DEFAULT_SPLIT_ROWS) -> DataFrame:
    """SCD2 validity intervals from a full change log.

    Every non-delete change opens ``valid_from = ts``; it is closed by the next change of the same
    key (whatever its action) or stays open until the sentinel 9999-12-31.  Deletes only close.
    Output: keys, payload (incl. action), valid_from, valid_to, is_current.
    """
    payload = _payload(log, keys, ts, tie, drop)
    nxt = next_in_key(log.select(*keys, *payload, ts, *tie), keys, ts, tie, "__next", split_rows)
    sentinel = _open(log, ts)
    return (nxt.filter(~_is_delete(action))
            .select(*keys, *payload, F.col(ts).alias("valid_from"),
                    F.coalesce(F.col("__next"), sentinel).alias("valid_to"))
            .withColumn("is_current", F.col("valid_to") == sentinel))


def scd2_init(df: DataFrame, ts: str = "updated_timestamp", keys: Keys = ("id",),
              as_of: dt.date | str | None = None, date_column: str | None = "partition_date") -> DataFrame:
    """Bootstrap an SCD2 table: every row becomes an open interval starting at ``ts``."""
    sentinel = _open(df, ts)
    rest = [c for c in df.columns if c not in set(keys) | {ts} | ({date_column} if date_column else set())]
    out = df.select(*keys, *rest, F.col(ts).alias("valid_from"), sentinel.alias("valid_to"))
    out = out.withColumn("is_current", F.lit(True))
    if date_column:
        out = out.withColumn(date_column, F.lit(resolve_as_of(as_of)))
    return out


def scd2_step(state: DataFrame | None, batch: DataFrame, keys: Keys = ("id",), ts: str = "updated_timestamp",
              tie: Keys = ("seq",), split_rows: int = DEFAULT_SPLIT_ROWS,
              profile: KeyProfile | None = None) -> DataFrame:
    """One batch of changes against the last applied change of every key.

    ``state`` and ``batch`` have the same columns (keys, payload, action, ``ts``, ``tie``); ``state`` has one row per
    key, deletes included, so a delete of an unknown key is remembered too.  Returns their rows with ``__next``, the
    time of the key's next change, and ``__late``: a batch row that is not after the key's last applied change in
    (``ts``, ``tie``) is late (or a replay) and takes no part.  From the others,

    * a live row with a next change is an interval this batch closes;
    * a row without a next change is the key's new state (live: an open interval).

    The union is shuffled once by key.  Keys with more than ``split_rows`` batch rows are cut into slices
    (``sequence.next_in_key``), and their state row is joined to them instead.
    """
    order = tie_columns(batch, keys, ts, tie)
    position = F.struct(F.col(ts), *[F.col(c) for c in order])
    if profile is None:
        profile = profile_keys(batch, keys, split_rows)
    if state is None:
        return (next_in_key(batch, keys, ts, order, "__next", split_rows, profile=profile)
                .withColumn("__late", F.lit(False)))
    state = state.select(*batch.columns)
    cold_state, cold_batch, parts = state, batch, []
    if profile.hot:
        hot = hot_keys(batch, keys, split_rows, profile).select(*keys)
        hot = F.broadcast(hot) if profile.hot <= MAX_BROADCAST_HOT_KEYS else hot
        hot_state, cold_state = split_touched(state, keys, hot)
        hot_batch, cold_batch = split_touched(batch, keys, hot)
        last = hot_state.select(*[F.col(k).alias(f"__s_{k}") for k in keys], position.alias("__applied"))
        last = F.broadcast(last) if profile.hot <= MAX_BROADCAST_HOT_KEYS else last
        marked = hot_batch.join(last, same_keys(keys, "__s_"), "left")
        is_late = F.coalesce(position <= F.col("__applied"), F.lit(False))
        marked = marked.withColumn("__late", is_late).select(*batch.columns, "__late")
        live = hot_state.unionByName(marked.filter(~F.col("__late")).drop("__late"))
        parts += [next_in_key(live, keys, ts, order, "__next", split_rows).withColumn("__late", F.lit(False)),
                  marked.filter("__late").withColumn("__next", F.lit(None).cast(batch.schema[ts].dataType))]
    by_key = Window.partitionBy(*keys)
    both = (cold_state.withColumn("__old", F.lit(True)).unionByName(cold_batch.withColumn("__old", F.lit(False)))
            .withColumn("__applied", F.max(F.when(F.col("__old"), position)).over(by_key))
            .withColumn("__late", ~F.col("__old") & F.coalesce(position <= F.col("__applied"), F.lit(False))))
    in_order = by_key.orderBy(F.col("__late").desc(), F.col(ts), *[F.col(c) for c in order])
    both = (both.withColumn("__next", F.when(~F.col("__late"), F.lead(ts).over(in_order)))
            .select(*batch.columns, "__next", "__late"))
    for p in parts:
        both = both.unionByName(p)
    return both


def closed_intervals(stepped: DataFrame, keys: Keys = ("id",), ts: str = "updated_timestamp", tie: Keys = ("seq",),
                     action: str = "action", drop: Keys = ("partition_date",)) -> DataFrame:
    """The intervals that a ``scd2_step`` closed."""
    payload = _payload(stepped, keys, ts, tie, [*drop, "__next", "__late"])
    return (stepped.filter(~F.col("__late") & F.col("__next").isNotNull() & ~_is_delete(action))
            .select(*keys, *payload, F.col(ts).alias("valid_from"), F.col("__next").alias("valid_to"), F.lit(False).alias("is_current")))


def open_intervals(state: DataFrame, keys: Keys = ("id",), ts: str = "updated_timestamp", tie: Keys = ("seq",),
                   action: str = "action", drop: Keys = ("partition_date",)) -> DataFrame:
    """The open intervals of a state (last change per key): its live rows."""
    payload = _payload(state, keys, ts, tie, drop)
    return (state.filter(~_is_delete(action))
            .select(*keys, *payload, F.col(ts).alias("valid_from"), _open(state, ts).alias("valid_to"), F.lit(True).alias("is_current")))


def scd2_apply(target: DataFrame | None, batch: DataFrame, keys: Keys = ("id",),
               ts: str = "updated_timestamp", tie: Keys = ("seq",), action: str = "action",
               drop: Keys = ("partition_date",), split_rows: int = DEFAULT_SPLIT_ROWS,
               close_only: bool = False, state: DataFrame | None = None,
               date_column: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Apply one batch of changes to an SCD2 table; returns ``(new_table, late)``.

    * closed target rows pass through untouched;
    * an open target row whose key changes in the batch is closed at the key's first batch change;
    * every non-delete batch change opens an interval closed by the key's next batch change
      (so several changes per key per batch chain instead of duplicating), unless ``close_only``;
    * a re-insert of a live key is treated as an update (close + open).

    Changes that are not after the key's last applied change are already applied or late: they are left out and
    returned in ``late``, so replaying a batch is a no-op.  With ``state`` (``fold_latest``'s last change per key, deletes
    and ``tie`` included) "after" means (``ts``, ``tie``), and the result equals ``scd2_from_log`` for any batching.  A table
    alone knows neither the tie of its last change nor deletes that closed nothing: then "after" means a later ``ts``.

    ``date_column`` adds the date of ``valid_from`` (the run's partition column).  Target rows of keys without a change in
    the batch are split off by a map-side anti join when that pays off (``touched``).  The others and the batch
    are shuffled once, together; keys with more than ``split_rows`` batch rows take joins and sliced windows instead.
    """
    payload = _payload(batch, keys, ts, tie, drop)
    if date_column:
        payload = [c for c in payload if c != date_column]
    sentinel = _open(batch, ts)
    order = tie_columns(batch.select(*keys, *payload, ts, *tie), keys, ts, tie)
    changes = batch.select(*keys, *payload, ts, *tie)

    def finish(table: DataFrame) -> DataFrame:
        table = table.select(*keys, *payload, "valid_from", "valid_to").withColumn("is_current", F.col("valid_to") == sentinel)
        return table.withColumn(date_column, F.to_date("valid_from")) if date_column else table

    def opened(rows: DataFrame) -> DataFrame:
        return rows.filter(~_is_delete(action)).select(*keys, *payload, F.col(ts).alias("valid_from"),
                                                       F.coalesce(F.col("__next"), sentinel).alias("valid_to"))

    if target is None:
        new = next_in_key(changes, keys, ts, order, "__next", split_rows)
        return finish(opened(new) if not close_only else opened(new).limit(0)), changes.limit(0)

    profile = profile_keys(changes, keys, split_rows, state=target)
    tgt = target.select(*keys, *payload, "valid_from", "valid_to")
    touched = touched_keys(changes, keys, profile)
    tgt, untouched = split_touched(tgt, keys, touched)
    position = F.struct(F.col(ts), *[F.col(c) for c in order])
    known = None
    if state is not None:
        known = split_touched(state.select(*keys, position.alias("__position")), keys, touched)[0]
    # the last applied position that a row tells of; the table's rows leave the tie open
    nothing = [F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in order]
    seen_ts = F.greatest(F.col("valid_from"), F.when(F.col("valid_to") != sentinel, F.col("valid_to")))
    tgt_seen = tgt.withColumn("__position", F.struct(seen_ts.alias(ts), *nothing))

    def late_than(applied: Column) -> Column:
        after = position > applied if state is not None else F.col(ts) > applied[ts]
        return ~F.coalesce(after, F.lit(True))

    parts, lates = [] if untouched is None else [untouched], []
    if profile.hot:   # rows of keys that are too many for one task
        hot = hot_keys(changes, keys, split_rows, profile).select(*keys)
        hot = F.broadcast(hot) if profile.hot <= MAX_BROADCAST_HOT_KEYS else hot
        hot_tgt, tgt_seen = split_touched(tgt_seen, keys, hot)
        hot_changes, changes = split_touched(changes, keys, hot)
        seen = hot_tgt.select(*keys, "__position")
        if known is not None:
            seen, known = split_touched(known, keys, hot)
        seen = seen.groupBy(*keys).agg(F.max("__position").alias("__applied"))
        seen = seen.select(*[F.col(k).alias(f"__s_{k}") for k in keys], "__applied")
        marked = hot_changes.join(seen, same_keys(keys, "__s_"), "left").withColumn("__late", late_than(F.col("__applied")))
        marked = marked.select(*hot_changes.columns, "__late")
        fresh = marked.filter(~F.col("__late")).drop("__late")
        first = fresh.groupBy(*keys).agg(F.min(ts).alias("__first")).select(*[F.col(k).alias(f"__s_{k}") for k in keys], "__first")
        is_open = F.col("valid_to") == sentinel
        parts.append(hot_tgt.join(first, same_keys(keys, "__s_"), "left").withColumn(
            "valid_to", F.when(is_open, F.coalesce("__first", "valid_to")).otherwise(F.col("valid_to"))).select(*keys, *payload, "valid_from", "valid_to"))
        if not close_only:
            parts.append(opened(next_in_key(fresh, keys, ts, order, "__next", split_rows)))
        lates.append(marked.filter("__late").drop("__late"))

    # table rows, batch rows and (with a state) the keys' last positions, each with what it lacks as null
    both = tgt_seen.withColumn("__kind", F.lit("table")).unionByName(changes.withColumn("__kind", F.lit("batch")), allowMissingColumns=True)
    if known is not None:
        both = both.withColumn("__position", F.lit(None).cast(tgt_seen.schema["__position"].dataType)).unionByName(
            known.withColumn("__kind", F.lit("state")), allowMissingColumns=True)
    by_key = Window.partitionBy(*keys)
    both = (both.withColumn("__applied", F.max("__position").over(by_key))
            .withColumn("__late", (F.col("__kind") == "batch") & late_than(F.col("__applied")))
            .withColumn("__fresh", (F.col("__kind") == "batch") & ~F.col("__late"))
            .withColumn("__first", F.min(F.when(F.col("__fresh"), F.col(ts))).over(by_key))
            .withColumn("__next", F.lead(ts).over(by_key.orderBy("__fresh", F.col(ts), *[F.col(c) for c in order]))))
    rows = both.filter("__kind = 'table' OR __fresh")
    is_new = F.col("__fresh")
    if close_only:
        rows = rows.filter(~is_new)
    closes = (F.col("valid_to") == sentinel) & F.col("__first").isNotNull()
    parts.append(rows.filter(~is_new | ~_is_delete(action)).select(
        *keys, *payload, F.when(is_new, F.col(ts)).otherwise(F.col("valid_from")).alias("valid_from"),
        F.when(is_new, F.coalesce("__next", sentinel)).when(closes, F.col("__first")).otherwise(F.col("valid_to")).alias("valid_to")))
    lates.append(both.filter("__late").select(*changes.columns))

    result, late = parts[0], lates[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    for p in lates[1:]:
        late = late.unionByName(p)
    return finish(result), late


def as_of_view(scd2: DataFrame, at: dt.datetime | str | Column) -> DataFrame:
    """Rows of an SCD2 table valid at instant ``at``: ``valid_from <= at < valid_to``."""
    if isinstance(at, Column):
        point = at
    else:
        text = at.isoformat(sep=" ") if isinstance(at, dt.datetime) else str(at)
        flavour = "TIMESTAMP_NTZ" if scd2.schema["valid_from"].dataType.typeName() == "timestamp_ntz" else "TIMESTAMP"
        point = F.expr(f"{flavour} '{text}'")
    return scd2.filter((F.col("valid_from") <= point) & (point < F.col("valid_to")))


def snapshot_current(snapshot: DataFrame, as_of: dt.date | str | None = None, action: str = "action",
                     date_column: str = "partition_date", drop: Keys = ("seq",)) -> DataFrame:
    """SCD4a current: the live rows of one snapshot day, stamped with the run date."""
    run_date = resolve_as_of(as_of)
    keep = [c for c in snapshot.columns if c not in set(drop)]
    return (snapshot.filter(_is_live(action)).select(*keep)
            .withColumn(date_column, F.lit(run_date)))


def stamp_partition(df: DataFrame, ts: str = "updated_timestamp", date_column: str = "partition_date") -> DataFrame:
    """Bronze -> history: ``partition_date`` re-derived from the change time (event date)."""
    return df.withColumn(date_column, F.to_date(F.col(ts)))
