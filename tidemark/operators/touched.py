"""Split a keyed table into the rows a change batch touches and the rows it leaves alone.

A daily batch is usually small next to the state it is applied to (current table, SCD2 state, last
change per key).  Joining the whole state with the batch shuffles the whole state every run.  Instead:

    profile_keys      one small job of mergeable sketches: the batch's distinct key count and hot keys (keys with
                      more rows than a slice should hold, see ``sequence.next_in_key``), and the state's row count;
    touched_keys      the batch's distinct keys, marked for broadcast, when the split pays off (below),
                      else ``None``;
    split_touched     state LEFT SEMI keys / state LEFT ANTI keys.  With broadcast keys both are
                      map-side hash joins: the state is scanned twice but never shuffled, and only the
                      touched rows (O(batch)) reach the per-key logic.  Untouched rows pass through.

The split is used when the key set has a proven size bound (at most ``MAX_BROADCAST_KEYS`` keys, the
broadcast check), touches at most ``MAX_TOUCHED_SHARE`` of the state's rows, and the state has at least
``MIN_SPLIT_STATE_ROWS`` rows.  When a batch touches most keys, or the state is small enough that
shuffling it costs less than the split's extra scan, joins and stages, the operators join the whole
state with the batch as one shuffle join, which is also the plan above the broadcast bound.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The batch's key set is broadcast only while it has at most this many distinct keys.
MAX_BROADCAST_KEYS = 1_000_000
# ... and its keys' text, with ROW_BYTES for what stands beside a key, takes at most this many bytes.
MAX_BROADCAST_BYTES = 256 << 20
ROW_BYTES = 64
# Split only when the batch's keys are at most this share of the state's rows ...
MAX_TOUCHED_SHARE = 0.2
# ... and the state has at least this many rows (below it a shuffle of the whole state is cheap).
MIN_SPLIT_STATE_ROWS = 1_000_000


# Error bound of the distinct-key sketch (relative standard deviation), and how many of them are added to its estimate.
KEYS_RSD, KEYS_SIGMAS = 0.02, 5
# A heavy-hitter sketch of m entries misses no key with more than SKETCH_ERROR / m of the rows; larger sketches than this one
# are not built, and hot keys are then found by counting all keys.
SKETCH_ERROR, MAX_SKETCH = 4, 10_000


@dataclass(frozen=True)
class KeyProfile:
    keys: int                      # distinct keys in the batch (an upper estimate)
    hot: int                       # keys with more than split_rows rows (exact)
    hot_rows: int                  # rows of those hot keys (exact)
    state_rows: int | None = None  # rows of the state the batch is applied to, when counted
    key_bytes: int = 0             # text bytes of the distinct keys (an upper estimate)
    suspects: tuple[int, ...] | None = None   # hashes among which all hot keys are; None: any key


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def suspected(df: DataFrame, keys: Sequence[str], profile: KeyProfile | None) -> DataFrame:
    """The rows that may be of hot keys."""
    if profile is None or profile.suspects is None:
        return df
    return df.where(key_hash(keys).isin(list(profile.suspects)))


def profile_keys(df: DataFrame, keys: Sequence[str], split_rows: int,
                 state: DataFrame | None = None) -> KeyProfile:
    """Distinct keys and hot-key totals of ``df``, and the row count of ``state`` when given, without an exchange of the keys.

    One job merges small sketches of the tasks: row count, distinct keys, widest key.  Only a batch of more than ``split_rows``
    rows can have hot keys; then a heavy-hitter sketch names all keys that may be hot, and their rows alone are
    counted exactly."""
    width = F.octet_length(F.concat_ws("", *[F.col(k).cast("string") for k in keys])).cast("long")
    parts = df.agg(F.lit("batch").alias("part"), F.count(F.lit(1)).alias("n"),
                   F.approx_count_distinct(key_hash(keys), KEYS_RSD).alias("k"), F.max(width).alias("w"))
    if state is not None:
        none = F.lit(0).cast("long")
        parts = parts.unionByName(state.agg(F.lit("state").alias("part"), F.count(F.lit(1)).alias("n"), none.alias("k"), none.alias("w")))
    got = {row["part"]: row for row in parts.collect()}
    n = int(got["batch"]["n"])
    distinct = min(n, math.ceil((got["batch"]["k"] or 0) * (1 + KEYS_SIGMAS * KEYS_RSD)))
    state_rows = int(got["state"]["n"]) if "state" in got else None
    key_bytes = distinct * int(got["batch"]["w"] or 0)
    if n <= split_rows:
        return KeyProfile(distinct, 0, 0, state_rows, key_bytes, ())
    size = SKETCH_ERROR * math.ceil(n / max(split_rows, 1)) + 16
    suspects = None
    if size <= MAX_SKETCH:
        top = df.select(key_hash(keys).alias("h")).agg(F.expr(f"approx_top_k(h, {size}, {size})")).first()[0]
        suspects = tuple(sorted(r["item"] for r in top if r["count"] > split_rows))   # counts are upper estimates
        if not suspects:
            return KeyProfile(distinct, 0, 0, state_rows, key_bytes, ())
    found = KeyProfile(distinct, 0, 0, state_rows, key_bytes, suspects)
    exact = suspected(df, keys, found).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > split_rows)
    hot, rows = exact.agg(F.count(F.lit(1)), F.sum("__n")).first()
    return KeyProfile(distinct, int(hot), int(rows or 0), state_rows, key_bytes, suspects)


def fits_broadcast(profile: KeyProfile) -> bool:
    """The size check: may the batch's key set (or a frame with one row per batch key) be broadcast?"""
    return profile.keys <= MAX_BROADCAST_KEYS and profile.key_bytes + ROW_BYTES * profile.keys <= MAX_BROADCAST_BYTES


def worth_splitting(profile: KeyProfile, min_state_rows: int | None = None) -> bool:
    """Broadcastable key set that touches a small share of a large state."""
    floor = MIN_SPLIT_STATE_ROWS if min_state_rows is None else min_state_rows
    return fits_broadcast(profile) and (profile.state_rows is None
                                        or (profile.state_rows >= floor
                                            and profile.keys <= MAX_TOUCHED_SHARE * profile.state_rows))


def touched_keys(changes: DataFrame, keys: Sequence[str], profile: KeyProfile,
                 distinct: bool = True, min_state_rows: int | None = None) -> DataFrame | None:
    """The batch's keys for a broadcast split, or ``None`` when the split does not pay off.
    ``distinct=False`` when ``changes`` already has one row per key; ``min_state_rows`` replaces the floor."""
    if not worth_splitting(profile, min_state_rows):
        return None
    ks = changes.select(*keys)
    return F.broadcast(ks.distinct() if distinct else ks)


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """Join condition: each key equals the other side's column of the same name with ``prefix``, null equal to null."""
    cond = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
        cond = one if cond is None else cond & one
    return cond


def split_touched(table: DataFrame, keys: Sequence[str],
                  touched: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """``(rows of touched keys, rows of other keys)``; without a key set every row counts as touched.  A null key
    is a key like any other."""
    if touched is None:
        return table, None
    other = touched.select(*[F.col(k).alias(f"__touched_{k}") for k in keys])
    cond = same_keys(keys, "__touched_")
    return table.join(other, cond, "left_semi"), table.join(other, cond, "left_anti")
