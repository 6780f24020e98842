"""Per-key ordering primitives that stay balanced when one key holds a large share of the rows.

``latest_per_key``  top-1 per key.  Catalyst plans ``row_number() ... = 1`` as a *partial*
                    WindowGroupLimit before the shuffle, so each map task ships at most one row per key:
                    a hot key costs one row per map partition, not all of its rows.

``next_in_key``     the value of the next row of the same key (``lead``), used to close validity
                    intervals.  A plain ``lead() OVER (PARTITION BY key)`` would put every row of a hot
                    key into one task.  Keys with more than ``split_rows`` rows (found with a partial
                    aggregate) take a separate path: their rows are range-partitioned on
                    (key, ts, tie...), so Spark's sampler cuts them into slices of about equal row count
                    whatever the time distribution (bursts and identical timestamps included).  The range
                    partition index is an order-preserving slice id; the window runs per (key, slice) and
                    the last row of a slice takes the first value of the key's next slice, read from a
                    table with one row per slice.  All other keys use the plain window.

                    The sliced hot rows are written once to the shared checkpoint folder and both
                    consumers (the window and the slice-head table) read that copy: two independent
                    range exchanges would sample different bounds, so slice ids must not be recomputed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.touched import KeyProfile, profile_keys, same_keys, split_touched, suspected
from tidemark.session import scratch_path

# A (key, slice) group is kept below roughly this many rows.
DEFAULT_SPLIT_ROWS = 2_000_000
# The hot-key table (key columns only) is broadcast only while it has at most this many rows.
MAX_BROADCAST_HOT_KEYS = 200_000


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (give descending columns for "latest")."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def hot_keys(df: DataFrame, keys: Sequence[str], split_rows: int, profile: KeyProfile | None = None) -> DataFrame:
    """Keys with more than ``split_rows`` rows and their row counts (a partial aggregate, over the rows of the keys that
    ``profile`` suspects)."""
    return (suspected(df, keys, profile).groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias("__n"))
            .filter(F.col("__n") > split_rows))


def hot_slices(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], hot: DataFrame,
               n_hot: int, hot_rows: int, split_rows: int) -> DataFrame:
    """Rows of the hot keys with ``__slice``: the index of their range partition on (keys, ts, tie).

    Range partitions are contiguous and ordered, so for one key a higher slice only holds later rows;
    each slice holds about ``split_rows`` rows.
    """
    hot_side = hot.select(*keys)
    if n_hot <= MAX_BROADCAST_HOT_KEYS:
        hot_side = F.broadcast(hot_side)
    n_slices = max(2, math.ceil(hot_rows / split_rows))
    return (split_touched(df, keys, hot_side)[0]
            .repartitionByRange(n_slices, *_cols(keys), F.col(ts), *_cols(tie))
            .withColumn("__slice", F.spark_partition_id()))


def next_in_key(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], out: str,
                split_rows: int = DEFAULT_SPLIT_ROWS, probe: DataFrame | None = None,
                profile: KeyProfile | None = None) -> DataFrame:
    """Add column ``out`` = ``ts`` of the next row of the same key ordered by (ts, *tie); null for the last.

    Exact for any key skew.  Costs one extra aggregate over the keys to find hot keys (on ``probe``
    when given: any superset of ``df``'s rows with cheaper lineage), unless the caller already has
    that ``profile`` (computed on ``probe`` or ``df`` with the same ``split_rows``).  Without hot keys
    the plan is a single ``lead`` window; with them, cold rows take that window and hot rows the
    sliced path (which runs one job writing the sliced hot rows before returning).
    """
    order = [F.col(ts)] + _cols(tie)
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    source = probe if probe is not None else df
    if profile is None:
        profile = profile_keys(source, keys, split_rows)
    n_hot, hot_rows = profile.hot, profile.hot_rows
    if n_hot == 0:
        return df.withColumn(out, F.lead(F.col(ts)).over(w))

    hot = hot_keys(source, keys, split_rows, profile)
    hot_side = hot.select(*keys)
    if n_hot <= MAX_BROADCAST_HOT_KEYS:
        hot_side = F.broadcast(hot_side)
    cold = (split_touched(df, keys, hot_side)[1]
            .select(*_cols(df.columns), F.lead(F.col(ts)).over(w).alias(out)))

    staged = scratch_path(df.sparkSession, "hot-slices")
    hot_slices(df, keys, ts, tie, hot, n_hot, hot_rows, split_rows).write.mode("overwrite").parquet(staged)
    sliced = df.sparkSession.read.parquet(staged)
    w_slice = Window.partitionBy(*_cols(keys), F.col("__slice")).orderBy(*order)
    within = sliced.withColumn("__next", F.lead(F.col(ts)).over(w_slice))
    # one row per (hot key, slice): the first ts of the key's following slice
    heads = within.groupBy(*_cols(keys), F.col("__slice")).agg(F.min(F.col(ts)).alias("__head"))
    w_heads = Window.partitionBy(*_cols(keys)).orderBy(F.col("__slice"))
    heads = heads.select(*_cols(keys), F.col("__slice"), F.lead(F.col("__head")).over(w_heads).alias("__after"))
    heads = heads.select(*[F.col(k).alias(f"__h_{k}") for k in [*keys, "__slice"]], "__after")
    warm = (within.join(heads, same_keys([*keys, "__slice"], "__h_"), "left")
            .select(*_cols(df.columns), F.coalesce(F.col("__next"), F.col("__after")).alias(out)))
    return cold.unionByName(warm)
