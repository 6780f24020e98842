"""As-of joins: for every row of one table the last row of the same key of another at (or before) its time.

``as_of_join``     by union and a last-value window: both tables are shuffled once by key and walked in time order, so
                   there is no range join, and no pairs of rows are made.
``point_in_time``  the SCD2 interval that holds at a row's time: an as-of join on valid_from, checked against valid_to.

Keys with more than ``split_rows`` rows are cut into slices: their rows are range-partitioned on (keys, time, ...) and
written once, the window runs within a slice, and a slice without an earlier row of its own takes the last one of the slices
before it, from a table with one row per slice.  A null key is a key like any other.  Rows whose time is null get no match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.temporal import open_end
from tidemark.operators.sequence import DEFAULT_SPLIT_ROWS, MAX_BROADCAST_HOT_KEYS, hot_keys, hot_slices
from tidemark.operators.touched import profile_keys, same_keys, split_touched
from tidemark.session import scratch_path


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, tie: Sequence[str] = (),
               prefix: str = "right_", exact: bool = True, direction: str = "backward",
               split_rows: int = DEFAULT_SPLIT_ROWS) -> DataFrame:
    """All rows and columns of ``left``, and the columns of the matched row of ``right`` (other than ``keys``) with ``prefix``;
    nulls where there is none.

    ``direction``: ``backward`` takes the last right row at or before the left one's time, ``forward`` the first at or
    after it; without ``exact`` rows of the very same time do not match.  ``tie`` columns of ``right`` order its rows of one
    instant (backward: the largest wins, forward: the smallest); without them all its columns do."""
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction {direction!r}")
    backward = direction == "backward"
    others = [c for c in right.columns if c not in keys]
    order = list(tie) or sorted(c for c in others if c != right_ts and right.schema[c].dataType.typeName() not in ("map", "variant"))
    clash = {prefix + c for c in others} & set(left.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are in both results: choose another prefix")
    names = [f"__k{i}" for i in range(len(keys))]
    # 0 before 1: right rows of the same instant come first where they match
    first = int(not exact) if backward else int(exact)
    ties = [F.col(c).alias(f"__o{i}") for i, c in enumerate(order)]
    no_ties = [F.lit(None).cast(right.schema[c].dataType).alias(f"__o{i}") for i, c in enumerate(order)]
    no_left, no_right = F.lit(None).cast(left.schema), F.lit(None).cast(StructType([right.schema[c] for c in others]))
    probe = left.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(left_ts).alias("__t"), F.lit(1 - first).alias("__side"),
                        *no_ties, F.struct(*[left[c] for c in left.columns]).alias("__l"), no_right.alias("__r"))
    build = (right.where(F.col(right_ts).isNotNull())
             .select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(right_ts).alias("__t"), F.lit(first).alias("__side"),
                     *ties, no_left.alias("__l"), F.struct(*[F.col(c) for c in others]).alias("__r")))
    both = probe.unionByName(build)
    # nulls first: a left row without a time comes before all right rows (after them, if the order is turned)
    by = ["__t", "__side", *[f"__o{i}" for i in range(len(order))]]
    matched = _carry(both, names, by, backward, split_rows)
    match = F.when(F.col(f"__l.`{left_ts}`").isNotNull(), F.col("__r"))
    out = matched.where("__l IS NOT NULL").select("__l", match.alias("__r"))
    return out.select(*[F.col(f"__l.`{c}`").alias(c) for c in left.columns], *[F.col(f"__r.`{c}`").alias(prefix + c) for c in others])


def _carry(rows: DataFrame, keys: Sequence[str], by: Sequence[str], backward: bool, split_rows: int) -> DataFrame:
    """``rows`` whose ``__r`` is the last one that is not null up to each row in the order ``by`` of its key."""
    order = [F.col(c).asc() if backward else F.col(c).desc() for c in by]
    last = F.last("__r", ignorenulls=True)

    def window(*cols):  # noqa: ANN002, ANN202
        return Window.partitionBy(*cols).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    profile = profile_keys(rows, keys, split_rows)
    if not profile.hot:
        return rows.withColumn("__r", last.over(window(*keys)))
    hot = hot_keys(rows, keys, split_rows, profile)
    side = F.broadcast(hot.select(*keys)) if profile.hot <= MAX_BROADCAST_HOT_KEYS else hot.select(*keys)
    cold = split_touched(rows, keys, side)[1].withColumn("__r", last.over(window(*keys)))
    staged = scratch_path(rows.sparkSession, "as-of-slices")
    hot_slices(rows, keys, by[0], by[1:], hot, profile.hot, profile.hot_rows, split_rows).write.parquet(staged)
    sliced = rows.sparkSession.read.parquet(staged)
    within = sliced.withColumn("__own", last.over(window(*keys, "__slice")))
    # one row per (hot key, slice): the last match in the slices before it
    position = F.struct(*by)
    pick = F.max_by if backward else F.min_by
    ends = sliced.where("__r IS NOT NULL").groupBy(*keys, "__slice").agg(pick("__r", position).alias("__end"))
    slices = sliced.select(*keys, "__slice").distinct()
    ends = slices.join(ends.select(*[F.col(c).alias(f"__e_{c}") for c in [*keys, "__slice"]], "__end"), same_keys([*keys, "__slice"], "__e_"), "left")
    along = F.col("__slice").asc() if backward else F.col("__slice").desc()
    before = Window.partitionBy(*keys).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*[F.col(c).alias(f"__e_{c}") for c in [*keys, "__slice"]], F.last("__end", ignorenulls=True).over(before).alias("__before"))
    warm = (within.join(ends, same_keys([*keys, "__slice"], "__e_"), "left")
            .withColumn("__r", F.coalesce("__own", "__before")).select(*cold.columns))
    return cold.unionByName(warm)


def point_in_time(facts: DataFrame, table: DataFrame, keys: Sequence[str], fact_ts: str, prefix: str = "dim_",
                  split_rows: int = DEFAULT_SPLIT_ROWS) -> DataFrame:
    """All rows and columns of ``facts``, and the columns of the SCD2 interval of ``table`` (valid_from, valid_to) that holds
    at ``fact_ts``, with ``prefix``; nulls where the key had none then.  Intervals of one key do not overlap, so only the last to
    start can hold; of those that start at one instant the last to end counts."""
    found = as_of_join(facts, table, keys, fact_ts, "valid_from", ("valid_to",), prefix, split_rows=split_rows)
    to = F.col(f"{prefix}valid_to")
    holds = (F.col(fact_ts) < to) | (to == open_end(table.schema["valid_to"].dataType))
    taken = [c for c in found.columns if c not in facts.columns]
    return found.select(*facts.columns, *[F.when(holds, F.col(c)).alias(c) for c in taken])
