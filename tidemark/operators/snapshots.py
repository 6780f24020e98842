"""Changes and validity intervals from full daily snapshots (every row of the source each day, no change log).

A row's payload is compared by digest with the row of the same key in the snapshot before: new keys are INSERTs, other digests
UPDATEs, keys that are missing from the next snapshot DELETEs of that day.  Snapshots are taken as they come: a day without any
rows was not delivered and changes nothing, so neighbours are the days that exist.  Runs of equal days are islands,
each of which is one interval.

All of it works on one exchange by key: repeated rows of a key and day (the last by ``tie``, or by all columns, counts), the row
before and after, and the islands.  A key has one row per day, whatever its share of the rows.  A null key is a key like any
other; rows without a day take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.temporal import open_end
from tidemark.functions.vocab import DELETE, INSERT, UPDATE
from tidemark.operators.scd import tie_columns

# The calendar (one row per snapshot day) is broadcast only while it has at most this many days.
MAX_BROADCAST_DAYS = 100_000


def _digest(columns: Sequence[str]) -> Column:
    """128 bits of a row's payload; nulls are values of their own."""
    each = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    return F.struct(F.xxhash64(F.lit(1), *each), F.xxhash64(F.lit(2), *each))


def _neighbours(snapshots: DataFrame, keys: Sequence[str], day: str, tie: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """One row per key and day with ``__next_day`` (the next snapshot; null for the newest), ``__same`` and ``__known`` (the key was
    in the snapshot before, with the same payload or any) and ``__gone`` (it is missing from the next)."""
    payload = [c for c in snapshots.columns if c not in {*keys, day, *tie}]
    order = tie_columns(snapshots, [*keys, day], day, tie)
    days = snapshots.where(F.col(day).isNotNull()).select(F.col(day).alias("__day")).distinct()
    along = Window.orderBy("__day")   # one row per snapshot day
    days = days.select("__day", F.lag("__day").over(along).alias("__last_day"), F.lead("__day").over(along).alias("__next_day"))
    if days.count() <= MAX_BROADCAST_DAYS:
        days = F.broadcast(days)
    rows = snapshots.join(days, F.col(day) == F.col("__day")).drop("__day").repartition(*[F.col(k) for k in keys])
    one = Window.partitionBy(*keys, day).orderBy(*[F.col(c).desc() for c in order])
    rows = rows.withColumn("__rn", F.row_number().over(one)).where("__rn = 1").drop("__rn").withColumn("__digest", _digest(payload))
    by_key = Window.partitionBy(*keys).orderBy(day)
    known = F.lag(day).over(by_key) == F.col("__last_day")
    rows = rows.select("*", F.coalesce(known, F.lit(False)).alias("__known"), F.lag("__digest").over(by_key).alias("__before"),
                       F.lead(day).over(by_key).alias("__later"))
    same = F.col("__known") & F.col("__digest").eqNullSafe(F.col("__before"))
    gone = F.col("__next_day").isNotNull() & ~F.coalesce(F.col("__later") == F.col("__next_day"), F.lit(False))
    return rows.select(*keys, *payload, day, "__next_day", "__known", same.alias("__same"), gone.alias("__gone")), payload


def snapshot_changes(snapshots: DataFrame, keys: Sequence[str] = ("id",), day: str = "partition_date", tie: Sequence[str] = (),
                     action: str = "action") -> DataFrame:
    """The change log behind the snapshots: keys, payload (of a DELETE: the last one), ``action`` and ``day``, the day of the
    snapshot that shows the change.  The first snapshot's rows are INSERTs.  A payload column named ``action`` is replaced."""
    rows, payload = _neighbours(snapshots.drop(action), keys, day, tie)
    new = F.when(~F.col("__same"), F.struct(F.when(F.col("__known"), UPDATE).otherwise(INSERT).alias(action), F.col(day).alias(day)))
    gone = F.when(F.col("__gone"), F.struct(F.lit(DELETE).alias(action), F.col("__next_day").alias(day)))
    events = rows.select(*keys, *payload, F.explode(F.filter(F.array(new, gone), lambda x: x.isNotNull())).alias("__event"))
    return events.select(*keys, *payload, f"__event.{action}", f"__event.{day}")


def snapshot_intervals(snapshots: DataFrame, keys: Sequence[str] = ("id",), day: str = "partition_date",
                       tie: Sequence[str] = ()) -> DataFrame:
    """SCD2 intervals: keys, payload, valid_from, valid_to, is_current.  An interval starts at the first day of a run of equal rows
    and ends at the first snapshot that shows another row of the key or none; those in the newest snapshot are open."""
    rows, payload = _neighbours(snapshots, keys, day, tie)
    by_key = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__island", F.sum(F.when(F.col("__same"), 0).otherwise(1)).over(by_key))
    start = F.col(day).cast("timestamp_ntz")
    to = F.coalesce(F.col("__next_day").cast("timestamp_ntz"), open_end())
    out = rows.groupBy(*keys, "__island").agg(*[F.first(c).alias(c) for c in payload], F.min(start).alias("valid_from"), F.max(to).alias("valid_to"))
    return out.drop("__island").withColumn("is_current", F.col("valid_to") == open_end())
