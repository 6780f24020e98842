"""Truncate messages (op ``t``): events of the whole table inside the intervals of single keys.

A truncate ends every interval that is open at its instant.  It is not written out per key: a table keeps its
intervals as the changes alone make them, and its truncates beside them, and ``close_at_truncates`` ends each interval at
the next truncate after its start.  So a truncate costs one row whatever the number of keys, late ones are as exact as timely ones,
and any batching gives the intervals of the whole log.

The next truncate is looked up by slots of time of one width, about as many as there are truncates: each slot has its sorted
truncates, and the first one of later slots.  A row meets the few truncates of its slot, so there is no range join and no
cross product, and the work per row does not grow with the truncates.  Of truncates of one instant the last stands for all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampType

from tidemark.functions.temporal import millis_to_ntz, open_end
from tidemark.functions.vocab import TRUNCATE_OP
from tidemark.session import scratch_path

# The slot table (with all truncates in it) is broadcast only while there are at most this many truncates.
MAX_BROADCAST_TRUNCATES = 100_000


def truncate_events(parsed: DataFrame, ts: str = "updated_timestamp", seq_field: str | None = None) -> DataFrame:
    """(``ts``, ``seq``) of the truncate messages among parsed envelopes (``parse_envelopes``); those without a time are
    left to the quarantine."""
    found = parsed.where((F.col("__op") == TRUNCATE_OP) & F.col("__source.ts_ms").isNotNull())
    return found.select(millis_to_ntz(F.col("__source.ts_ms")).alias(ts),
                        *([F.col(f"__source.{seq_field}").alias("seq")] if seq_field else []))


def _position(columns: Sequence[str | Column], names: Sequence[str]) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(columns, names)])


def _seconds(at: Column, kind: DataType) -> Column:
    """Whole seconds since 1970, which do not fall as time goes on (wall-clock time in no zone counts as UTC)."""
    if isinstance(kind, TimestampType):
        return F.unix_seconds(at)
    at = at.cast("timestamp_ntz")
    return F.unix_date(F.to_date(at)).cast("long") * 86_400 + F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)


def with_next_truncate(rows: DataFrame, truncates: DataFrame, at: Sequence[str], ts: str = "updated_timestamp",
                       tie: Sequence[str] = ("seq",), out: str = "__truncated") -> DataFrame:
    """``rows`` with the time of the first truncate after their position ``at`` (the columns of a row that stand for
    ``ts`` and ``tie`` of a truncate); null where none follows."""
    names, kind = [ts, *tie], truncates.schema[ts].dataType
    events = truncates.select(*names).where(F.col(ts).isNotNull()).groupBy(ts).agg(F.max(_position(names, names)).alias("__p"))
    # written once: the messages are parsed for it
    path = scratch_path(rows.sparkSession, "truncates")
    events.select("__p", _seconds(F.col(ts), kind).alias("__s")).write.parquet(path)
    events = rows.sparkSession.read.parquet(path)
    n, first, last = events.agg(F.count(F.lit(1)), F.min("__s"), F.max("__s")).first()
    if not n:
        return rows.select("*", F.lit(None).cast(kind).alias(out))
    width = -(-(last - first + 1) // n)
    slot = lambda seconds: F.floor(seconds / F.lit(width)).cast("long")
    here = events.groupBy(slot(F.col("__s")).alias("__slot")).agg(F.sort_array(F.collect_list("__p")).alias("__here"))
    # the slot before the first stands for all earlier ones, and rows behind the last find none
    slots = rows.sparkSession.range(first // width - 1, last // width + 1).withColumnRenamed("id", "__slot").join(here, "__slot", "left")
    later = Window.orderBy("__slot").rowsBetween(1, Window.unboundedFollowing)   # about one row per truncate
    slots = slots.withColumn("__after", F.min(F.get("__here", F.lit(0))[ts]).over(later)).withColumnRenamed("__slot", "__t_slot")
    own = F.greatest(slot(_seconds(F.col(at[0]), rows.schema[at[0]].dataType)), F.lit(first // width - 1))
    joined = rows.withColumn("__slot", F.when(F.col(at[0]).isNotNull(), own)).join(
        F.broadcast(slots) if n <= MAX_BROADCAST_TRUNCATES else slots, F.col("__slot") == F.col("__t_slot"), "left")
    position = _position(at, names)
    own_slot = F.get(F.filter("__here", lambda x: x > position), F.lit(0))[ts]
    return joined.select(*rows.columns, F.coalesce(own_slot, "__after").alias(out))


def close_at_truncates(intervals: DataFrame, truncates: DataFrame, ts: str = "updated_timestamp", tie: Sequence[str] = (),
                       position: Sequence[str] = ()) -> DataFrame:
    """SCD2 intervals (valid_from, valid_to, is_current) that end at the next truncate where it comes first.

    ``position`` names columns of the intervals that hold ``tie`` of the change that opened them, to order changes and truncates
    of one instant; without them a truncate at the very start of an interval counts as before it."""
    marked = with_next_truncate(intervals, truncates, ["valid_from", *position], ts, tie)
    end = F.least(F.col("valid_to"), F.coalesce("__truncated", "valid_to"))
    open_ = open_end(intervals.schema["valid_to"].dataType)
    new = {"valid_to": end, "is_current": end == open_}
    return marked.select(*[new[c].alias(c) if c in new else F.col(c) for c in intervals.columns])
