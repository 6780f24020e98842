"""Redelivered messages: brokers deliver at least once, so a message may come again, in the same micro-batch, a later one or
after a restart.

``drop_redelivered`` lets the first delivery pass.  It keeps one fixed-size entry per message (two 64-bit hashes) in Spark's keyed
state store for the time ``within`` after its arrival; then the entry is evicted, so the state holds the messages of
that time and not those of the stream.  Time is arrival time: it never runs backwards, so no message is too late to be
judged and none is dropped for being late, however old the change that it carries.  Messages that come again after ``within``
pass; give at least the time that the broker may take to repeat itself, outages included.

State and offsets are committed together per micro-batch.  A replayed micro-batch therefore lets the same messages pass.
For state beyond the executors' memory set Spark's RocksDB state store provider.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARRIVED, HASHES = "__arrived", ("__message_1", "__message_2")


def drop_redelivered(messages: DataFrame, within: str = "1 day", identity: Sequence[str] = ("value",)) -> DataFrame:
    """The messages of a stream without those that repeat ``identity`` (default: the whole message) within the time
    ``within``.  Messages that hold a null in it (tombstones) cannot be told apart and all pass."""
    known = F.lit(True)
    for c in identity:
        known = known & F.col(c).isNotNull()
    marked = messages.where(known).withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, within)
    for i, name in enumerate(HASHES):
        marked = marked.withColumn(name, F.xxhash64(F.lit(i), *[F.col(c) for c in identity]))
    first = marked.dropDuplicatesWithinWatermark(list(HASHES)).select(*messages.columns)
    return first.unionByName(messages.where(~known))
