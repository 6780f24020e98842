"""Offset ledger: which messages of which partition a stream has read.

``offset_ranges``  folds the (partition, offset) pairs of a micro-batch into contiguous ranges, with the number of messages that
                   came more than once.  Offsets are folded in blocks first, so a partition that holds most of the batch is
                   spread, and only its ranges meet.
``offset_report``  the ranges of all batches: contiguous ones joined, and what lies between or over them as ``gap`` and ``repeat``.
                   A gap may be lost messages, or offsets that never held one (compaction, transaction markers).

Rows without a partition or an offset have no place in the ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_OFFSETS = 1 << 20
RANGE = ["partition", "first_offset", "last_offset", "n_repeated"]


def _joined(ranges: DataFrame, by: list[str]) -> DataFrame:
    """Ranges that touch or overlap, joined within ``by``; offsets that two of them hold count as repeated."""
    along = Window.partitionBy(*by).orderBy("first_offset", "last_offset")
    before = F.max("last_offset").over(along.rowsBetween(Window.unboundedPreceding, -1))
    again = F.greatest(F.least(F.col("last_offset"), F.col("__before")) - F.col("first_offset") + 1, F.lit(0))
    marked = ranges.withColumn("__before", before).withColumn("__new", F.coalesce((F.col("first_offset") > F.col("__before") + 1).cast("int"), F.lit(1)))
    marked = marked.withColumn("__again", F.when(F.col("__before").isNull(), 0).otherwise(again))
    island = F.sum("__new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (marked.withColumn("__island", island).groupBy(*by, "__island")
            .agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"),
                 (F.sum("n_repeated") + F.sum("__again")).alias("n_repeated")).drop("__island"))


def offset_ranges(messages: DataFrame) -> DataFrame:
    """partition, first_offset, last_offset, n_repeated of the messages' (partition, offset)."""
    seen = (messages.where("partition IS NOT NULL AND offset IS NOT NULL").groupBy("partition", "offset").agg((F.count(F.lit(1)) - 1).alias("n_repeated"))
            .select("partition", F.floor(F.col("offset") / BLOCK_OFFSETS).alias("__block"), F.col("offset").alias("first_offset"),
                    F.col("offset").alias("last_offset"), "n_repeated"))
    return _joined(_joined(seen, ["partition", "__block"]).drop("__block"), ["partition"]).select(*RANGE)


def offset_report(ranges: DataFrame) -> DataFrame:
    """kind (``range``, ``gap`` or ``repeat``), partition, first_offset, last_offset, n_messages: the ledger of all batches.
    A range counts its distinct messages, a gap the offsets that are missing; one ``repeat`` row per range with
    repeated messages counts their further deliveries."""
    whole = _joined(ranges.select(*RANGE), ["partition"])
    size = F.col("last_offset") - F.col("first_offset") + 1
    along = Window.partitionBy("partition").orderBy("first_offset")
    gaps = (whole.select("partition", (F.lag("last_offset").over(along) + 1).alias("first_offset"), (F.col("first_offset") - 1).alias("last_offset"))
            .where("first_offset IS NOT NULL"))
    cols = ["kind", "partition", "first_offset", "last_offset", "n_messages"]
    return (whole.select(F.lit("range").alias("kind"), "*", size.alias("n_messages")).select(*cols)
            .unionByName(gaps.select(F.lit("gap").alias("kind"), "*", size.alias("n_messages")).select(*cols))
            .unionByName(whole.where("n_repeated > 0").select(F.lit("repeat").alias("kind"), "partition", "first_offset", "last_offset",
                                                              F.col("n_repeated").alias("n_messages"))))
