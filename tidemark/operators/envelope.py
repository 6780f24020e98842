"""Change-envelope normalisation (Debezium-style JSON messages) -> flat change rows.

Works unchanged on batch and streaming DataFrames (stateless projection, JVM-side ``from_json``).

Envelope (either wrapped in ``payload`` or bare, both accepted):
    {"payload": {"before": {...}, "after": {...}, "op": "c|r|u|d", "source": {"ts_ms": <epoch ms>}}}
Fixed values: op codes c, r, u, d; a delete ('d') carries its row image in ``before``, every
other op in ``after``; the change time is ``source.ts_ms`` in epoch milliseconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.functions.temporal import millis_to_ntz
from tidemark.functions.vocab import TRUNCATE_OP, action_from_op

DEFAULT_FIELDS = StructType([
    StructField("id", StringType()),
    StructField("name", StringType()),
    StructField("email", StringType()),
])

LEGACY_AFTER_FIELDS = StructType([
    StructField("id", StringType()),
    StructField("name", StringType()),
    StructField("email", StringType()),
    StructField("update_timestamp", StringType()),
])


def envelope_schema(fields: StructType, seq_field: str | None = None) -> StructType:
    """Schema that parses both the wrapped and the bare envelope in one pass."""
    source = [StructField("ts_ms", LongType())]
    if seq_field:
        source.append(StructField(seq_field, LongType()))
    inner = [
        StructField("before", fields),
        StructField("after", fields),
        StructField("op", StringType()),
        StructField("source", StructType(source)),
    ]
    return StructType([StructField("payload", StructType(inner))] + inner)


def parse_envelopes(df: DataFrame, value_col: str, fields: StructType, seq_field: str | None = None,
                    keep: Sequence[str] = ()) -> DataFrame:
    """``__raw`` plus the unified ``__before, __after, __op, __source`` of each message, and the columns ``keep`` beside it.

    The JSON is parsed exactly once per message: ``from_json`` runs inside a generator
    (``inline_outer``), and Catalyst neither pushes later filters below a generator nor inlines its
    output, so the quarantine split and the field projections cannot multiply the parse.
    """
    raw = F.col(value_col).cast("string")
    parsed = df.select(raw.alias("__raw"), *keep,
                       F.inline_outer(F.array(F.from_json(raw, envelope_schema(fields, seq_field)))))
    wrapped = F.col("payload").isNotNull()
    return parsed.select(
        "__raw", *keep,
        *[F.when(wrapped, F.col("payload")[n]).otherwise(F.col(n)).alias(f"__{n}")
          for n in ("before", "after", "op", "source")])


def normalize_envelope(df: DataFrame, value_col: str = "value", fields: StructType = DEFAULT_FIELDS,
                       ntz: bool = True, keep_raw: bool = False, seq_field: str | None = None,
                       keys: Sequence[str] | None = None, parsed: bool = False,
                       truncates: bool = False) -> tuple[DataFrame, DataFrame]:
    """Flatten envelopes into ``(operation, action, <fields>, updated_timestamp, partition_date)``.

    Returns ``(good, quarantine)``.  Quarantine holds the raw text and a ``reason`` for malformed
    JSON, null messages, unknown op codes (e.g. 't' truncate), missing change times, missing row images and rows
    without a key (one of ``keys``, by default the first field, is null or not of its type) -- rows the
    plain parse would have turned into all-null records.  ``partition_date`` is the event date, so a
    late change lands in its own (old) partition.  With ``seq_field`` (e.g. the log position ``lsn``)
    that ``source`` field is emitted as ``seq``, the tie-break for changes in the same millisecond.  With ``truncates`` the
    truncate messages that have a time are in neither: the caller takes them with ``truncate_events``.
    """
    env = df if parsed else parse_envelopes(df, value_col, fields, seq_field)   # parsed: df comes from parse_envelopes
    if truncates:
        env = env.where(~(F.col("__op").eqNullSafe(TRUNCATE_OP) & F.col("__source.ts_ms").isNotNull()))
    op = F.col("__op")
    image = F.when(op == "d", F.col("__before")).otherwise(F.col("__after"))
    ms = F.col("__source.ts_ms")
    ts = millis_to_ntz(ms) if ntz else F.timestamp_millis(ms)
    flat = env.select(
        F.col("__raw"),
        op.alias("operation"),
        action_from_op(op).alias("action"),
        *[image[f.name].alias(f.name) for f in fields.fields],
        ts.alias("updated_timestamp"),
        image.alias("__image"),
        *([F.col(f"__source.{seq_field}").alias("seq")] if seq_field else []),
    ).withColumn("partition_date", F.to_date(F.col("updated_timestamp")))

    reason = (F.when(F.col("__raw").isNull(), F.lit("null message"))
              .when(F.col("operation").isNull(), F.lit("malformed envelope"))
              .when(F.col("action").isNull(), F.lit("unsupported op"))
              .when(F.col("updated_timestamp").isNull(), F.lit("missing change time"))
              .when(F.col("__image").isNull(), F.lit("missing row image")))
    for key in keys or fields.names[:1]:
        reason = reason.when(F.col(key).isNull(), F.lit("missing key"))
    flat = flat.withColumn("__reason", reason)
    good_cols = ["operation", "action", *[f.name for f in fields.fields], "updated_timestamp", "partition_date",
                 *(["seq"] if seq_field else [])]
    good = flat.filter(F.col("__reason").isNull()).select(*good_cols, *(["__raw"] if keep_raw else []))
    quarantine = flat.filter(F.col("__reason").isNotNull()).select(
        F.col("__raw").alias("raw"), F.col("__reason").alias("reason"))
    return good, quarantine


def normalize_after_image(df: DataFrame, value_col: str = "value",
                          fields: StructType = LEGACY_AFTER_FIELDS,
                          timestamp_field: str | None = "update_timestamp") -> DataFrame:
    """Legacy flattening: the ``after`` image's fields plus ``op``; deletes therefore give nulls.

    The legacy change time travels as text; it is cast to TIMESTAMP_NTZ (``try_cast``: a bad value
    becomes null instead of failing the job under ANSI mode).
    """
    env = parse_envelopes(df, value_col, fields)
    cols = []
    for f in fields.fields:
        c = F.col("__after")[f.name]
        if f.name == timestamp_field:
            c = c.try_cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return env.select(*cols, F.col("__op").alias("op"))
