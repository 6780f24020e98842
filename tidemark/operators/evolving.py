"""Change envelopes whose columns drift: fields appear, disappear and change their type from message to message.

A fixed schema would turn what it does not know into nulls.  Here images are parsed to VARIANT, the fields are those that occur in any
of them, and a field's type is one that holds all of its values:

* one scalar type throughout (numbers widen to a common one): that type;
* several types, nested values, or nulls only: STRING; objects and arrays as their JSON text.

So no value vanishes.  The merged schema is one aggregate over the messages (a schema per task, then merged); with ``known``
it also covers the fields of earlier batches, so that a table only ever gains columns or widens them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    LongType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from tidemark.functions.temporal import millis_to_ntz
from tidemark.functions.vocab import action_from_op


def _path(name: str) -> str:
    return f'$["{name}"]' if '"' not in name else f"$['{name}']"


def column_type(kind: DataType) -> DataType:
    """The type of a column for values of a VARIANT type."""
    return StringType() if isinstance(kind, (ArrayType, StructType, VariantType, NullType)) else kind


def common_type(a: DataType, b: DataType) -> DataType:
    """A type that holds all values of both."""
    if a == b:
        return a
    if isinstance(a, (LongType, DecimalType)) and isinstance(b, (LongType, DecimalType)):
        x, y = (DecimalType(19, 0) if isinstance(t, LongType) else t for t in (a, b))
        scale = max(x.scale, y.scale)
        whole = max(x.precision - x.scale, y.precision - y.scale)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else StringType()
    return StringType()


def merged_fields(images: DataFrame, image: str, known: StructType | None = None) -> StructType:
    """The fields of all VARIANT objects in the column ``image``, in the order of names, after those of ``known``."""
    text = images.where(F.col(image).isNotNull()).agg(F.schema_of_variant_agg(image)).first()[0]
    found = DataType.fromDDL(text.replace("OBJECT<", "STRUCT<")) if text and text.startswith("OBJECT<") else StructType([])
    types = {f.name: f.dataType for f in (known or StructType([])).fields}
    for f in found.fields:
        kind = column_type(f.dataType)
        only_nulls = isinstance(f.dataType, NullType)
        types[f.name] = kind if f.name not in types else types[f.name] if only_nulls else common_type(types[f.name], kind)
    return StructType([StructField(n, t) for n, t in types.items()])


def _value(image: Column, field: StructField) -> Column:
    path = _path(field.name)
    if not isinstance(field.dataType, StringType):
        return F.try_variant_get(image, path, field.dataType.simpleString())
    value = F.try_variant_get(image, path, "variant")
    text = F.coalesce(F.try_variant_get(image, path, "string"), F.to_json(value))
    return F.when(~F.is_variant_null(value), text)


def _once(df: DataFrame, keep: Sequence[str], *columns: Column) -> DataFrame:
    """The columns ``keep`` and new ones, which come out of a generator: later filters and projections do not repeat their work."""
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))


def normalize_envelope_evolving(df: DataFrame, value_col: str = "value", keys: Sequence[str] = ("id",), known: StructType | None = None,
                                seq_field: str | None = None) -> tuple[DataFrame, DataFrame, StructType]:
    """``(good, quarantine, fields)``: like ``normalize_envelope``, with the fields that the images have.

    Both wrappers are accepted.  Quarantine holds what ``normalize_envelope`` would reject: malformed, null and unsupported
    messages, missing times and images, and rows whose ``keys`` are null.  Images that are no objects count as missing."""
    raw = F.col(value_col).cast("string")
    # inside generators, so that each message is parsed and each of its parts is taken out once
    parsed = df.select(raw.alias("__raw"), F.explode(F.array(F.try_parse_json(raw))).alias("__m"))
    payload = F.try_variant_get("__m", "$.payload", "variant")
    body = _once(parsed, ["__raw"], F.coalesce(F.when(~F.is_variant_null(payload), payload), F.col("__m")).alias("__v"))
    body = _once(body, ["__raw", "__v"], F.try_variant_get("__v", "$.op", "string").alias("operation"))
    op = F.col("operation")
    image = F.when(op == "d", F.try_variant_get("__v", "$.before", "variant")).otherwise(F.try_variant_get("__v", "$.after", "variant"))
    body = _once(body, ["__raw", "operation"], image.alias("__i"), millis_to_ntz(F.try_variant_get("__v", "$.source.ts_ms", "bigint")).alias("updated_timestamp"),
                 *([F.try_variant_get("__v", f"$.source.{seq_field}", "bigint").alias("seq")] if seq_field else []))
    flat = _once(body, ["__raw", "operation", "updated_timestamp", *(["seq"] if seq_field else [])],
                 action_from_op(op).alias("action"), F.when(F.schema_of_variant("__i").startswith("OBJECT<"), F.col("__i")).alias("__image"))
    fields = merged_fields(flat, "__image", known)
    missing = [k for k in keys if k not in fields.names]
    fields = StructType(fields.fields + [StructField(k, StringType()) for k in missing])
    clash = set(fields.names) & {"operation", "action", "updated_timestamp", "partition_date", *(["seq"] if seq_field else [])}
    if clash:
        raise ValueError(f"image fields {sorted(clash)} have the names of change columns")
    values = [_value(F.col("__image"), f).alias(f"__f{i}") for i, f in enumerate(fields.fields)]
    rows = _once(flat, ["__raw", "operation", "action", "updated_timestamp", *(["seq"] if seq_field else [])], F.col("__image").isNull().alias("__none"), *values)
    rows = rows.select("__raw", "operation", "action", *[F.col(f"__f{i}").alias(f.name) for i, f in enumerate(fields.fields)], "updated_timestamp",
                       F.to_date("updated_timestamp").alias("partition_date"), "__none", *(["seq"] if seq_field else []))
    reason = (F.when(F.col("__raw").isNull(), F.lit("null message"))
              .when(F.col("operation").isNull(), F.lit("malformed envelope"))
              .when(F.col("action").isNull(), F.lit("unsupported op"))
              .when(F.col("updated_timestamp").isNull(), F.lit("missing change time"))
              .when(F.col("__none"), F.lit("missing row image")))
    for k in keys:
        reason = reason.when(F.col(f"`{k}`").isNull(), F.lit("missing key"))
    rows = rows.withColumn("__reason", reason)
    good = rows.where("__reason IS NULL").drop("__raw", "__none", "__reason")
    return good, rows.where("__reason IS NOT NULL").select(F.col("__raw").alias("raw"), F.col("__reason").alias("reason")), fields
