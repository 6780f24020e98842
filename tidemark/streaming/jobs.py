"""Streaming source, sink and the two streaming jobs (see package docstring)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.envelope import DEFAULT_FIELDS, normalize_envelope, parse_envelopes
from tidemark.operators.truncates import close_at_truncates, truncate_events
from tidemark.session import ensure_checkpoint_dir, remove, scratch_path
from tidemark.sinks import commit_scd2_batch, committed_batch, read_scd2_table, write_table
from tidemark.streaming.dedup import drop_redelivered
from tidemark.streaming.offsets import offset_ranges

CHANGE_SEQ = "change_seq"


def read_change_stream(spark: SparkSession, kafka_bootstrap: str | None = None, topic: str | None = None,
                       mode: str = "earliest", path: str | None = None, file_format: str = "text",
                       max_files_per_trigger: int | None = None,
                       max_offsets_per_trigger: int | None = None, schema: str | None = None,
                       position: bool = False) -> DataFrame:
    """A streaming DataFrame with one string column ``value`` holding one envelope per row; with ``position`` also the
    message's ``partition`` and ``offset`` (files hold them as columns, and need a ``schema``).

    ``kafka_bootstrap`` + ``topic`` -> Kafka source (needs the Kafka connector on the classpath);
    ``mode`` is ``startingOffsets`` (earliest | latest).  Otherwise ``path`` is watched for new files.
    """
    if kafka_bootstrap:
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", kafka_bootstrap)
             .option("subscribe", topic)
             .option("startingOffsets", mode))
        if max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        return r.load().selectExpr("CAST(value AS STRING) AS value", *(("partition", "offset") if position else ()))
    if path is None:
        raise ValueError("read_change_stream needs kafka_bootstrap+topic or path")
    r = spark.readStream.format(file_format)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = (r.schema(schema) if schema else r).load(path)
    return df.selectExpr("CAST(value AS STRING) AS value", *(("partition", "offset") if position else ())) if "value" in df.columns else df


def _trigger(writer, trigger: str | None):
    if trigger is None:
        return writer
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    if trigger.startswith("processingTime:"):
        return writer.trigger(processingTime=trigger.split(":", 1)[1])
    raise ValueError(f"unknown trigger {trigger!r}")


def write_change_stream(df: DataFrame, path: str, checkpoint_location: str,
                        partition_by: str | Sequence[str] | None = "partition_date", format: str = "parquet",
                        trigger: str | None = "availableNow", query_name: str | None = None) -> StreamingQuery:
    """Append-mode streaming file sink.  ``format="console"``/``"memory"`` for inspection."""
    w = df.writeStream.format(format).outputMode("append").option("checkpointLocation", checkpoint_location)
    if format not in ("console", "memory"):
        w = w.option("path", path)
        if partition_by:
            w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    else:
        w = w.option("truncate", "false")
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start()


def _messages(spark: SparkSession, source: dict, dedup_within: str | None) -> DataFrame:
    raw = read_change_stream(spark, **source)
    return drop_redelivered(raw, dedup_within, ("value",)) if dedup_within else raw


def _one_parse(batch: DataFrame, write) -> None:  # noqa: ANN001
    """Give ``write`` a copy of the parsed batch on the shared scratch folder, as it is read more than once; the copy goes
    when the batch is written (one that failed leaves its copy, and its replay makes another)."""
    path = scratch_path(batch.sparkSession, "micro-batch")
    batch.write.parquet(path)
    write(batch.sparkSession.read.schema(batch.schema).parquet(path))
    remove(batch.sparkSession, path)


def stream_to_bronze(spark: SparkSession, source: dict, bronze_path: str, checkpoint_location: str,
                     fields: StructType = DEFAULT_FIELDS, quarantine_path: str | None = None,
                     trigger: str | None = "availableNow",
                     partition_by: str | Sequence[str] = "partition_date",
                     format: str = "parquet", dedup_within: str | None = None,
                     ledger_path: str | None = None) -> list[StreamingQuery]:
    """Envelopes -> normalised change rows -> bronze files partitioned by micro-batch and event date.

    Late changes land in their own (old) ``partition_date``; nothing is dropped.  Rejected messages go to
    ``quarantine_path`` (default: ``bronze_path`` with ``_quarantine``).  Each message is parsed once for both.  A
    micro-batch writes its own ``batch_id`` folders, so a replayed one replaces them (exactly once), and its files are
    rebalanced by date.  The layers have the extra column ``batch_id``.  With ``dedup_within`` (a time, e.g. ``"1 day"``)
    messages that the broker delivers again within that time are left out (``drop_redelivered``).  With ``ledger_path`` the
    offsets that each micro-batch holds are kept there as ranges (``offset_ranges``; read them with ``offset_report``); the
    source must give positions.
    """
    raw = _messages(spark, source, dedup_within)
    position = ("partition", "offset") if ledger_path else ()
    rejected = quarantine_path or bronze_path.rstrip("/") + "_quarantine"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        def both(messages: DataFrame) -> None:
            good, bad = normalize_envelope(messages, "value", fields, parsed=True)
            write_table(batch.sparkSession, good, path=bronze_path, partition_by=partition_by, format=format, load_id=batch_id,
                        load_column="batch_id")
            write_table(batch.sparkSession, bad, path=rejected, load_id=batch_id, load_column="batch_id")
            if ledger_path:
                write_table(batch.sparkSession, offset_ranges(messages), path=ledger_path, load_id=batch_id, load_column="batch_id")
        _one_parse(parse_envelopes(batch, "value", fields, keep=position), both)

    w = raw.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    return [_trigger(w, trigger).start()]


def run_stream_spec(spark: SparkSession, spec: dict, fields: StructType = DEFAULT_FIELDS,
                    trigger: str | None = None, await_termination: bool = False) -> list[StreamingQuery]:
    """The streaming job entry point for a spec shaped like

        {"extract": {"topic": ..., "kafka_bootstrap": ..., "mode": "earliest"}   (or {"path": ...})
         "load":    {"topic": ..., "format": "parquet", "path": ..., "partition_by": "partition_date"}}

    The checkpoint is ``load.checkpoint_location`` or, by default, a stable folder per topic under the
    session's shared ``spark.checkpoint.dir``, so a restart resumes where the last run stopped.  The
    default trigger runs micro-batches continuously; ``"availableNow"`` drains what is there and stops.
    With ``"type": "scd2"`` in ``load`` the stream keeps the SCD2 table at ``path`` instead
    (``stream_scd2``; optional ``keys``, ``seq_field``, ``quarantine_path``, ``truncates``).  ``dedup_within`` leaves out what
    the broker delivers again within that time.  Unknown arguments are errors.
    """
    extract_args, load_args = dict(spec["extract"]), dict(spec["load"])
    unknown = set(load_args) - {"topic", "type", "path", "checkpoint_location", "trigger", "quarantine_path", "dedup_within",
                                *(("keys", "seq_field", "truncates") if load_args.get("type") == "scd2" else ("partition_by", "format"))}
    if unknown:
        raise ValueError(f"unknown load arguments {sorted(unknown)}")
    name = load_args.get("topic") or extract_args.get("topic") or "stream"
    checkpoint = (load_args.get("checkpoint_location")
                  or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/cdc_{name}")
    if load_args.get("type") == "scd2":
        queries = [stream_scd2(spark, extract_args, load_args["path"], checkpoint, fields=fields,
                               keys=tuple(load_args.get("keys", ("id",))), trigger=trigger or load_args.get("trigger"),
                               quarantine_path=load_args.get("quarantine_path"), seq_field=load_args.get("seq_field"),
                               dedup_within=load_args.get("dedup_within"), truncates=bool(load_args.get("truncates", False)))]
    else:
        queries = stream_to_bronze(spark, extract_args, load_args["path"], checkpoint, fields=fields,
                                   quarantine_path=load_args.get("quarantine_path"),
                                   trigger=trigger or load_args.get("trigger"),
                                   partition_by=load_args.get("partition_by", "partition_date"),
                                   format=load_args.get("format", "parquet"), dedup_within=load_args.get("dedup_within"))
    if await_termination:
        for q in queries:
            q.awaitTermination()
    return queries


# --- SCD2 kept up to date by micro-batches -------------------------------------------------------

def stream_scd2(spark: SparkSession, source: dict, target_root: str, checkpoint_location: str,
                fields: StructType = DEFAULT_FIELDS, keys: Sequence[str] = ("id",),
                trigger: str | None = "availableNow", seq_field: str | None = None,
                quarantine_path: str | None = None, dedup_within: str | None = None,
                truncates: bool = False) -> StreamingQuery:
    """Each micro-batch: normalise, then ``commit_scd2_batch`` as batch ``batch_id`` of the SCD2 table at
    ``target_root`` (see ``sinks.state``).  Late rows stay in ``target_root``/late, rejected messages go to
    ``quarantine_path`` (default: ``target_root``/quarantine), both by batch, so a replay replaces them.
    Read the table with ``read_scd2_table``.

    With ``truncates`` truncate messages are kept by batch beside the table, which then has the column ``change_seq`` where
    there is a ``seq_field``; read it with ``read_truncated_table``.
    """
    raw = _messages(spark, source, dedup_within)
    tie = ("seq",) if seq_field else ()
    rejected = quarantine_path or f"{target_root.rstrip('/')}/quarantine"

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        def both(messages: DataFrame) -> None:
            good, bad = normalize_envelope(messages, "value", fields, seq_field=seq_field, keys=keys, parsed=True, truncates=truncates)
            if truncates:
                good = good.withColumn(CHANGE_SEQ, F.col("seq")) if seq_field else good
                write_table(batch.sparkSession, truncate_events(messages, seq_field=seq_field), path=_truncates_of(target_root),
                            load_id=batch_id, load_column="batch_id")
            write_table(batch.sparkSession, bad, path=rejected, load_id=batch_id, load_column="batch_id")
            commit_scd2_batch(batch.sparkSession, target_root, good.drop("operation"), batch_id, keys=keys,
                              ts="updated_timestamp", tie=tie, drop=("partition_date",))
        _one_parse(parse_envelopes(batch, "value", fields, seq_field), both)

    w = raw.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint_location)
    return _trigger(w, trigger).start()


def _truncates_of(root: str) -> str:
    return f"{root.rstrip('/')}/truncates"


def read_truncated_table(spark: SparkSession, root: str, keys: Sequence[str] = ("id",), seq_field: str | None = None) -> DataFrame | None:
    """The table that ``stream_scd2(..., truncates=True)`` keeps: its committed intervals, ended by the truncates of
    committed batches."""
    table = read_scd2_table(spark, root, keys, tie=("seq",) if seq_field else ())
    if table is None:
        return None
    events = spark.read.parquet(_truncates_of(root)).where(F.col("batch_id").cast("long") <= committed_batch(spark, root))
    tie, at = (("seq",), (CHANGE_SEQ,)) if seq_field else ((), ())
    return close_at_truncates(table, events, tie=tie, position=at)


__all__ = ["drop_redelivered", "read_change_stream", "read_truncated_table", "read_scd2_table", "run_stream_spec", "stream_scd2", "stream_to_bronze",
           "write_change_stream"]
