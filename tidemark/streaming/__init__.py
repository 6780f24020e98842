"""Structured Streaming jobs for change envelopes.

``read_change_stream``  Kafka topic (``value`` cast to string) or, offline, a directory of text/JSON
                        files with the same one-message-per-line content.
``write_change_stream`` append-mode file sink partitioned by event date, with a checkpoint folder
                        (exactly-once through the sink's commit log); trigger is configurable.
``stream_to_bronze``    envelopes -> normalised rows -> partitioned bronze files (+ quarantine sink).
``stream_scd2``         envelopes -> per micro-batch ``commit_scd2_batch`` (append-only history +
                        latest row per key, committed versions).
``drop_redelivered``    a stream without messages that the broker delivers again (keyed state, evicted by arrival time).
``offset_report``       the ledger of offsets that a stream keeps per micro-batch: ranges, gaps and repeats.
``run_stream_spec``     the streaming job entry point for an {"extract", "load"} spec (stable
                        per-topic checkpoint under ``spark.checkpoint.dir``).
"""

from tidemark.streaming.dedup import drop_redelivered  # noqa: F401
from tidemark.streaming.jobs import (  # noqa: F401
    read_change_stream,
    read_scd2_table,
    read_truncated_table,
    run_stream_spec,
    stream_scd2,
    stream_to_bronze,
    write_change_stream,
)
from tidemark.streaming.offsets import offset_ranges, offset_report  # noqa: F401
