"""Raw -> bronze over any reader: one call for the incremental and the snapshot job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.temporal import day_window_filter, resolve_as_of
from tidemark.sinks import write_files


def raw_to_bronze(spark: SparkSession, raw: DataFrame, path: str, kind: str = "incremental", ts: str = "updated_timestamp",
                  as_of: dt.date | str | None = None, latency: int | None = None, date_column: str = "partition_date",
                  format: str = "parquet") -> str:
    """Load one day into the bronze layer at ``path``; a rerun of a day replaces that day only.

    ``incremental``: the rows changed on the run day (the filter reaches the source), in the partition of their change time;
    ``snapshot``: all rows, in the partition of the run day.  A day without rows leaves the layer as it is."""
    day = resolve_as_of(as_of, latency)
    if kind == "incremental":
        rows = raw.where(day_window_filter(F.col(ts), day, "eq")).withColumn(date_column, F.to_date(ts))
    elif kind == "snapshot":
        rows = raw.withColumn(date_column, F.lit(day))
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return write_files(spark, rows, path, format=format, mode="overwrite", partition_by=date_column)
