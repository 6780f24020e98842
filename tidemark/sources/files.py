"""File and catalog readers.  Each returns a lazy DataFrame whose filters reach the scan
(``PartitionFilters`` for the partition column, ``PushedFilters`` for data columns)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.temporal import day_window_filter, resolve_as_of


def _load(spark: SparkSession, file_path: str, file_format: str | None, options: dict | None = None) -> DataFrame:
    fmt = (file_format or "parquet").lower()
    if fmt in ("table", "iceberg", "delta") and spark.catalog.tableExists(file_path):
        return spark.table(file_path)
    reader = spark.read.format("parquet" if fmt == "table" else fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(file_path)


def read_partition(spark: SparkSession, file_path: str, file_format: str = "parquet",
                   as_of: dt.date | str | None = None, latency: int | None = None,
                   partition_column: str = "partition_date") -> DataFrame:
    """One day partition of a date-partitioned layer (``partition_column = as_of``).

    Reads the layer root and filters, so the partition column stays in the result and Spark prunes
    every other partition directory at planning time.
    """
    day = resolve_as_of(as_of, latency)
    return _load(spark, file_path, file_format).filter(F.col(partition_column) == F.lit(day))


def read_as_of(spark: SparkSession, file_path: str, date_column: str, file_format: str = "parquet",
               as_of: dt.date | str | None = None, latency: int | None = None) -> DataFrame:
    """All rows with ``to_date(date_column) <= as_of`` (path or catalog table)."""
    day = resolve_as_of(as_of, latency)
    return _load(spark, file_path, file_format).filter(day_window_filter(F.col(date_column), day, "le"))


def read_file(spark: SparkSession, file_path: str, file_format: str = "parquet",
              header: bool = True, options: dict | None = None) -> DataFrame:
    """Whole file/directory read.  CSV keeps the header's column names and all-string columns
    (no schema inference pass over the data)."""
    opts = dict(options or {})
    if (file_format or "").lower() == "csv":
        opts.setdefault("header", str(header).lower())
        opts.setdefault("inferSchema", "false")
    return _load(spark, file_path, file_format, opts)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """Unfiltered catalog table read."""
    return spark.table(table)
