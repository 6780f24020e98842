"""JDBC readers (snapshot and one-day increment).

A bare ``spark.read.jdbc(url, table)`` is one partition = one task and one connection reading the
whole table.  These readers split the read when the caller names a numeric/date
``partition_column`` with bounds (``numPartitions`` parallel range queries), and the increment's
day filter is pushed into the database as a ``>= day AND < day + 1`` range.
Credentials come only from the caller's ``properties``; specs must not embed them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.temporal import day_window_filter, resolve_as_of


def jdbc_options(url: str, table: str, properties: dict | None = None, partition_column: str | None = None,
                 lower_bound: object = None, upper_bound: object = None, num_partitions: int | None = None,
                 fetchsize: int | None = 10_000) -> dict:
    opts = {"url": url, "dbtable": table}
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    if fetchsize:
        opts["fetchsize"] = str(fetchsize)
    return opts


def read_jdbc_snapshot(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                       partition_column: str | None = None, lower_bound: object = None,
                       upper_bound: object = None, num_partitions: int | None = None,
                       predicates: list[str] | None = None) -> DataFrame:
    """Full-table snapshot.  ``predicates`` gives one reader per range instead of evenly spaced bounds (``even_ranges``)."""
    if predicates is not None:
        if partition_column is not None:
            raise ValueError("give predicates or partition_column, not both")
        return spark.read.jdbc(url, table, predicates=predicates, properties={"fetchsize": "10000", **{k: str(v) for k, v in (properties or {}).items()}})
    opts = jdbc_options(url, table, properties, partition_column, lower_bound, upper_bound, num_partitions)
    return spark.read.format("jdbc").options(**opts).load()


def one_day(df: DataFrame, date_column: str, day: dt.date) -> DataFrame:
    """Rows whose ``to_date(date_column)`` is ``day`` (pushed to the source as a range)."""
    return df.filter(day_window_filter(F.col(date_column), day, "eq"))


def read_jdbc_incremental(spark: SparkSession, url: str, table: str, date_column: str,
                          properties: dict | None = None, as_of: dt.date | str | None = None,
                          latency: int | None = None, partition_column: str | None = None,
                          lower_bound: object = None, upper_bound: object = None,
                          num_partitions: int | None = None) -> DataFrame:
    """Rows changed on the run day: ``to_date(date_column) = as_of`` (one day, not a high-water mark)."""
    day = resolve_as_of(as_of, latency)
    return one_day(read_jdbc_snapshot(spark, url, table, properties, partition_column, lower_bound,
                                      upper_bound, num_partitions), date_column, day)
