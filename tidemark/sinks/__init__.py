"""Batch sinks and the writer registry used by spec ``load`` entries.

``write_files``  partitioned file write; ``mode="overwrite"`` replaces only the partitions present
                 in the data (dynamic partition overwrite), which makes a rerun of a day idempotent.
``write_table``  catalog or path table: ``append`` | ``overwrite_partitions`` | ``replace``, or one load by ``load_id``.
                 An overwrite of a table or path the plan itself reads goes through a staging copy
                 under the shared checkpoint folder (Spark refuses it for tables, and for paths it
                 would delete the input before reading it).

Partitioned writes are preceded by a REBALANCE hint on the partition columns: AQE then coalesces
small output partitions (no tiny files) and splits a skewed one (a hot day is not one task).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import path_exists, qualify, scratch_path


def _as_list(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def _writer(df: DataFrame, fmt: str, mode: str, partition_by: list[str], dynamic: bool, rebalance: bool):
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    w = df.write.format(fmt).mode(mode)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def read_roots(spark: SparkSession, df: DataFrame) -> list[str]:
    """Root paths of the files that the plan of ``df`` reads, through cached frames too: one entry per scanned relation."""
    roots = []
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and hasattr(leaf.relation(), "location"):
            paths = leaf.relation().location().rootPaths()
            roots += [paths.apply(j).toString().rstrip("/") for j in range(paths.size())]
    return [qualify(spark, r) for r in roots]


def reads_from(spark: SparkSession, df: DataFrame, path: str) -> bool:
    """Whether the plan of ``df`` reads ``path``, a folder above or below it (checked before overwriting it:
    Spark would delete the files first and then fail, or silently lose them, when reading them)."""
    target = qualify(spark, path) + "/"
    return any(target.startswith(r + "/") or (r + "/").startswith(target) for r in read_roots(spark, df))


def _stage(spark: SparkSession, df: DataFrame, fmt: str) -> DataFrame:
    """Materialise ``df`` under the shared checkpoint folder and return a reader of that copy."""
    staging = scratch_path(spark, "staging")
    df.write.format(fmt).mode("overwrite").save(staging)
    return spark.read.format(fmt).load(staging)


def write_files(spark: SparkSession, df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite",
                partition_by: str | Sequence[str] | None = None, dynamic: bool = True,
                rebalance: bool = True) -> str:
    """``df.write.format().mode().partitionBy().save(path)``; dynamic partition overwrite by default.
    A plan that reads ``path`` itself is staged first when the write would delete files."""
    if mode == "overwrite" and path_exists(spark, path) and reads_from(spark, df, path):
        df = _stage(spark, df, format)
    _writer(df, format, mode, _as_list(partition_by), dynamic, rebalance).save(path)
    return path


def _namespace_of(table_name: str) -> str | None:
    parts = table_name.split(".")
    return ".".join(parts[:-1]) if len(parts) > 1 else None


def write_table(spark: SparkSession, df: DataFrame, table_name: str | None = None, path: str | None = None,
                mode: str = "append", partition_by: str | Sequence[str] | None = None,
                format: str = "parquet", rebalance: bool = True, load_id: int | str | None = None,
                load_column: str = "load_id") -> str:
    """Create-or-append / overwrite-partitions / replace a catalog table (``table_name``) or a
    path table (``path``).  Returns the table name or path written.

    With ``load_id`` the rows of one load are kept apart in a partition (column ``load_column``), and writing a load again
    replaces exactly its own rows, whatever dates they fall on; ``mode`` is not used."""
    parts = _as_list(partition_by)
    if load_id is not None:
        df = df.withColumn(load_column, F.lit(str(load_id)))
        parts = [load_column, *[p for p in parts if p != load_column]]
        if path is not None:
            own = f"{path.rstrip('/')}/{load_column}={load_id}"
            if path_exists(spark, own) and reads_from(spark, df, path):
                df = _stage(spark, df, format)
            _writer(df.drop(load_column), format, "overwrite", parts[1:], False, rebalance).save(own)
            return path
        mode = "append"
    if mode not in ("append", "overwrite_partitions", "replace"):
        raise ValueError(f"unknown table write mode {mode!r}")
    spark_mode = "append" if mode == "append" else "overwrite"
    dynamic = mode == "overwrite_partitions"

    if path is not None:
        if spark_mode == "overwrite" and path_exists(spark, path) and reads_from(spark, df, path):
            df = _stage(spark, df, format)
        _writer(df, format, spark_mode, parts, dynamic, rebalance).save(path)
        return path

    if table_name is None:
        raise ValueError("write_table needs table_name or path")
    ns = _namespace_of(table_name)
    if ns:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {ns}")
    if not spark.catalog.tableExists(table_name):
        _writer(df, format, "overwrite", parts, False, rebalance).saveAsTable(table_name)
        return table_name
    own_rows = any(reads_from(spark, df, r) for r in read_roots(spark, spark.table(table_name)))
    if mode == "replace":
        _writer(_stage(spark, df, format) if own_rows else df, format, "overwrite", parts, False, rebalance).saveAsTable(table_name)
        return table_name
    target_cols = spark.table(table_name).columns
    if set(target_cols) != set(df.columns):
        raise ValueError(f"{table_name} has columns {sorted(target_cols)}, the rows {sorted(df.columns)}")
    aligned = df.select(*target_cols)
    if own_rows and (dynamic or load_id is not None):
        aligned = _stage(spark, aligned, format)
    if load_id is not None:   # static partition value: exactly this load's rows are replaced
        rows = aligned.drop(load_column)
        rows = rows.hint("rebalance", *parts[1:]) if parts[1:] and rebalance else rows
        view = f"load_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        spec = ", ".join([f"`{load_column}` = '{load_id}'", *[f"`{p}`" for p in parts[1:]]])
        try:
            spark.sql(f"INSERT OVERWRITE TABLE {table_name} PARTITION ({spec}) SELECT * FROM {view}")
        finally:
            spark.catalog.dropTempView(view)
        return table_name
    if parts and rebalance:
        aligned = aligned.hint("rebalance", *parts)
    if dynamic:
        aligned.write.option("partitionOverwriteMode", "dynamic").insertInto(table_name, overwrite=True)
    else:
        aligned.write.insertInto(table_name)
    return table_name


def write_bucketed(spark: SparkSession, df: DataFrame, table_name: str, keys: Sequence[str], buckets: int) -> str:
    """A new catalog table in ``buckets`` buckets by ``keys``, sorted within them.  Rows that are already dealt so (the result of
    ``merge_current_bucketed``) are written where they are.  An existing table is refused: write the next version of a
    table under its own name, then drop the old one."""
    ns = _namespace_of(table_name)
    if ns:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {ns}")
    df.write.format("parquet").mode("error").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table_name)
    return table_name


# spec "load" types -> (default table write mode, table-name suffix).  History kinds append: several loads may hold rows
# of one day, and late rows fall on old days.  Give a ``load_id`` to make a load repeatable: writing it again
# replaces its own rows and no others.
TABLE_KINDS = {
    "scd2": ("append", "_scd2"),
    "scd4_hist": ("append", "_scd4_hist"),
    "scd4a_hist": ("append", "_scd4a_hist"),
    "scd4_current": ("replace", "_scd4_current"),
    "scd4a_current": ("replace", "_scd4a_current"),
}

WRITERS = {
    "write_files": write_files,
    "write_table": write_table,
    "write_file": write_files,
}

from tidemark.sinks.state import (  # noqa: E402
    commit_scd2_batch,
    committed_batch,
    fold_state,
    read_late,
    read_scd2_state,
    read_scd2_table,
    read_state,
    state_note,
)

__all__ = ["TABLE_KINDS", "WRITERS", "commit_scd2_batch", "committed_batch", "fold_state", "read_late", "read_scd2_state", "read_scd2_table",
           "read_state", "state_note",
           "write_bucketed", "write_files", "write_table"]
