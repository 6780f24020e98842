"""Batch readers and the name -> reader registry used by spec ``extract`` entries.

Old reader names found in specs are registered as aliases of the current ones.
"""

from tidemark.sources.files import read_as_of, read_file, read_partition, read_table
from tidemark.sources.jdbc import read_jdbc_incremental, read_jdbc_snapshot
from tidemark.sources.ranges import even_ranges, read_ranges

READERS = {
    "read_partition": read_partition,
    "read_as_of": read_as_of,
    "read_file": read_file,
    "read_table": read_table,
    "read_jdbc_snapshot": read_jdbc_snapshot,
    "read_jdbc_incremental": read_jdbc_incremental,
    # names used by older specs
    "read_bronze": read_partition,
    "read_iceberg": read_as_of,
    "read_jdbc_cdc5": read_jdbc_snapshot,
    "read_jdbc_cdc4": read_jdbc_incremental,
    "read_jdbc": read_jdbc_incremental,
}

__all__ = ["READERS", "read_as_of", "read_file", "read_partition", "read_table",
           "read_jdbc_incremental", "read_jdbc_snapshot", "even_ranges", "read_ranges"]
