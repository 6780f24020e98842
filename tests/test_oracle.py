"""Every registered query equals its DuckDB oracle (row count, columns, order-insensitive values) at sf0.001."""

from __future__ import annotations

import pytest
from change_log import SF

from __spark_entry__ import oracle_sql, queries
from tools.check_oracle import digest, duck

ORACLES = oracle_sql()


@pytest.mark.parametrize("name", sorted(set(queries()) & set(ORACLES)))
def test_query_matches_oracle(spark, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cols, got = digest(df.columns, rows)
    ocols, orows = duck(SF, ORACLES[name])
    ocols, want = digest(ocols, orows)
    assert cols == ocols
    assert len(rows) == len(orows)
    assert got == want


def test_entry_runs(spark):
    from __spark_entry__ import entry
    assert entry(spark).count() > 0


def test_leading_space_in_expression_is_accepted(spark):
    """Old specs wrote `" F.row_number()..."`; SQL expression strings with stray spaces still work."""
    from tidemark.plans import run_spec
    spec = {"extract_dfs": {"n": {"type": "read_file", "file_path": f"{SF}/nation.parquet"}},
            "transform_dfs": {"n": [{"op": "withColumn", "args": {
                "colName": "rn", "col": " row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC)"}},
                {"op": "filter", "args": {"condition": " rn = 1 "}}]}}
    assert run_spec(spark, spec)["n"].count() == 5
