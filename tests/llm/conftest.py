from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
#: Nulls, empty and blank texts, repeated rows, ties, one long text, odd white space, non-ASCII.
TRICKY = [(None, None), (None, "same text here"), (1, None), (2, ""), (3, " \t\n "), (4, "a"), (5, "a b"), (5, "a b"), (5, "b a c d"),
          (6, "AÉé x\x0by\x0cz\x1cw  two  spaces \n\nend "), (7, "long " * 20_000), (8, "x" * 3000), (9, "same text here"),
          (10, "don't 'll 12 3.5 nbsp 　wide"), (11, "a b")]


@pytest.fixture()
def tricky(spark):
    """TRICKY as documents with extra columns whose names clash with results and helpers."""
    rows = [(i, t, 1, 2.0, "r", 5) for i, t in TRICKY]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, score double, row string, block int")


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def sample(spark):
    """A small table of real rows."""
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture()
def as_tables(tmp_path):
    """Write frames as the tables of a folder and return it."""
    def write(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write
