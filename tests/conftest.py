from __future__ import annotations

import os
import sys
import tempfile

import pytest
from change_log import LOG_SCHEMA, literal_rows

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    warehouse = tempfile.mkdtemp(prefix="tidemark-wh-")
    s = local_session(cores="*", shuffle_partitions=8, app="tidemark-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def literal_log(spark):
    return spark.createDataFrame(literal_rows(), LOG_SCHEMA)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tidemark-test-")
