import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def rows_of():
    """The rows of a test table, by SQL, without Spark."""

    def read(name, columns, where="true"):
        sql = f"select {columns} from '{SMALL}/{name}.parquet' where {where} order by 1"
        return duckdb.connect().execute(sql).fetchall()

    return read


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text[, source]) rows as documents with columns whose names clash."""

    def make(*rows):
        schema = "doc_id long, text string, source string, Text string, score double, fp long, size int"
        return spark.createDataFrame([(*r, *(None,) * (3 - len(r)), "other", 9.0, 1, 1) for r in rows], schema)

    return make
