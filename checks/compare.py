"""Run a query and its SQL oracle side by side."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark type names and the DuckDB types they must meet.
_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _type(spark_type: str) -> str:
    return _TYPES.get(spark_type, spark_type.upper())


def differences(got: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, exactly: names, types, row count, values. Empty when equal."""
    cursor = con.execute(sql)
    want_types = {d[0]: str(d[1]).replace(" ", "") for d in cursor.description}
    names = sorted(want_types)
    if sorted(got.columns) != names:
        return [f"columns {sorted(got.columns)} != {names}"]
    out = [
        f"type of {c}: {t} != {want_types[c]}"
        for c, t in got.dtypes
        if _type(t).replace(" ", "") != want_types[c]
    ]
    order = [d[0] for d in cursor.description]
    index = [order.index(n) for n in names]
    want = Counter(tuple(row[i] for i in index) for row in cursor.fetchall())
    have = Counter(tuple(r) for r in got.select(*[f"`{n}`" for n in names]).collect())
    if have != want:
        missing, extra = want - have, have - want
        out.append(
            f"rows {have.total()} vs {want.total()}; missing {missing.total()} e.g. "
            f"{list(missing)[:2]}; extra {extra.total()} e.g. {list(extra)[:2]}; columns {names}"
        )
    return out
