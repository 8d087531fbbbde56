"""Spark result against SQL result: names, types, and rows as a bag."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

# Spark type -> the SQL type that holds the same values
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return con


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    """What differs, as sentences; empty if nothing does."""
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    expected_rows = cursor.fetchall()
    names = list(described)
    found = []
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if sorted(types) != sorted(names):
        return [f"columns {sorted(types)} against {sorted(names)}"]
    for name, kind in types.items():
        if SAME_TYPE[kind] != described[name]:
            found.append(f"{name} is {kind} against {described[name]}")
    expected = bag(names, expected_rows)
    got = bag(df.columns, df.collect())
    if got != expected:
        found.append(
            f"{got.total()} rows against {expected.total()}; "
            f"only in Spark {list((got - expected).items())[:3]}, "
            f"only in SQL {list((expected - got).items())[:3]}"
        )
    return found
