"""Small inputs and plain-Python answers."""

from __future__ import annotations

import os
import time
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

START = datetime(2024, 1, 1, 12, 0, 0)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def instants(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Rows whose TIMESTAMP columns are given as UTC wall-clock times."""
    loose = ddl.replace("TIMESTAMP", "TIMESTAMP_NTZ")
    names = [part.split()[0] for part in ddl.split(",")]
    kinds = [part.split()[1] for part in ddl.split(",")]
    df = spark.createDataFrame(rows, loose)
    return df.selectExpr(*[f"CAST({n} AS {k}) AS {n}" for n, k in zip(names, kinds)])


def bag(df: DataFrame) -> Counter:
    plain = df.selectExpr(*[
        f"CAST({f.name} AS TIMESTAMP_NTZ) AS {f.name}" if f.dataType.typeName() == "timestamp" else f.name
        for f in df.schema.fields
    ])
    return Counter(tuple(row) for row in plain.collect())


def land_ordered(frames: list[DataFrame], folder: str) -> None:
    """One file per frame; the file source takes them in this order."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    now = time.time() - 10 * len(frames)
    for number, frame in enumerate(frames):
        frame.coalesce(1).write.parquet(f"{folder}-part{number}")
        (written,) = Path(f"{folder}-part{number}").glob("*.parquet")
        target = Path(folder) / f"{number}.parquet"
        target.write_bytes(written.read_bytes())
        os.utime(target, (now + 10 * number, now + 10 * number))


def interval_pairs(left: list[tuple], right: list[tuple], horizon: timedelta, how: str) -> Counter:
    """(key, time) against (key, time) by trying all pairs."""
    out = []
    for key, shown in left:
        found = [
            (key, shown, k, t) for k, t in right
            if key is not None and k == key and shown is not None and t is not None
            and shown <= t <= shown + horizon
        ]
        out += found or ([(key, shown, None, None)] if how == "left" else [])
    return Counter(out)
