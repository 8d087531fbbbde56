"""Batch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def table_schema(spark: SparkSession, path: str, fmt: str = "parquet") -> StructType:
    """The schema of a stored table, to pin on a stream over the same path."""
    return read_table(spark, path, fmt).schema


def select_from_path(spark: SparkSession, path: str, columns: str = "*", fmt: str = "parquet") -> DataFrame:
    """``SELECT columns FROM fmt.`path` ``."""
    return spark.sql(f"SELECT {columns} FROM {fmt}.`{path}`")
