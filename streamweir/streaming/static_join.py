"""A stream of impressions against a stored table of clicks."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from streamweir.functions.timing import micros
from streamweir.operators.joins import interval_join
from streamweir.sources.tables import read_table
from streamweir.streaming.sinks import commit, ensure_table


class RefreshedStaticJoin:
    """``foreachBatch`` step that reads the table anew for every micro-batch.

    A plain stream-static join keeps the table's file list from when the query was
    planned. This one sees files added since, and reads only the time range that the
    batch can match: the range is pushed down to the scan.
    """

    def __init__(
        self, table_path: str, out_path: str, columns: list[str], left_key: str, right_key: str,
        left_time: str, right_time: str, horizon: timedelta, fmt: str = "parquet",
    ):
        self.table_path = table_path
        self.out_path = out_path
        self.columns = columns
        self.left_key = left_key
        self.right_key = right_key
        self.left_time = left_time
        self.right_time = right_time
        self.horizon = horizon
        self.fmt = fmt

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        at = F.unix_micros(self.left_time)
        first, last = batch.agg(F.min(at), F.max(at) + micros(self.horizon)).first()
        if first is None:
            return  # no batch without rows is looked for by readers
        table = read_table(batch.sparkSession, self.table_path, self.fmt).select(*self.columns)
        first_time, last_time = F.timestamp_micros(F.lit(first)), F.timestamp_micros(F.lit(last))
        table = table.where(F.col(self.right_time).between(first_time, last_time))
        joined = interval_join(
            batch, table, self.left_key, self.right_key, self.left_time, self.right_time, self.horizon
        )
        joined.write.mode("overwrite").parquet(f"{self.out_path}/data/batch_id={batch_id}")
        commit(batch.sparkSession, self.out_path, batch_id)

    def result(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """What the committed batches have written; ``schema`` is that of the joined rows."""
        ensure_table(spark, f"{self.out_path}/commits", "batch LONG")
        batches = read_table(spark, f"{self.out_path}/commits").select(F.col("batch").alias("batch_id")).distinct()
        ensure_table(spark, f"{self.out_path}/data", schema)
        rows = spark.read.schema(StructType(list(schema.fields)).add("batch_id", "long")).parquet(f"{self.out_path}/data")
        return rows.join(batches, "batch_id", "left_semi").drop("batch_id")
