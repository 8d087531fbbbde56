"""Tables as sinks: append, replace, change log.

A batch that is replayed after a failure overwrites its own output, and readers
only look at batches whose commit row is written, last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def ensure_table(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet") -> None:
    """An empty table of this schema, unless there is one already."""
    spark.createDataFrame([], schema).write.format(fmt).mode("ignore").save(path)


def append_table(
    df: DataFrame, path: str, partitions: int | None = None, by: list[str] | None = None,
    fmt: str = "parquet",
) -> None:
    """Batch append with a set number of writers, optionally laid out by columns."""
    if partitions:
        df = df.repartition(partitions)
    out = df.write.format(fmt).mode("append")
    if by:
        out = out.partitionBy(*by)
    out.save(path)


def commit(spark: SparkSession, path: str, batch_id: int, **columns) -> None:
    row = spark.range(1).select(
        F.lit(batch_id).cast("long").alias("batch"),
        *[F.lit(v).alias(k) for k, v in columns.items()],
    )
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/batch_id={batch_id}")


class ReplaceSink:
    """Complete mode on plain files: each batch writes the whole result into the next slot.

    The slots are used in turn, so the space is that of ``slots`` results however long
    the query runs, and a reader of the newest one is not disturbed by the next batch.
    """

    def __init__(self, path: str, slots: int = 2):
        self.path = path
        self.slots = slots

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        slot = batch_id % self.slots
        batch.write.mode("overwrite").parquet(f"{self.path}/slot={slot}")
        commit(batch.sparkSession, self.path, batch_id, slot=slot)


def read_replaced(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed result of a :class:`ReplaceSink`."""
    newest = spark.read.parquet(f"{path}/commits").agg(F.max_by("slot", "batch")).first()[0]
    return spark.read.parquet(f"{path}/slot={newest}")


class ChangeLogSink:
    """Update mode on plain files: each batch adds the groups it changed."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/changes/batch_id={batch_id}")
        commit(batch.sparkSession, self.path, batch_id)


def read_change_log(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Per group the row of its last change."""
    last = spark.read.parquet(f"{path}/commits").agg(F.max("batch")).first()[0]
    log = spark.read.parquet(f"{path}/changes").where(F.col("batch_id") <= last)
    values = [c for c in log.columns if c not in keys and c != "batch_id"]
    newest = F.max_by(F.struct(*values), "batch_id").alias("newest")
    return log.groupBy(*keys).agg(newest).select(*keys, "newest.*")
