"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from streamweir.schemas import ENVELOPE
from streamweir.sources.tables import table_schema


def read_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    fmt: str = "parquet",
    max_files: int | None = None,
    max_bytes: int | None = None,
    limits: bool = True,
    **options: str,
) -> DataFrame:
    """A growing folder as a stream, oldest file first.

    The schema is fixed when the query starts: the given one, or that of a batch
    read of the path. ``max_files`` and ``max_bytes`` bound one micro-batch; without
    an argument the session settings ``spark.streamweir.maxFilesPerTrigger`` and
    ``spark.streamweir.maxBytesPerTrigger`` do, so a cluster can size every stream
    in one place. A query with a watermark needs its files in time order to be cut
    like that; ``limits=False`` leaves the settings aside where nothing warrants it.
    """
    if limits:
        max_files = max_files or spark.conf.get("spark.streamweir.maxFilesPerTrigger", None)
        max_bytes = max_bytes or spark.conf.get("spark.streamweir.maxBytesPerTrigger", None)
    reader = spark.readStream.format(fmt).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    elif max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.schema(schema or table_schema(spark, path, fmt)).load(path)


def read_messages(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    max_files: int | None = None,
    limits: bool = True,
    **options: str,
) -> DataFrame:
    """Message envelopes from their earliest position.

    With a path: a folder of message files, ``limits`` as for :func:`read_stream`. Without: a connector found by its
    format name, all of whose settings are passed through ``options``.
    """
    if path is not None:
        return read_stream(spark, path, ENVELOPE, fmt, max_files, limits=limits, **options)
    stream = spark.readStream.format(fmt).options(**options).load()
    return stream.select("data", "approximateArrivalTimestamp")


def rate(
    spark: SparkSession,
    rows_per_second: int,
    ramp_up: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Wall-clock rows (timestamp, value)."""
    reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if ramp_up:
        reader = reader.option("rampUpTime", ramp_up)
    if partitions:
        reader = reader.option("numPartitions", partitions)
    return reader.load()


def rate_per_batch(
    spark: SparkSession,
    rows_per_batch: int,
    start_ms: int = 0,
    advance_ms: int = 1000,
    partitions: int | None = None,
) -> DataFrame:
    """Rows (timestamp, value) that depend on the batch number only, not on the clock."""
    reader = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("startTimestamp", start_ms)
        .option("advanceMillisPerBatch", advance_ms)
    )
    if partitions:
        reader = reader.option("numPartitions", partitions)
    return reader.load()
