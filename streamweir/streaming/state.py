"""What a streaming query keeps: its state as tables, read from the checkpoint without running it.

State grows without end where nothing takes rows out of it. These tables tell which
operator does, on which keys, and how evenly its partitions are filled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per stateful operator and store: ``operator, name, store, partitions, first_batch, last_batch``."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        F.col("operatorId").alias("operator"), F.col("operatorName").alias("name"), F.col("stateStoreName").alias("store"),
        F.col("numPartitions").alias("partitions"), F.col("minBatchId").alias("first_batch"), F.col("maxBatchId").alias("last_batch"),
    )


def read_state(
    spark: SparkSession, checkpoint: str, operator: int = 0, store: str | None = None, batch: int | None = None, **options: str
) -> DataFrame:
    """The state as of a batch (default: the last committed) as structs ``key`` and ``value`` and the ``partition_id``.

    ``options`` go to the reader: ``joinSide`` gives one side of a join as rows, ``stateVarName`` a variable of a keyed state.
    """
    reader = spark.read.format("statestore").option("operatorId", operator).options(**options)
    if store is not None:
        reader = reader.option("storeName", store)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)


def state_sizes(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """``operator, store, partition, rows`` of every partition that holds rows; a join's stores are its sides, ``left`` and ``right``.

    Only counts are moved. A keyed state of variables (``transformWithState``) is read by variable and left out here.
    """
    parts = set()
    for r in state_operators(spark, checkpoint).collect():
        if r["name"] == "symmetricHashJoin":
            parts |= {(r["operator"], "left", "joinSide"), (r["operator"], "right", "joinSide")}
        elif not r["name"].startswith("transformWithState"):
            parts.add((r["operator"], r["store"], "storeName"))
    counted = [
        read_state(spark, checkpoint, operator, batch=batch, **{option: store})
        .groupBy(F.col("partition_id").alias("partition")).agg(F.count("*").alias("rows"))
        .select(F.lit(operator).cast("long").alias("operator"), F.lit(store).alias("store"), "partition", "rows")
        for operator, store, option in sorted(parts)
    ]
    none = spark.createDataFrame([], "operator LONG, store STRING, partition INT, rows LONG")
    return reduce(DataFrame.union, counted, none)
