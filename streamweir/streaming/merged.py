"""Update mode as a table that stays quick to read: changes in runs that are merged as they grow in number.

Every batch writes its changed groups as a run of level 0. When ``fanout`` runs of a level are complete, they are merged
into one of the next, in the batch that completes them, and before that batch is committed. Which runs
make up the table follows from the number of the last committed batch alone, so a batch that is replayed
writes the same runs again, and a reader opens fewer than ``fanout`` runs per level, however many batches there were. A change
is written once per level: with eight runs to a merge, four times in the first four thousand batches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

FANOUT = 8
CHANGED = "changed_in_batch"


def runs_after(batches: int, fanout: int = FANOUT) -> list[tuple[int, int]]:
    """(level, number) of the runs that hold the first so many batches, oldest first; run n of a level
    has the batches from n * fanout ** level on."""
    runs, level = [], 0
    while batches:
        batches, rest = divmod(batches, fanout)
        runs = [(level, batches * fanout + n) for n in range(rest)] + runs
        level += 1
    return runs


def merges_in(batch_id: int, fanout: int = FANOUT) -> list[tuple[int, int]]:
    """(level, number) of the runs that a batch completes by merging, lowest first."""
    merges, level, done = [], 1, batch_id + 1
    while done % fanout == 0:
        done //= fanout
        merges.append((level, done - 1))
        level += 1
    return merges


class MergedSink:
    """``foreachBatch`` step of an update-mode query. ``keys`` tell the groups apart; a batch has each once."""

    def __init__(self, path: str, keys: list[str], fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("fanout is at least 2")
        self.path = path
        self.keys = keys
        self.fanout = fanout

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if CHANGED in batch.columns:
            raise ValueError(f"rename {CHANGED}: the sink has a column of that name")
        spark = batch.sparkSession
        changes = batch.withColumn(CHANGED, F.lit(batch_id).cast("long"))
        changes.write.mode("overwrite").parquet(_run(self.path, 0, batch_id))
        for level, number in merges_in(batch_id, self.fanout):
            parts = [(level - 1, number * self.fanout + n) for n in range(self.fanout)]
            merged = _newest(spark, self.path, parts, self.keys)
            merged.write.mode("overwrite").parquet(_run(self.path, level, number))
        # two commit rows in turn: while one is replaced, the other is the last committed batch
        done = spark.range(1).select(F.lit(batch_id).cast("long").alias("batch"), F.lit(self.fanout).alias("fanout"))
        done.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/slot={batch_id % 2}")


def _run(path: str, level: int, number: int) -> str:
    return f"{path}/runs/level={level}/run={number}"


def _newest(spark: SparkSession, path: str, runs: list[tuple[int, int]], keys: list[str]) -> DataFrame:
    """The last change of every group. A group is in a run once, so a single run is taken as it is."""
    parts = [spark.read.parquet(_run(path, *run)) for run in runs]
    if len(parts) == 1:
        return parts[0]
    rows = reduce(DataFrame.unionByName, parts)
    values = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*values), CHANGED).alias("newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def read_merged(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Per group the row of its last committed change."""
    last = spark.read.parquet(f"{path}/commits").select("batch", "fanout").orderBy(F.desc("batch")).first()
    return _newest(spark, path, runs_after(last.batch + 1, last.fanout), keys).drop(CHANGED)
