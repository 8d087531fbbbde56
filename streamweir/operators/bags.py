"""Bag union, bag difference and reconciliation: rows count as often as they occur."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def bag_union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of left that right has fewer of, as often as they are missing there."""
    return left.exceptAll(right.select(*left.columns))


def tally(truth: DataFrame, result: DataFrame) -> DataFrame:
    """Each distinct row with how often either side has it: ``n_truth`` and ``n_result``.

    One pass over both sides. Copies are counted inside each task before the shuffle.
    """
    columns = truth.columns
    both = truth.withColumn("in_truth", F.lit(1)).unionByName(
        result.select(*columns).withColumn("in_truth", F.lit(0))
    )
    return both.groupBy(*columns).agg(
        F.sum("in_truth").alias("n_truth"), F.sum(1 - F.col("in_truth")).alias("n_result")
    )


def gaps(tallied: DataFrame) -> DataFrame:
    """Adds both bag differences per row: ``n_missing`` in the result, ``n_surplus`` in it."""
    surplus = F.col("n_result") - F.col("n_truth")
    return tallied.withColumn("n_missing", F.greatest(-surplus, F.lit(0))).withColumn(
        "n_surplus", F.greatest(surplus, F.lit(0))
    )


def reconcile(truth: DataFrame, result: DataFrame) -> DataFrame:
    """Rows that one side has more often; empty exactly when the two bags are equal."""
    return gaps(tally(truth, result)).where("n_missing > 0 OR n_surplus > 0").drop("n_truth", "n_result")


BUCKETS = 4096
_SEED = 29


def _hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two hashes of a row. A null leaves a hash as it was, so each column goes in with whether it is one."""
    parts = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(*parts), F.xxhash64(F.lit(_SEED), *parts)


def bucket_sums(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows of a bag in buckets by hash: (bucket, n, first_sum, second_sum), the same in any order of the rows.

    One pass without a shuffle of rows: a task sends at most one row per bucket, and copies add up like other rows.
    """
    first, second = _hashes(df.columns)
    wide = "decimal(20,0)"  # 64 bits; the sum has ten digits more
    return df.groupBy(F.pmod(first, F.lit(buckets)).alias("bucket")).agg(
        F.count("*").alias("n"), F.sum(first.cast(wide)).alias("first_sum"), F.sum(second.cast(wide)).alias("second_sum")
    )


def differing_buckets(truth: DataFrame, result: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Buckets whose rows differ: evaluates both sides, each once, and brings at most ``buckets`` numbers here."""
    a = bucket_sums(truth, buckets)
    b = bucket_sums(result.select(*truth.columns), buckets)
    one_sided = a.exceptAll(b).union(b.exceptAll(a))
    return [row.bucket for row in one_sided.select("bucket").distinct().collect()]


def reconcile_hashed(truth: DataFrame, result: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """What :func:`reconcile` gives, for tables that are mostly equal: only buckets that differ are compared row by row.

    Equal tables cost one aggregate each and no shuffle of rows. Otherwise the rows of differing buckets are read in a
    second pass, so both sides have to be stored tables or give the same rows again. A difference is
    overlooked only if both 64-bit sums of a bucket agree by chance. Columns must be hashable: no maps.
    """
    differing = differing_buckets(truth, result, buckets)
    result = result.select(*truth.columns)
    inside = F.pmod(_hashes(truth.columns)[0], F.lit(buckets))
    listed = truth.sparkSession.createDataFrame([(n,) for n in differing], "differing LONG")

    def kept(df: DataFrame) -> DataFrame:
        if not differing:
            return df.where("false")
        return df.join(F.broadcast(listed), inside == F.col("differing"), "left_semi")  # at most ``buckets`` numbers

    return reconcile(kept(truth), kept(result))
