"""Sums over streams and tables.

Spark sums inside each task before it shuffles, so a key that holds a third of
all rows costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def bucketed(key: Column | str, buckets: int, keep_sign: bool = True) -> Column:
    """``key % buckets``, negative for negative keys unless ``keep_sign`` is off."""
    key = F.col(key) if isinstance(key, str) else key
    return key % buckets if keep_sign else F.pmod(key, F.lit(buckets))


def running_sum(df: DataFrame, amount: str) -> DataFrame:
    """One sum over everything seen so far (complete or update mode)."""
    return df.agg(F.sum(amount).alias("sum"))


def keyed_sum(df: DataFrame, key: str, amount: str) -> DataFrame:
    """A sum per key. On a stream without a watermark the state grows with the keys, for ever."""
    return df.groupBy(key).agg(F.sum(amount).alias("sum"))


def windowed_sum(
    df: DataFrame,
    time: str,
    delay: str,
    width: str,
    group: Column,
    amount: str,
    slide: str | None = None,
) -> DataFrame:
    """A sum per event-time window and group; ``slide`` makes the windows overlap.

    In append mode a window comes out once the watermark has passed its end; rows
    whose window is already out are dropped and counted in the run report.
    """
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        df.withWatermark(time, delay)
        .groupBy(window, group.alias("group"))
        .agg(F.sum(amount).alias("sum"))
    )


def flat_window(df: DataFrame) -> DataFrame:
    """``window`` as two columns in place of a struct."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )
