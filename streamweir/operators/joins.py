"""Impression-to-click joins.

Both sides must have distinct column names: rename before joining.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from streamweir.functions.timing import bucket_and_previous, interval_sql, time_bucket
from streamweir.operators.skew import left_over_grid, parted, spread

CELLS = 8


def _check_names(left: DataFrame, right: DataFrame) -> list[str]:
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"rename before joining, both sides have {sorted(shared)}")
    return left.columns + right.columns


def equi_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    hot: DataFrame | None = None,
    cells: int = CELLS,
    left_id: str | None = None,
    right_id: str | None = None,
) -> DataFrame:
    """Inner or left join on the key.

    As a batch join it relies on adaptive execution to split skewed partitions.
    Two streams have no such help and keep *all* rows in state, for ever: pass the hot
    keys to spread them, and watch the state rows in the run report.
    """
    columns = _check_names(left, right)
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    on = F.col(left_key) == F.col(right_key)
    if hot is not None:
        right_cells = cells if how == "inner" else 1
        left, right, same_cell = spread(left, right, left_key, right_key, hot, cells, right_cells, left_id, right_id)
        on = on & same_cell
    return left.join(right, on, how).select(*columns)


def join_count(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Number of rows of the inner join, without making them.

    Each side is counted per key first, so a hot key is one row per side.
    """
    a = left.groupBy(F.col(left_key).alias("a_key")).agg(F.count("*").alias("n_left"))
    b = right.groupBy(F.col(right_key).alias("b_key")).agg(F.count("*").alias("n_right"))
    # a product of two counts may be beyond LONG where the sum of a real join would not be asked for
    pairs = F.sum(F.col("n_left").cast("decimal(19,0)") * F.col("n_right").cast("decimal(19,0)"))
    return a.join(b, F.col("a_key") == F.col("b_key")).agg(
        F.coalesce(pairs, F.lit(0)).cast("long").alias("n_rows")
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    horizon: timedelta,
    how: str = "inner",
    left_delay: str | None = None,
    right_delay: str | None = None,
    hot: DataFrame | None = None,
    cells: int = CELLS,
    left_id: str | None = None,
    right_id: str | None = None,
    hot_right: DataFrame | None = None,
) -> DataFrame:
    """Pairs of equal key with right_time in left_time .. left_time + horizon.

    The time is cut into buckets as long as the horizon. A left row is in its own
    bucket, a right row also in the one before, so every pair meets once. The bucket
    is part of the join key: one key's rows spread over the tasks by time, and a row
    is compared with its neighbours in time instead of the whole history of its key.
    Keys that are hot within one horizon can be split further through ``hot``. A left join then
    splits the left side, and repeats the right one. For keys that are hot on the right, ``hot_right``
    splits both sides of a left join: their rows take a join of their own, see :func:`left_over_grid`.

    On streams both delays are needed; they bound the state. In a left join a row
    without a match comes out when the watermark has passed its horizon.
    """
    columns = _check_names(left, right)
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    if left.isStreaming and right.isStreaming and not (left_delay and right_delay):
        raise ValueError("two streams need a watermark delay each, or their state has no bound")
    if left_delay:
        left = left.withWatermark(left_time, left_delay)
    if right_delay:
        right = right.withWatermark(right_time, right_delay)

    left = left.withColumn("left_bucket", time_bucket(F.col(left_time), horizon))
    buckets = bucket_and_previous(time_bucket(F.col(right_time), horizon))
    right = right.withColumn("right_bucket", F.explode(buckets))
    on = (
        (F.col(left_key) == F.col(right_key))
        & (F.col("left_bucket") == F.col("right_bucket"))
        & (F.col(right_time) >= F.col(left_time))
        & (F.col(right_time) <= F.col(left_time) + F.expr(interval_sql(horizon)))
    )
    gridded = None
    if hot_right is not None and how == "left":
        left, hot_left_rows = parted(left, left_key, hot_right)
        right, hot_right_rows = parted(right, right_key, hot_right)
        gridded = left_over_grid(
            hot_left_rows, hot_right_rows, left_key, right_key, on, hot_right, cells, left_id, right_id
        ).select(*columns)
    if hot is not None:
        # an inner join may split both sides of a hot key; a left join must keep each left row single
        right_cells = cells if how == "inner" else 1
        left, right, same_cell = spread(left, right, left_key, right_key, hot, cells, right_cells, left_id, right_id)
        on = on & same_cell
    joined = left.join(right, on, how).select(*columns)
    return joined if gridded is None else joined.union(gridded)


def matched_only(joined: DataFrame, right_time: str) -> DataFrame:
    """Rows of a left join that found a partner."""
    return joined.where(F.col(right_time).isNotNull())
