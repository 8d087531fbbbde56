"""Splitting hot keys.

A key with a large share of the rows would land in one task. Its rows are dealt
over several cells on one side and repeated once per cell on the other, which
finds each pair exactly once. All other keys stay in cell 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType

PARTS = 128
_SEED = 17

# Entries of a frequent-items sketch: its error, about 3.5 in 2,048, is far below 1 in PARTS.
_TRACKED = 1024
# Sketches are merged in this many tasks before the last one merges the results.
_LANES = 256


def hot_keys(df: DataFrame, key: str, parts: int = PARTS, within: Column | None = None) -> DataFrame:
    """Keys that hold more than 1/parts of the rows.

    With ``within``, those that do so inside one value of that column, such as a time
    bucket: a micro-batch has one or two buckets, so that share is what a task would get. A key
    that bursts in a single bucket is listed as well. Keys with less than 1/parts**2 of all rows in
    the bucket are no load anywhere and are left out.

    There are at most ``parts`` of them, or ``parts ** 2`` with ``within``, whatever the data. The
    keys are found in one pass by mergeable sketches, so no table of all keys is shuffled. Which
    keys are listed affects the load only; joins are right with any list.
    """
    inside = F.lit(True) if within is None else within
    counted = (
        df.groupBy(inside.alias("inside"), F.pmod(F.spark_partition_id(), F.lit(_LANES)).alias("lane"))
        .agg(F.expr(f"approx_top_k_accumulate({key}, {_TRACKED})").alias("sketch"), F.count("*").alias("n"))
        .groupBy("inside")  # no rows in, no row out: an empty combination cannot be evaluated
        .agg(F.expr(f"approx_top_k_combine(sketch, {_TRACKED})").alias("sketch"), F.sum("n").alias("total"))
    )
    counted = counted.withColumn("all_rows", F.sum("total").over(Window.partitionBy()))
    top = counted.select(F.expr(f"inline(approx_top_k_estimate(sketch, {parts}))"), "total", "all_rows")
    hot = (F.col("count") * parts > F.col("total")) & (F.col("count") * parts * parts > F.col("all_rows"))
    return top.where(hot & F.col("item").isNotNull()).select(F.col("item").alias("hot_key")).distinct()


def pinned_hot_keys(
    df: DataFrame, key: str, path: str, parts: int = PARTS, within: Column | None = None
) -> DataFrame:
    """Hot keys written once, to be read at every start of the same query.

    A streaming join keeps rows in state by cell, so the list must not change
    while its checkpoint lives.
    """
    hot_keys(df, key, parts, within).coalesce(1).write.mode("ignore").parquet(path)
    return df.sparkSession.read.parquet(path)


def _flagged(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    # a key listed twice must not double its rows; adaptive execution broadcasts the list if it is small
    marks = hot.where("hot_key IS NOT NULL").select("hot_key").distinct().withColumn("is_hot", F.lit(True))
    return df.join(marks, F.col(key) == F.col("hot_key"), "left").drop("hot_key")


def _dealt(is_hot: Column, cells: int, row_id: str | None) -> Column:
    """A cell for each row: by a hash of its id, which a repeated task finds again. Without an id by a seeded
    draw, so that exact copies are dealt out as well; that is repeatable as long as the rows of a task come
    in the same order, as they do from files."""
    if row_id is not None:
        deal = F.pmod(F.xxhash64(row_id, F.lit(_SEED)), F.lit(cells)).cast("int")
    else:
        deal = F.floor(F.rand(_SEED) * cells).cast("int")
    return F.when(is_hot, deal).otherwise(F.lit(0))


def _repeated(is_hot: Column, cells: int) -> Column:
    every = F.sequence(F.lit(0), F.lit(cells - 1))
    return F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0))))


def spread(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    hot: DataFrame,
    left_cells: int,
    right_cells: int = 1,
    left_id: str | None = None,
    right_id: str | None = None,
) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides with their cells, and the condition that the cells are equal.

    A left row lives in one of ``left_cells``; right rows are repeated over them.
    With ``right_cells`` above 1 right rows are dealt out too and left rows repeated,
    so hot keys form a grid. That is for inner joins only: a left join needs each
    left row exactly once. ``left_id`` and ``right_id`` name columns that tell the rows apart: needed
    after a shuffle, where a repeated task gets its rows in another order.
    """
    left = _flagged(left, left_key, hot)
    right = _flagged(right, right_key, hot)
    is_hot = F.col("is_hot")
    # rows without a key match nothing, so any cell will do: they must not pile up in one
    left = left.withColumn("left_cell", _dealt(is_hot | F.col(left_key).isNull(), left_cells, left_id))
    right = right.withColumn("right_cell", _repeated(is_hot, left_cells))
    match = F.col("left_cell") == F.col("right_cell")
    if right_cells > 1:
        left = left.withColumn("left_row", _repeated(is_hot, right_cells))
        right = right.withColumn("right_row", _dealt(is_hot, right_cells, right_id))
        match = match & (F.col("left_row") == F.col("right_row"))
    return left.drop("is_hot"), right.drop("is_hot"), match


def parted(df: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of other keys, those without a key among them, and rows of hot keys."""
    marks = hot.where("hot_key IS NOT NULL").select("hot_key").distinct()
    listed = F.col(key) == F.col("hot_key")
    return df.join(marks, listed, "left_anti"), df.join(marks, listed, "left_semi")


def _one_for_all(cells: int):
    """Passes pairs on, and of a left row that was alone in every one of its cells a single row."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, firsts = [], []
        for batch in batches:
            out = batch.select(batch.schema.names[4:])
            alone = batch.column("alone").to_numpy(zero_copy_only=False)
            if not alone.any():
                yield out
                continue
            yield out.filter(pa.array(~alone))
            seen = pd.DataFrame({
                name: batch.column(name).to_numpy(zero_copy_only=False)[alone] for name in ("token", "check", "row")
            })
            tokens.append(seen.drop_duplicates())
            # row 0 of the grid has each left row once, copies included: it speaks for the others
            first = alone & (batch.column("row").to_numpy(zero_copy_only=False) == 0)
            if first.any():
                firsts.append((seen[seen["row"] == 0], out.filter(pa.array(first))))
        if not firsts:
            return
        n_cells = pd.concat(tokens).drop_duplicates().groupby(["token", "check"]).size()
        everywhere = n_cells.index[n_cells == cells]
        for seen, rows in firsts:
            kept = pd.MultiIndex.from_frame(seen[["token", "check"]]).isin(everywhere)
            if kept.any():
                yield rows.filter(pa.array(np.asarray(kept)))

    return step


def left_over_grid(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    on: Column,
    hot: DataFrame,
    cells: int,
    left_id: str | None = None,
    right_id: str | None = None,
) -> DataFrame:
    """Left join of rows of hot keys with both sides split: (all left columns, all right columns).

    The left rows are repeated over a row of the grid and the right rows dealt out, so each cell makes its own left join
    and a left row may be alone in some cells and not in others. The joined rows are dealt once more: copies of a lone
    left row meet in one task, which lets one of them pass if it was alone in every cell; pairs pass at once and
    are spread. On streams nothing is kept between micro-batches: copies of a left row have one time, come in one
    micro-batch and leave the state of all cells with the same watermark.

    A task keeps 17 bytes per copy of the lone rows of hot keys in it, and of each one full row. Rows are told
    apart by two hashes of the left columns, which therefore cannot be maps.
    """
    names = left.columns + right.columns
    missing = [StructField(f.name, f.dataType, True, f.metadata) for f in right.schema.fields]
    schema = StructType([*left.schema.fields, *missing])
    spread_left, spread_right, same_cell = spread(
        left, right.withColumn("found", F.lit(True)), left_key, right_key, hot, cells, cells, left_id, right_id
    )
    joined = spread_left.join(spread_right, on & same_cell, "left").select(
        F.xxhash64(*left.columns, "left_cell").alias("token"),
        F.xxhash64(F.lit(_SEED), "left_cell", *left.columns).alias("check"),
        F.col("left_row").cast("byte").alias("row"),
        F.col("found").isNull().alias("alone"),
        *names,
    )
    lane = F.when(F.col("alone"), F.col("token")).otherwise(F.xxhash64(F.spark_partition_id(), *right.columns, "token"))
    return joined.repartition(lane).mapInArrow(_one_for_all(cells), schema)
