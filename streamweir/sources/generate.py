"""Workload generators: rows are made where they are written, never on the driver.

Each takes a frame with a row number, ``spark.range(n)`` or any table, so the
partitioning of that frame is the parallelism of the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from streamweir.functions.draws import draw_choice, draw_int, draw_time, draw_word

# Fixed values of the generated domain.
OPERATIONS = ["I", "U"]
MAX_ID = 100_000_000
MAX_AMOUNT = 10_000
WORD_LENGTHS = {"attribute1": 20, "attribute2": 40, "attribute3": 10}
CLICK_PERCENT = 10
CLICK_LAG = 100


def _common(row: Column, table: str, seed: int, ts: Column | None) -> list[Column]:
    return [
        F.lit(table).alias("table"),
        draw_choice(row, seed, "op", OPERATIONS).alias("op"),
        (F.current_timestamp() if ts is None else ts).alias("ts"),
        draw_int(row, seed, "id", 1, MAX_ID).alias("id"),
    ]


def random_time(row: Column, seed: int, first_year: int = 2018, last_year: int = 2024) -> Column:
    return draw_time(row, seed, "ts", first_year, last_year)


def cdc_rows(
    rows: DataFrame, row_no: str = "id", table: str = "Table1", seed: int = 1,
    ts: Column | None = None, amounts: bool = True,
) -> DataFrame:
    """Narrow change rows: name and value follow the row number.

    ``ts`` is the time of generation unless one is given.
    """
    row = F.col(row_no)
    text = row.cast("string")
    extra = [
        F.concat(F.lit("Test"), text).alias("name"),
        F.concat(F.lit("Value"), text).alias("value"),
    ]
    if amounts:
        extra.append(draw_int(row, seed, "amount", 1, MAX_AMOUNT).alias("amount"))
    return rows.select(*_common(row, table, seed, ts), *extra)


def cdc_wide_rows(
    rows: DataFrame, table: str, row_no: str = "id", seed: int = 1, ts: Column | None = None
) -> DataFrame:
    """Wide change rows: three random words in place of name, value and amount."""
    row = F.col(row_no)
    words = [draw_word(row, seed, name, n).alias(name) for name, n in WORD_LENGTHS.items()]
    return rows.select(*_common(row, table, seed, ts), *words)


def cdc_table(rows: DataFrame, table: str, row_no: str = "id", seed: int = 1,
              ts: Column | None = None) -> DataFrame:
    """The column set goes with the table name: Table1 is narrow, all others are wide."""
    if table == "Table1":
        return cdc_rows(rows, row_no, table, seed, ts)
    return cdc_wide_rows(rows, table, row_no, seed, ts)


def impressions(ticks: DataFrame) -> DataFrame:
    """One impression per tick (timestamp, value)."""
    return ticks.selectExpr("value AS adId", "timestamp AS impressionTime")


def clicks(ticks: DataFrame, seed: int = 1, percent: int = CLICK_PERCENT, lag: int = CLICK_LAG) -> DataFrame:
    """A click for ``percent`` of the ticks, on the ad shown ``lag`` ticks earlier.

    The sample is drawn from the tick number, so a replay picks the same ticks.
    """
    chosen = draw_int(F.col("value"), seed, "click", 0, 99) < percent
    return (
        ticks.where(chosen)
        .select((F.col("value") - lag).alias("adId"), F.col("timestamp").alias("clickTime"))
        .where("adId > 0")
    )
