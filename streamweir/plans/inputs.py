"""The driver's tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from streamweir.sources import generate
from streamweir.sources.streams import read_stream
from streamweir.sources.tables import read_table, table_schema


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_instant(raw_events(spark, sf_dir))


def event_stream(spark: SparkSession, sf_dir: str, limits: bool = True) -> DataFrame:
    """``limits=False`` for queries with a watermark: the stored files are in no order of time."""
    return _with_instant(raw_event_stream(spark, sf_dir, limits))


def raw_event_stream(spark: SparkSession, sf_dir: str, limits: bool = True) -> DataFrame:
    # the pattern makes a single file and a folder of that name equally streamable
    schema = table_schema(spark, f"{sf_dir}/events.parquet")
    return read_stream(spark, f"{sf_dir}/{{events.parquet}}", schema, limits=limits)


def _with_instant(df: DataFrame) -> DataFrame:
    # watermarks need a TIMESTAMP; the files have zone-less ones, taken as UTC
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def impressions(df: DataFrame) -> DataFrame:
    return df.where("event_type = 'view'").selectExpr("user_id AS adId", "ts AS impressionTime")


def clicks(df: DataFrame, key: str = "clickAdId") -> DataFrame:
    return df.where("event_type = 'click'").selectExpr(f"user_id AS {key}", "ts AS clickTime")


def _ticks(df: DataFrame) -> DataFrame:
    return df.selectExpr("ts AS timestamp", "event_id AS value")


def shown_ads(df: DataFrame) -> DataFrame:
    """An impression per event: ads are shown once, so a key has one row."""
    return generate.impressions(_ticks(df))


def clicked_ads(df: DataFrame, seed: int) -> DataFrame:
    """Clicks on a tenth of the ads, some of them shown before the table begins."""
    return generate.clicks(_ticks(df), seed).withColumnRenamed("adId", "clickAdId")


def cdc(df: DataFrame) -> DataFrame:
    """Every event as a change row; money in cents, so that sums are exact."""
    insert = F.col("event_type").isin("signup", "purchase")
    return df.select(
        F.round(F.col("value") * 100).cast("long").alias("amount"),
        F.col("user_id").alias("id"),
        F.concat(F.lit("Test"), F.col("event_id").cast("string")).alias("name"),
        F.when(insert, "I").otherwise("U").alias("op"),
        F.lit("Table1").alias("table"),
        F.col("ts"),
        F.col("props").alias("value"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/events.parquet")


def landed_event_stream(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Events from a landing folder, as :func:`event_stream` gives them."""
    return _with_instant(read_stream(spark, path, like.schema, limits=False))


def time_slices(df: DataFrame, n: int) -> list[DataFrame]:
    """The rows in n parts of equal time span, oldest first; rows without a time are in the first.

    Each part is a plain range filter on ``ts``, which reaches the scan.
    """
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = df.agg(F.min(at), F.max(at)).first()
    if first is None:
        return [df] + [df.where("false")] * (n - 1)
    span = last - first + 1
    edges = [first + -(-k * span // n) for k in range(n + 1)]
    kind = df.schema["ts"].dataType.typeName()
    bounds = [F.timestamp_micros(F.lit(edge)).cast(kind) for edge in edges]
    inside = [(F.col("ts") >= low) & (F.col("ts") < high) for low, high in zip(bounds, bounds[1:])]
    inside[0] = inside[0] | F.col("ts").isNull()
    return [df.where(part) for part in inside]


def without_zone(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns as zone-less ones, the type of the input files."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in df.schema.fields
    ])
