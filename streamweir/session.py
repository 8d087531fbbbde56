"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Read by Spark when a query starts.
STREAM_SETTINGS = {
    # one time zone for windows, JSON timestamps and zone-less columns
    "spark.sql.session.timeZone": "UTC",
    # INT96 carries no row-group statistics, so time filters could not be pushed down
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # state larger than executor memory: RocksDB, uploading changes and not snapshots
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a stream-stream join keeps one store per partition in place of four
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # the batch joins of foreachBatch and of the registered queries
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in STREAM_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder that every executor sees, as the cluster names it.

    Only a local session may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="streamweir-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run: nothing is reused, nothing needs clearing."""
    return f"{shared_root(spark)}/streamweir/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path on the file system that Spark takes it to be on, as a URI that Arrow reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    uri = system.makeQualified(place).toString()
    if uri.startswith("file:"):
        return "file://" + uri.removeprefix("file:").removeprefix("//")
    return uri.replace("s3a://", "s3://", 1)


def local_session(cpus: int | str = 8) -> SparkSession:
    """One JVM with so many cores, for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("streamweir")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    return tune(spark)
