"""Every registered query against its SQL at the smallest scale."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from streamweir.plans.queries import REGISTERED, _paced
from streamweir.sources.tables import read_table
from streamweir.streaming.sinks import append_table
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(REGISTERED))
def test_query_equals_its_sql(spark, con, name):
    assert differences(queries()[name](spark, SF), oracle_sql()[name], con) == []


def test_every_query_has_sql():
    assert set(REGISTERED) <= set(oracle_sql())


def test_known_row_counts(spark):
    expected = {
        "agg_tumbling": 844, "agg_sliding_update": 1682, "agg_sliding_append": 1680,
        "join_interval_inner": 25, "join_interval_left": 187, "incremental_left": 1000,
    }
    assert {name: queries()[name](spark, SF).count() for name in expected} == expected
    assert queries()["agg_global_complete"](spark, SF).first()[0] == 5_005_019


def test_flagship(spark):
    assert entry(spark).count() == 844


def test_tables_stored_as_folders_of_files(spark, folder):
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(f"{folder}/events.parquet")
    assert queries()["stream_scan"](spark, folder).count() == 1000
    assert queries()["join_interval_left"](spark, folder).count() == 187


@pytest.mark.parametrize("name", ["agg_tumbling", "agg_sliding_append", "join_interval_inner", "join_interval_left"])
def test_a_backlog_in_slices_gives_the_same(spark, con, name):
    spark.conf.set("spark.streamweir.backlogSlices", "3")
    try:
        assert differences(queries()[name](spark, SF), oracle_sql()[name], con) == []
    finally:
        spark.conf.unset("spark.streamweir.backlogSlices")


def plain_tables(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}/*.parquet'")
    return con


def tables(spark, folder, change):
    for name in ("events", "orders", "lineitem", "conversations"):
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        (change(df) if name == "events" else df.limit(0) if change is none else df).write.parquet(f"{folder}/{name}.parquet")
    return folder


def none(df):
    return df.limit(0)


def some_without_a_time(df):
    return df.withColumn("ts", F.when(F.col("event_id") % 10 != 3, F.col("ts")))


@pytest.mark.parametrize("name", ["incremental_left", "reconcile", "join_batch_left", "join_batch_inner", "matched_only", "join_stream_unbounded", "join_interval_inner", "join_static_refreshed", "rate_micro_batch", "stream_scan", "union_streams", "gen_ads"])
def test_rows_without_a_time(spark, folder, name):
    path = tables(spark, folder, some_without_a_time)
    assert differences(queries()[name](spark, path), oracle_sql()[name], plain_tables(path)) == []


@pytest.mark.parametrize("name", list(REGISTERED))
def test_no_rows(spark, folder, name):
    path = tables(spark, folder, none)
    rows = queries()[name](spark, path).count()
    assert rows == {"scan_count": 3, "join_batch_count": 1, "reconcile": 1, "sink_batches": 1, "bronze_latency": 1, "agg_global_complete": 1}.get(name, 0)


WATERMARKED = [n for n in REGISTERED if n.startswith(("agg_tumbling", "agg_sliding", "join_interval", "stateful", "late", "dataset"))]


@pytest.mark.parametrize("name", WATERMARKED)
def test_rate_limits_do_not_lose_rows_to_a_watermark(spark, folder, name):
    """Files out of time order, one per batch if the setting were followed."""
    path = tables(spark, folder, lambda df: df.orderBy(F.desc("ts")))
    spark.conf.set("spark.streamweir.maxFilesPerTrigger", "1")
    try:
        assert differences(queries()[name](spark, path), oracle_sql()[name], plain_tables(path)) == []
    finally:
        spark.conf.unset("spark.streamweir.maxFilesPerTrigger")


def test_a_paced_batch_reads_its_own_folder(spark, folder):
    """Files of other batches are no Parquet, and nothing looks into them."""
    rows = spark.range(40).selectExpr("id AS event_id", "id AS user_id", "'x' AS event_type", "id AS number", "CAST(id DIV 10 AS INT) AS batch")
    append_table(rows, f"{folder}/stored", by=["batch"])
    stored = read_table(spark, f"{folder}/stored")
    for other in (0, 1, 3):
        for file in Path(f"{folder}/stored/batch={other}").glob("*.parquet"):
            file.write_bytes(b"no table")
    ticks = spark.range(40).selectExpr("id AS value", "timestamp_millis(id) AS timestamp")
    assert sorted(r.event_id for r in _paced(ticks, stored, 2).collect()) == list(range(20, 30))
    with pytest.raises(Exception):
        _paced(ticks, stored, 3).collect()
