from pyspark.sql import functions as F

from streamweir.operators import aggregate
from streamweir.plans import inputs
from streamweir.plans.queries import windowed
from streamweir.sources.streams import read_stream
from streamweir.streaming.run import memory_table, run_stream, start_stream, drain
from streamweir.streaming.sinks import (
    ChangeLogSink, ReplaceSink, ensure_table, read_change_log, read_replaced,
)
from tests.helpers import at, bag, instants, land_ordered

SF = "/root/testdata/sf0.001"
ROWS = "ts TIMESTAMP, id LONG, amount LONG"


def live_sums(stream, slide=None):
    return aggregate.windowed_sum(
        stream, "ts", "20 seconds", "10 seconds", aggregate.bucketed("id", 2000), "amount", slide
    )


def test_late_row_is_dropped_and_counted(spark, folder):
    """12:00:00, 13:00:00, 10:00:00, 13:00:01, one row per batch."""
    frames = [instants(spark, [(at(s), 1, 1)], ROWS) for s in (0, 3600, -7200, 3601)]
    land_ordered(frames, f"{folder}/landing")
    stream = read_stream(spark, f"{folder}/landing", max_files=1)
    report = run_stream(live_sums(stream), mode="update", fmt="memory", name="late_rows")
    rows = memory_table(spark, "late_rows")
    assert report.late_rows == 1 and report.input_rows == 4
    assert rows.count() == 3
    assert [r["sum"] for r in rows.where(F.col("window.start") == F.lit(at(3600)).cast("timestamp_ntz").cast("timestamp")).orderBy("sum").collect()] == [1, 2]


def test_buckets_keep_the_sign(spark):
    row = spark.sql("SELECT -3L AS id").select(
        aggregate.bucketed("id", 4), aggregate.bucketed("id", 4, keep_sign=False)
    ).first()
    assert tuple(row) == (-3, 1)


def ordered_cdc(spark, folder):
    land_ordered(inputs.time_slices(inputs.events(spark, SF), 4), f"{folder}/landing")
    return inputs.cdc(read_stream(spark, f"{folder}/landing", max_files=1))


def truth(spark, slide=None):
    return windowed(inputs.cdc(inputs.events(spark, SF)), slide)


def test_update_mode_over_four_batches(spark, folder):
    sums = windowed(ordered_cdc(spark, folder), "30 minutes")
    run_stream(sums, mode="update", checkpoint=f"{folder}/cp", each_batch=ChangeLogSink(folder))
    newest = read_change_log(spark, folder, ["window_start", "window_end", "group"])
    assert bag(newest) == bag(truth(spark, "30 minutes"))


def test_append_mode_over_four_batches(spark, folder):
    sums = windowed(ordered_cdc(spark, folder), "30 minutes")
    report = run_stream(sums, path=f"{folder}/data", checkpoint=f"{folder}/cp")
    assert spark.read.parquet(f"{folder}/data").count() == 1680
    assert report.state_rows == 2  # the windows still open


def test_complete_mode_keeps_the_newest_result(spark, folder):
    stream = ordered_cdc(spark, folder)
    report = run_stream(
        aggregate.keyed_sum(stream, "id", "amount"), mode="complete",
        checkpoint=f"{folder}/cp", each_batch=ReplaceSink(folder),
    )
    want = inputs.cdc(inputs.events(spark, SF)).groupBy("id").agg(F.sum("amount").alias("sum"))
    assert bag(read_replaced(spark, folder)) == bag(want)
    assert report.state_rows == 15
    slots = [r.slot for r in spark.read.parquet(f"{folder}/commits").orderBy("batch").collect()]
    assert slots[:4] == [0, 1, 0, 1]


def test_uncommitted_result_is_not_read(spark, folder):
    sink = ReplaceSink(folder)
    for batch in range(2):
        sink(spark.range(batch + 1), batch)
    # a batch that died before its commit: the older slot is half overwritten
    spark.range(99).write.mode("overwrite").parquet(f"{folder}/slot=0")
    assert read_replaced(spark, folder).count() == 2
    sink(spark.range(3), 2)
    assert read_replaced(spark, folder).count() == 3


def test_replayed_batch_counts_once(spark, folder):
    sink = ChangeLogSink(folder)
    for batch_id, value in [(0, 1), (1, 2), (1, 2)]:
        sink(spark.sql(f"SELECT 'a' AS k, {value} AS v"), batch_id)
    assert spark.read.parquet(f"{folder}/changes").count() == 2
    assert bag(read_change_log(spark, folder, ["k"])) == {("a", 2): 1}


def test_named_queries_side_by_side_and_console(spark, folder):
    stream = ordered_cdc(spark, folder)
    started = [
        start_stream(aggregate.running_sum(stream, "amount"), mode="complete", fmt="memory", name="total"),
        start_stream(windowed(stream), mode="update", fmt="console", name="shown", options={"numRows": "1"}),
    ]
    reports = drain(*started)
    assert [r.name for r in reports] == ["total", "shown"]
    assert memory_table(spark, "total").first()[0] == 5_005_019
    assert [r.input_rows for r in reports] == [1000, 1000]


def test_state_partitions_are_kept_by_the_checkpoint(spark, folder):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stream = ordered_cdc(spark, folder)
    query = start_stream(windowed(stream), path=f"{folder}/data", checkpoint=f"{folder}/cp", state_partitions=3)
    drain(query)
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_ensure_table(spark, folder):
    ensure_table(spark, f"{folder}/t", ROWS)
    assert spark.read.parquet(f"{folder}/t").columns == ["ts", "id", "amount"]
    instants(spark, [(at(0), 1, 1)], ROWS).write.mode("append").parquet(f"{folder}/t")
    ensure_table(spark, f"{folder}/t", ROWS)
    assert spark.read.parquet(f"{folder}/t").count() == 1
