from collections import Counter
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from streamweir.sources.shards import _ShardReader, land_shards, read_shards
from streamweir.streaming.run import run_until_idle

CAP = 100


def land(spark, first, n, folder, shard):
    rows = spark.range(first, first + n, 1, 2).select(
        F.col("id").cast("string").cast("binary").alias("data"),
        F.timestamp_seconds("id").alias("approximateArrivalTimestamp"),
    )
    land_shards(rows, folder, shard)


def fetch(spark, folder):
    """Runs until there is nothing more; (report, rows with the number of their batch)."""

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    report = run_until_idle(read_shards(spark, f"{folder}/topic", CAP), checkpoint=f"{folder}/cp", each_batch=keep)
    return report, spark.read.schema("shard STRING, data BINARY, approximateArrivalTimestamp TIMESTAMP, batch INT").parquet(f"{folder}/out")


def per_shard_and_batch(rows):
    return {(r.shard, r.batch): r["count"] for r in rows.groupBy("shard", "batch").count().collect()}


def test_a_fetch_is_capped_per_shard_and_a_restart_goes_on_within_a_file(spark, folder):
    """Shards of 640 and 70 records; more come, and a new shard, before the second start."""
    hot = F.when(F.col("data").cast("string").cast("int") % 71 < 64, "a").otherwise("b")
    land(spark, 0, 710, f"{folder}/topic", hot)
    _, rows = fetch(spark, folder)
    counts = per_shard_and_batch(rows)
    assert max(counts.values()) == CAP
    assert sorted(n for (shard, _), n in counts.items() if shard == "a") == [40] + [CAP] * 6
    assert [n for (shard, _), n in counts.items() if shard == "b"] == [70]
    land(spark, 710, 30, f"{folder}/topic", F.lit("b"))
    land(spark, 740, 150, f"{folder}/topic", F.lit("c"))
    report, rows = fetch(spark, folder)
    assert report.input_rows == 180
    got = Counter(int(bytes(r.data)) for r in rows.collect())
    assert got == Counter(range(890)) and max(per_shard_and_batch(rows).values()) == CAP
    first = rows.where("data = CAST('5' AS BINARY)").first()
    assert first.approximateArrivalTimestamp.timestamp() == 5


def test_a_batch_that_failed_is_fetched_again_as_it_was(spark, folder):
    land(spark, 0, 350, f"{folder}/topic", F.lit("a"))

    def fail(batch, number):
        if number == 1:
            raise RuntimeError("lost")
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    with pytest.raises(Exception, match="lost"):
        run_until_idle(read_shards(spark, f"{folder}/topic", CAP), checkpoint=f"{folder}/cp", each_batch=fail)
    land(spark, 350, 20, f"{folder}/topic", F.lit("a"))
    _, rows = fetch(spark, folder)
    assert Counter(int(bytes(r.data)) for r in rows.collect()) == Counter(range(370))
    assert per_shard_and_batch(rows) == {("a", 0): 100, ("a", 1): 100, ("a", 2): 100, ("a", 3): 70}


def test_an_empty_topic(spark, folder):
    Path(f"{folder}/topic").mkdir()
    Path(f"{folder}/out").mkdir()
    report, rows = fetch(spark, folder)
    assert report.input_rows == 0 and rows.count() == 0
    with pytest.raises(Exception, match="at least 1"):
        run_until_idle(read_shards(spark, f"{folder}/topic", 0), checkpoint=f"{folder}/cp0", fmt="noop")


def test_ranges_over_row_groups_and_files(folder):
    """Any cap gives every record once and in order, over files of several row groups, one of them empty."""
    shard = Path(f"{folder}/topic/shard=s")
    shard.mkdir(parents=True)
    number = 0
    for file, size in enumerate([7, 0, 12, 1]):
        data = [None if n == 3 else str(n).encode() for n in range(number, number + size)]
        table = pa.table({"data": pa.array(data, pa.binary()), "approximateArrivalTimestamp": pa.array([datetime(2024, 1, 1)] * size, pa.timestamp("us", "UTC"))})
        pq.write_table(table, shard / f"{file}.parquet", row_group_size=5)
        number += size
    (shard / "_draft.parquet").write_bytes(b"not yet")
    expected = [None if n == 3 else str(n).encode() for n in range(number)]
    for cap in (1, 3, 5, 6, 100):
        reader, at, got = _ShardReader(f"file://{folder}/topic", cap), {}, []
        while (end := reader.latestOffset()) != at:
            taken = [b.column("data").to_pylist() for part in reader.partitions(at, end) for b in reader.read(part)]
            assert 0 < sum(map(len, taken)) <= cap
            got += [value for values in taken for value in values]
            at = end
        assert got == expected and list(at) == ["s"]


def test_a_batch_of_several_fetches(spark, folder):
    """Three fetches of a hundred a batch: fewer batches, every record once, and no more than a fetch in memory."""
    land(spark, 0, 710, f"{folder}/topic", F.when(F.col("data").cast("string").cast("int") < 650, "a").otherwise("b"))

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    report = run_until_idle(read_shards(spark, f"{folder}/topic", CAP, 3), checkpoint=f"{folder}/cp", each_batch=keep)
    rows = spark.read.schema("shard STRING, data BINARY, approximateArrivalTimestamp TIMESTAMP, batch INT").parquet(f"{folder}/out")
    assert report.input_rows == 710
    assert Counter(int(bytes(r.data)) for r in rows.collect()) == Counter(range(710))
    assert per_shard_and_batch(rows) == {("a", 0): 300, ("a", 1): 300, ("a", 2): 50, ("b", 0): 60}
    reader = _ShardReader(f"file://{folder}/topic", CAP, 3)
    sizes = [b.num_rows for part in reader.partitions({}, reader.latestOffset()) for b in reader.read(part)]
    assert sum(sizes) == 360 and max(sizes) <= CAP
    with pytest.raises(Exception, match="fetchesPerBatch"):
        run_until_idle(read_shards(spark, f"{folder}/topic", CAP, 0), checkpoint=f"{folder}/cp0", fmt="noop")
