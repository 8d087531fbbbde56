"""Reports of long runs, and settings of several starts."""

import threading
from pathlib import Path

from streamweir.sources.streams import read_stream
from streamweir.streaming.run import PARTITIONS, drain, run_stream, start_stream, state_partitions_for


def test_every_batch_of_a_long_run_is_counted(spark, folder):
    spark.range(120).repartition(120, "id").write.option("maxRecordsPerFile", 1).parquet(f"{folder}/in")
    stream = read_stream(spark, f"{folder}/in", "id LONG", max_files=1)
    report = run_stream(stream, path=f"{folder}/out", checkpoint=f"{folder}/cp")
    assert report.input_rows == 120 == spark.read.parquet(f"{folder}/out").count()
    assert report.batches == list(range(len(list(Path(f"{folder}/in").glob("*.parquet")))))


def test_a_chosen_number_of_partitions_is_kept(spark):
    before = spark.conf.get(PARTITIONS)
    try:
        spark.conf.set(PARTITIONS, "200")
        assert state_partitions_for(spark) == 200
    finally:
        spark.conf.set(PARTITIONS, before)


def test_starts_from_several_threads_leave_the_setting_alone(spark, folder):
    before = spark.conf.get(PARTITIONS)
    spark.range(10).write.parquet(f"{folder}/in")
    queries = []

    def start(n):
        stream = read_stream(spark, f"{folder}/in", "id LONG")
        queries.append(start_stream(stream, path=f"{folder}/out{n}", checkpoint=f"{folder}/cp{n}", state_partitions=3 + n))

    threads = [threading.Thread(target=start, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [r.input_rows for r in drain(*queries)] == [10] * 4
    assert spark.conf.get(PARTITIONS) == before
