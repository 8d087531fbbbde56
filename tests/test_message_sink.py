from pathlib import Path

import pytest

from streamweir.streaming.delivery import FolderTransport
from streamweir.streaming.message_sink import export_committed, read_committed, read_manifests
from streamweir.streaming.run import drain


def land(spark, folder, start, n=1000):
    spark.range(start, start + n).write.mode("append").parquet(f"{folder}/in")


def export(spark, folder, transport=None, **how):
    stream = spark.readStream.schema(spark.range(1).schema).parquet(f"{folder}/in")
    transport = transport or FolderTransport(f"{folder}/out")
    return drain(export_committed(stream, "id", transport, f"{folder}/cp", f"{folder}/manifests", **how))


def delivered(spark, folder):
    return sorted(int(r.partitionKey) for r in read_committed(spark, f"{folder}/out", f"{folder}/manifests").collect())


def files(folder):
    return list(Path(f"{folder}/out").glob("*.parquet")), list(Path(f"{folder}/out").glob("_*"))


def test_export_goes_on_and_a_manifest_has_every_task(spark, folder):
    for start in (0, 1000):
        land(spark, folder, start)
        export(spark, folder, partitions=3)
    assert delivered(spark, folder) == list(range(2000))
    lines = read_manifests(spark, f"{folder}/manifests").collect()
    assert sorted((r.epoch, r.partition) for r in lines) == [(e, p) for e in (0, 1) for p in range(3)]
    assert sum(r.n_records for r in lines) == 2000 and all(r.attempts == r.n_requests == 1 for r in lines)


def test_an_epoch_that_is_replayed_on_other_tasks_counts_once(spark, folder):
    """The sink has committed and Spark has not noted it: the epoch is sent again, by two tasks in place of five."""
    land(spark, folder, 0)
    export(spark, folder, partitions=5)
    land(spark, folder, 1000)
    export(spark, folder, partitions=5)
    for note in Path(f"{folder}/cp/commits").glob("*1*"):
        note.unlink()
    export(spark, folder, partitions=2)
    assert delivered(spark, folder) == list(range(2000))
    lines = read_manifests(spark, f"{folder}/manifests").where("epoch = 1").collect()
    assert sorted(r.partition for r in lines) == [0, 1]
    assert len(files(folder)[0]) == 12  # the five files of the first try are there and count for nothing


class Breaking(FolderTransport):
    """The task that gets record 7 fails behind its first request."""

    def put(self, records):
        errors = super().put(records)
        if any(key == "7" for key, _ in records):
            raise OSError("gone")
        return errors


def test_an_aborted_epoch_leaves_no_file(spark, folder):
    land(spark, folder, 0)
    with pytest.raises(Exception, match="gone"):
        export(spark, folder, Breaking(f"{folder}/out"), partitions=1)
    assert files(folder) == ([], []) and delivered(spark, folder) == []
    export(spark, folder, partitions=3)
    assert delivered(spark, folder) == list(range(1000))


def test_what_finished_tasks_delivered_is_taken_back(folder):
    from streamweir.streaming.message_sink import _Sent, _Writer

    transport = FolderTransport(f"{folder}/out")
    transport.open(0, 0)
    transport.put([("1", b"x")])
    transport.close(True)
    sent = _Sent(0, transport.target)
    sent.n_records = 1
    writer = _Writer(transport, f"file://{folder}/manifests", 1, 1)
    writer.abort([sent, None], 0)
    writer.abort([sent, None], 0)
    assert files(folder) == ([], [])


def test_refused_records_fail_the_epoch(spark, folder):
    class Refusing:
        def open(self, partition_id, epoch_id): ...
        def put(self, records): return ["full"] * len(records)
        def close(self, ok): ...

    land(spark, folder, 0, 10)
    with pytest.raises(Exception, match="refused in 2 attempts"):
        export(spark, folder, Refusing(), partitions=1, max_attempts=2, base_ms=1)
    assert read_manifests(spark, f"{folder}/manifests").count() == 0
