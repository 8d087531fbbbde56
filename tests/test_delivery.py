import random
from pathlib import Path

import numpy as np
import pytest

from streamweir.functions.codec import encode_messages
from streamweir.streaming.delivery import (
    MAX_BYTES, BatchingWriter, DeliveryFailed, FolderTransport, deliver, deliver_partitions,
    export_stream, pack_requests, read_delivered, read_receipts, request_ends,
)
from streamweir.streaming.run import drain
from streamweir.streaming.sinks import commit

KIB = 1024


class Recorder:
    """Keeps what it is given; ``refuse(call, record)`` says which records fail."""

    def __init__(self, refuse=lambda call, record: False):
        self.refuse = refuse
        self.calls = []
        self.closed = []

    def open(self, partition_id, epoch_id):
        pass

    def put(self, records):
        self.calls.append(list(records))
        return ["busy" if self.refuse(len(self.calls) - 1, r) else None for r in records]

    def close(self, ok):
        self.closed.append(ok)


def record(number, size=1):
    return (str(number), b"x" * size)


def write(sizes, transport, error=None):
    writer = BatchingWriter(transport, sleep=lambda s: None)
    assert writer.open(0, 0) is True
    for number, size in enumerate(sizes):
        key, data = record(number, size)
        writer.process({"partitionKey": key, "data": bytearray(data)})
    writer.close(error)
    return [len(call) for call in transport.calls]


def test_limits_of_one_request():
    assert write([1] * 1201, Recorder()) == [500, 500, 201]
    assert write([300 * KIB] * 3, Recorder()) == [1, 1, 1]
    assert write([10, 600 * KIB, 10], Recorder()) == [1, 1, 1]
    assert write([MAX_BYTES - 10, 10, 1], Recorder()) == [2, 1]
    assert write([], Recorder()) == []


def test_vectorised_limits_are_the_same():
    rng = random.Random(5)
    for _ in range(60):
        kind = rng.choice([[0, 1, 5], [100, 200 * KIB, 300 * KIB, 600 * KIB], [MAX_BYTES, 0, 1], [700, 1200]])
        sizes = [rng.choice(kind) for _ in range(rng.randrange(1, 1500))]
        ends = request_ends(np.array(sizes))
        assert [b - a for a, b in zip([0, *ends], ends)] == write(sizes, Recorder())


def test_only_refused_records_are_sent_again_with_doubling_pauses():
    pauses = []
    transport = Recorder(lambda call, r: call < 3 and r[0] in ("1", "3"))
    attempts = deliver([record(n) for n in range(5)], transport, sleep=pauses.append)
    assert attempts == 4
    assert [[k for k, _ in call] for call in transport.calls] == [list("01234"), ["1", "3"], ["1", "3"], ["1", "3"]]
    assert pauses == [0.1, 0.2, 0.4]


def test_gives_up_after_ten_attempts():
    pauses = []
    with pytest.raises(DeliveryFailed, match="1 records refused in 10 attempts") as failure:
        deliver([record(0), record(1)], Recorder(lambda call, r: r[0] == "1"), sleep=pauses.append)
    assert failure.value.left == [record(1)]
    assert len(pauses) == 10 and round(sum(pauses), 6) == 102.3


def test_errors_of_the_transport_are_not_retried():
    class Broken(Recorder):
        def put(self, records):
            self.calls.append(records)
            raise OSError("gone")

    transport = Broken()
    with pytest.raises(OSError):
        deliver([record(0)], transport, sleep=lambda s: None)
    assert len(transport.calls) == 1


def test_accepted_records_are_not_sent_again_after_giving_up():
    transport = Recorder(lambda call, r: r[0] == "7")
    writer = BatchingWriter(transport, sleep=lambda s: None)
    writer.open(0, 0)
    with pytest.raises(DeliveryFailed) as failure:
        for number in range(501):
            writer.process({"partitionKey": str(number), "data": b"x"})
    assert [k for k, _ in writer.buffer] == ["7"] and writer.size == 1
    sent = len(transport.calls)
    writer.close(failure.value)
    assert len(transport.calls) == sent and transport.closed == [False]


def test_close_sends_the_rest_only_without_an_error():
    transport = Recorder()
    assert write([1, 1], transport, error=RuntimeError()) == [] and transport.closed == [False]
    transport = Recorder()
    assert write([1, 1], transport) == [2] and transport.closed == [True]


def messages(spark, n, parts=3):
    rows = spark.range(0, n, 1, parts).selectExpr("id", "repeat('y', CAST(id % 3000 AS INT)) AS text")
    return encode_messages(rows, "id")


def test_packed_requests(spark):
    sent = messages(spark, 7000)
    packed = pack_requests(sent)
    assert packed.where(f"n_records > 500 OR (n_bytes > {MAX_BYTES} AND n_records > 1)").isEmpty()
    assert packed.where("n_records <> size(records)").isEmpty()
    got = packed.selectExpr("inline(records)")
    assert got.exceptAll(sent).isEmpty() and sent.exceptAll(got).isEmpty()
    # numbered without gaps in each partition, and no request could have taken its successor's first record
    rows = packed.selectExpr("partition", "request_no", "n_records", "n_bytes",
                             "octet_length(records[0].data) AS first").orderBy("partition", "request_no").collect()
    for a, b in zip(rows, rows[1:]):
        if a.partition == b.partition:
            assert b.request_no == a.request_no + 1
            assert a.n_records == 500 or a.n_bytes + b.first > MAX_BYTES


def test_arrow_batches_do_not_cut_requests(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 70)
    try:
        rows = pack_requests(encode_messages(spark.range(0, 1201, 1, 1), "id"))
        assert [r.n_records for r in rows.orderBy("request_no").collect()] == [500, 500, 201]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_delivery_leaves_receipts(spark, folder):
    sent = messages(spark, 3000)
    receipts = deliver_partitions(sent, FolderTransport(f"{folder}/out")).collect()
    assert sum(r.n_records for r in receipts) == 3000 and {r.attempts for r in receipts} == {1}
    got = spark.read.parquet(f"{folder}/out")
    assert got.select("partitionKey", "data").exceptAll(sent).isEmpty() and got.count() == 3000


def test_a_replay_with_other_tasks_counts_once(spark, folder):
    """An epoch that is sent by four tasks and, after a crash, by two: readers see the second only."""
    transport = FolderTransport(f"{folder}/out")
    for parts in (4, 2):
        sent = deliver_partitions(messages(spark, 1000, parts=parts), transport, epoch_id=3)
        sent.write.mode("overwrite").parquet(f"{folder}/receipts/requests/batch_id=3")
    assert read_delivered(spark, f"{folder}/out", f"{folder}/receipts").count() == 0
    commit(spark, f"{folder}/receipts", 3)
    got = read_delivered(spark, f"{folder}/out", f"{folder}/receipts")
    assert got.count() == got.select("partitionKey").distinct().count() == 1000
    assert spark.read.parquet(f"{folder}/out").count() == 2000
    assert read_receipts(spark, f"{folder}/receipts").agg({"n_records": "sum"}).first()[0] == 1000


def test_failed_task_shows_no_file(folder):
    transport = FolderTransport(f"{folder}/out")
    transport.open(0, 0)
    transport.put([record(1)])
    transport.close(False)
    assert not list(Path(f"{folder}/out").glob("*.parquet"))


@pytest.mark.parametrize("vectorised", [False, True])
def test_export_goes_on_where_it_stopped(spark, folder, vectorised):
    schema = spark.range(1).schema
    for start in (0, 1000):
        spark.range(start, start + 1000).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        drain(export_stream(
            stream, "id", FolderTransport(f"{folder}/out"), f"{folder}/cp", partitions=2,
            receipts=f"{folder}/receipts" if vectorised else None,
        ))
    got = spark.read.parquet(f"{folder}/out")
    assert got.count() == got.select("partitionKey").distinct().count() == 2000
    if vectorised:
        assert read_receipts(spark, f"{folder}/receipts").groupBy().sum("n_records").first()[0] == 2000
        assert read_delivered(spark, f"{folder}/out", f"{folder}/receipts").count() == 2000


def test_refused_records_fail_the_export(spark, folder):
    class Refusing:
        def open(self, partition_id, epoch_id): ...
        def put(self, records): return ["full"] * len(records)
        def close(self, ok): ...

    spark.range(10).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(spark.range(1).schema).parquet(f"{folder}/in")
    query = export_stream(stream, "id", Refusing(), f"{folder}/cp", partitions=1, max_attempts=2, base_ms=1)
    with pytest.raises(Exception, match="refused in 2 attempts"):
        drain(query)
