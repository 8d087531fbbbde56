"""Delivering keyed messages in bounded requests, with retries.

A transport is any picklable object with

* ``open(partition_id, epoch_id)``
* ``put(records)``: records are (key, payload) pairs; returns one entry per record,
  ``None`` where it was accepted and an error text where it was not
* ``close(ok)``

It is sent to the executors; connections belong in ``open``.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from streamweir.functions.codec import encode_messages
from streamweir.streaming.run import start_stream
from streamweir.streaming.sinks import commit, ensure_table

# Limits of one request and of its retries.
MAX_RECORDS = 500
MAX_BYTES = 500 * 1024
MAX_ATTEMPTS = 10
BASE_DELAY_MS = 100

PACKED = (
    "batch LONG, partition INT, request_no LONG, n_records INT, n_bytes LONG, "
    "records ARRAY<STRUCT<partitionKey: STRING, data: BINARY>>"
)
RECEIPT = "partition INT, request_no LONG, n_records INT, n_bytes LONG, attempts INT, file STRING"
DELIVERED = "request_no LONG, partitionKey STRING, data BINARY"


class DeliveryFailed(RuntimeError):
    """Records were refused in every attempt; ``left`` holds them."""

    def __init__(self, attempts: int, left: list, error: str):
        super().__init__(f"{len(left)} records refused in {attempts} attempts, first error: {error}")
        self.left = left


def deliver(
    records: list[tuple[str, bytes]],
    transport,
    max_attempts: int = MAX_ATTEMPTS,
    base_ms: int = BASE_DELAY_MS,
    sleep: Callable[[float], None] = time.sleep,
) -> int:
    """Put the records, then only those that were refused, with a doubling pause after
    each failed attempt. Returns the number of attempts. What the transport itself
    raises is passed on at once.
    """
    left = records
    for attempt in range(max_attempts):
        errors = transport.put(left)
        refused = [(record, error) for record, error in zip(left, errors, strict=True) if error is not None]
        if not refused:
            return attempt + 1
        left = [record for record, _ in refused]
        sleep(base_ms * 2**attempt / 1000)
    raise DeliveryFailed(max_attempts, left, refused[0][1])


class BatchingWriter:
    """Row-at-a-time writer for ``writeStream.foreach`` over (partitionKey, data).

    At least once: a replayed epoch is sent again. Accepted records leave the buffer
    even if a request fails, and nothing more is sent once the task has failed.
    """

    def __init__(self, transport, max_attempts: int = MAX_ATTEMPTS, base_ms: int = BASE_DELAY_MS,
                 sleep: Callable[[float], None] = time.sleep):
        self.transport = transport
        self.retry = {"max_attempts": max_attempts, "base_ms": base_ms, "sleep": sleep}

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.buffer: list[tuple[str, bytes]] = []
        self.size = 0
        self.transport.open(partition_id, epoch_id)
        return True

    def process(self, row) -> None:
        data = bytes(row["data"])
        full = len(self.buffer) == MAX_RECORDS
        if full or (self.buffer and self.size + len(data) > MAX_BYTES):
            self._flush()
        self.buffer.append((row["partitionKey"], data))
        self.size += len(data)

    def close(self, error) -> None:
        try:
            if error is None and self.buffer:
                self._flush()
        except BaseException:
            self.transport.close(False)
            raise
        self.transport.close(error is None)

    def _flush(self) -> None:
        records, self.buffer, self.size = self.buffer, [], 0
        try:
            deliver(records, self.transport, **self.retry)
        except DeliveryFailed as failure:
            self.buffer = failure.left
            self.size = sum(len(data) for _, data in failure.left)
            raise


def request_ends(sizes: np.ndarray, max_bytes: int = MAX_BYTES, max_records: int = MAX_RECORDS) -> list[int]:
    """Where each request ends when records of these sizes are packed in order."""
    total = np.concatenate(([0], np.cumsum(sizes)))
    ends, start = [], 0
    while start < len(sizes):
        fits = int(np.searchsorted(total, total[start] + max_bytes, side="right")) - 1
        start = min(max(fits, start + 1), start + max_records, len(sizes))
        ends.append(start)
    return ends


def _requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Arrow slices, one per request. Only the unfinished request is carried over."""
    carry = None
    for batch in batches:
        table = pa.Table.from_batches([batch]).select(["partitionKey", "data"])
        if carry is not None:
            table = pa.concat_tables([carry, table]).combine_chunks()
        sizes = pc.fill_null(pc.binary_length(table["data"]), 0).to_numpy()
        start = 0
        for end in request_ends(sizes)[:-1]:
            yield table.slice(start, end - start)
            start = end
        carry = table.slice(start)
    if carry is not None and carry.num_rows:
        yield carry


def _n_bytes(table: pa.Table) -> int:
    return pc.sum(pc.binary_length(table["data"])).as_py() or 0


def pack_requests(messages: DataFrame) -> DataFrame:
    """The requests of each partition as rows, for a sink that takes tables."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        partition, batch_id = task.partitionId(), int(task.getLocalProperty("streaming.sql.batchId") or 0)
        for number, request in enumerate(_requests(batches)):
            flat = request.combine_chunks()
            records = pa.StructArray.from_arrays(
                [flat["partitionKey"].combine_chunks().cast(pa.string()),
                 flat["data"].combine_chunks().cast(pa.binary())],
                names=["partitionKey", "data"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([batch_id], pa.int64()),
                    pa.array([partition], pa.int32()),
                    pa.array([number], pa.int64()),
                    pa.array([flat.num_rows], pa.int32()),
                    pa.array([_n_bytes(flat)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, flat.num_rows], pa.int32()), records),
                ],
                names=["batch", "partition", "request_no", "n_records", "n_bytes", "records"],
            )

    return messages.mapInArrow(pack, PACKED)


def deliver_partitions(
    messages: DataFrame, transport, epoch_id: int = 0,
    max_attempts: int = MAX_ATTEMPTS, base_ms: int = BASE_DELAY_MS,
) -> DataFrame:
    """Send each partition's requests and return a receipt per request, with the transport's ``target`` if it has one.

    Sizes are read off Arrow columns, so Python touches a record only to hand it over.
    Delivery happens when the receipts are evaluated: write them exactly once.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        transport.open(partition, epoch_id)
        ok = False
        try:
            for number, request in enumerate(_requests(batches)):
                pairs = list(zip(request["partitionKey"].to_pylist(), request["data"].to_pylist()))
                attempts = deliver(pairs, transport, max_attempts, base_ms)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([partition], pa.int32()),
                        pa.array([number], pa.int64()),
                        pa.array([request.num_rows], pa.int32()),
                        pa.array([_n_bytes(request)], pa.int64()),
                        pa.array([attempts], pa.int32()),
                        pa.array([getattr(transport, "target", None)], pa.string()),
                    ],
                    names=["partition", "request_no", "n_records", "n_bytes", "attempts", "file"],
                )
            ok = True
        finally:
            transport.close(ok)

    return messages.mapInArrow(send, RECEIPT)


def export_stream(
    df: DataFrame,
    key: str,
    transport,
    checkpoint: str,
    partitions: int | None = None,
    name: str | None = None,
    receipts: str | None = None,
    drain: bool = True,
    max_attempts: int = MAX_ATTEMPTS,
    base_ms: int = BASE_DELAY_MS,
) -> StreamingQuery:
    """Encode and deliver, at least once.

    With ``partitions`` the rows are first dealt evenly over that many tasks, for sources of
    few or uneven files. Without, each split of the source is delivered where it is read, and
    nothing is shuffled.

    Starts the query and returns; start one per table and drain them together. With a
    ``receipts`` path the delivery is vectorised and leaves a receipt per request there, with a commit row
    per epoch: what an epoch that is replayed has left behind is in no committed receipt, so
    :func:`read_delivered` has every record once. Without one it goes through the row-at-a-time writer.
    """
    dealt = df.repartition(partitions) if partitions else df
    common = {"checkpoint": checkpoint, "name": name, "drain": drain}
    if receipts is None:
        writer = BatchingWriter(transport, max_attempts, base_ms)
        return start_stream(encode_messages(dealt, key), writer=writer, **common)

    def send(batch: DataFrame, epoch_id: int) -> None:
        sent = deliver_partitions(batch, transport, epoch_id, max_attempts, base_ms)
        sent.write.mode("overwrite").parquet(f"{receipts}/requests/batch_id={epoch_id}")
        commit(batch.sparkSession, receipts, epoch_id)

    return start_stream(encode_messages(dealt, key), each_batch=send, **common)


def _arrow_uri(uri: str) -> str:
    """Hadoop's spelling of a location in Arrow's."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        return uri.removeprefix("file:")
    return uri.replace("s3a://", "s3://", 1)


def read_receipts(spark: SparkSession, receipts: str) -> DataFrame:
    """The receipts of all committed epochs."""
    ensure_table(spark, f"{receipts}/commits", "batch LONG")
    ensure_table(spark, f"{receipts}/requests", RECEIPT)
    epochs = spark.read.parquet(f"{receipts}/commits").select(F.col("batch").alias("batch_id")).distinct()
    rows = spark.read.schema(f"{RECEIPT}, batch_id LONG").parquet(f"{receipts}/requests")
    return rows.join(epochs, "batch_id", "left_semi")


def read_delivered(spark: SparkSession, folder: str, receipts: str, schema: str = DELIVERED) -> DataFrame:
    """The records in the folder's files that committed receipts name."""
    ensure_table(spark, folder, schema)
    files = read_receipts(spark, receipts).select("file").distinct()
    rows = spark.read.schema(schema).parquet(folder).select("*", F.col("_metadata.file_name").alias("file"))
    return rows.join(files, "file", "left_semi").drop("file")


class FolderTransport:
    """Requests as Parquet row groups, one file per attempt of a task, in a shared folder.

    The file appears under its own name, ``target``, when the task closes cleanly. Attempts do not touch
    each other's files; which of them count is for the receipts to say.
    """

    SCHEMA = pa.schema(
        [("request_no", pa.int64()), ("partitionKey", pa.string()), ("data", pa.binary())]
    )

    def __init__(self, uri: str):
        self.uri = uri

    def open(self, partition_id: int, epoch_id: int) -> None:
        self.fs, self.folder = pyarrow.fs.FileSystem.from_uri(_arrow_uri(self.uri))
        self.fs.create_dir(self.folder)
        self.target = f"{epoch_id}-{partition_id}-{uuid.uuid4().hex}.parquet"
        self.draft = f"{self.folder}/_{self.target}"
        self.file = None
        self.request_no = 0

    def put(self, records: list[tuple[str, bytes]]) -> list[str | None]:
        self._write(records, {})
        return [None] * len(records)

    def _write(self, records: list[tuple[str, bytes]], more: dict[str, pa.Array]) -> None:
        if self.file is None:
            self.file = pq.ParquetWriter(self.draft, self.SCHEMA, filesystem=self.fs)
        keys, payloads = zip(*records)
        numbers = pa.array(np.full(len(records), self.request_no), pa.int64())
        columns = [numbers, pa.array(keys, pa.string()), pa.array(payloads, pa.binary()), *more.values()]
        self.file.write_table(pa.Table.from_arrays(columns, schema=self.SCHEMA))
        self.request_no += 1

    def close(self, ok: bool) -> None:
        if self.file is None:
            return
        self.file.close()
        if ok:
            self.fs.move(self.draft, f"{self.folder}/{self.target}")
        else:
            self.fs.delete_file(self.draft)

    def discard(self, target: str) -> None:
        """Takes a closed file back; one that is not there any more is none."""
        system, folder = pyarrow.fs.FileSystem.from_uri(_arrow_uri(self.uri))
        if system.get_file_info(f"{folder}/{target}").type == pyarrow.fs.FileType.File:
            system.delete_file(f"{folder}/{target}")


class RefusingTransport(FolderTransport):
    """Refuses records whose MD5 ends in one of the digits, ``times`` times each; notes how often a record was sent.

    For drills: a request is put again with what was refused, so the tries of a request are counted.
    """

    SCHEMA = FolderTransport.SCHEMA.append(pa.field("tries", pa.int32()))

    def __init__(self, uri: str, digits: str, times: int):
        super().__init__(uri)
        self.digits, self.times = digits, times

    def open(self, partition_id: int, epoch_id: int) -> None:
        super().open(partition_id, epoch_id)
        self.tries = 0

    def put(self, records: list[tuple[str, bytes]]) -> list[str | None]:
        refused = [self.tries < self.times and hashlib.md5(data).hexdigest()[-1] in self.digits for _, data in records]
        self.tries += 1
        taken = [record for record, no in zip(records, refused) if not no]
        if taken:
            self._write(taken, {"tries": pa.array(np.full(len(taken), self.tries), pa.int32())})
        if not any(refused):
            self.tries = 0
        return ["try again" if no else None for no in refused]
