"""A sink for messages with a commit of its own: a replayed epoch counts once, an aborted one leaves nothing.

The tasks of an epoch deliver through a transport and report one line each. When all are done the driver
writes these lines as the epoch's manifest, in one step. Only files that a manifest names count, so it does
not matter how often, or in how many tasks, an epoch was tried before.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from streamweir.functions.codec import encode_messages
from streamweir.session import qualified
from streamweir.streaming.delivery import (
    BASE_DELAY_MS, DELIVERED, MAX_ATTEMPTS, _n_bytes, _requests, deliver,
)
from streamweir.streaming.run import start_stream
from streamweir.streaming.sinks import ensure_table

MANIFEST = "epoch LONG, partition INT, file STRING, n_requests LONG, n_records LONG, n_bytes LONG, attempts LONG"

_ARROW = pa.schema([
    ("epoch", pa.int64()), ("partition", pa.int32()), ("file", pa.string()), ("n_requests", pa.int64()),
    ("n_records", pa.int64()), ("n_bytes", pa.int64()), ("attempts", pa.int64()),
])


class _Sent(WriterCommitMessage):
    """What a task has delivered; ``file`` is the transport's target, where it has one."""

    def __init__(self, partition: int, file: str | None):
        self.partition, self.file = partition, file
        self.n_requests = self.n_records = self.n_bytes = self.attempts = 0


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, transport, manifests: str, max_attempts: int, base_ms: int):
        self.transport, self.manifests = transport, manifests
        self.max_attempts, self.base_ms = max_attempts, base_ms

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        task = TaskContext.get()
        self.transport.open(task.partitionId(), int(task.getLocalProperty("streaming.sql.batchId") or 0))
        sent, ok = _Sent(task.partitionId(), getattr(self.transport, "target", None)), False
        try:
            for request in _requests(iterator):
                pairs = list(zip(request["partitionKey"].to_pylist(), request["data"].to_pylist()))
                sent.attempts += deliver(pairs, self.transport, self.max_attempts, self.base_ms)
                sent.n_requests += 1
                sent.n_records += request.num_rows
                sent.n_bytes += _n_bytes(request)
            ok = True
        finally:
            self.transport.close(ok)  # a draft of a failed attempt goes
        return sent

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        """One small file per epoch, complete before it has its name; a replay puts the same name in its place."""
        lines = [m for m in messages if m is not None and m.n_records]
        columns = [[batchId] * len(lines)] + [[getattr(m, name) for m in lines] for name in _ARROW.names[1:]]
        table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)
        system, folder = pyarrow.fs.FileSystem.from_uri(self.manifests)
        system.create_dir(folder)
        draft = f"{folder}/_{uuid.uuid4().hex}"
        pq.write_table(table, draft, filesystem=system)
        system.move(draft, f"{folder}/epoch-{batchId}.parquet")

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        """What finished tasks of a failed epoch have delivered is taken back, where the transport can."""
        discard = getattr(self.transport, "discard", None)
        for message in messages:
            if discard and message is not None and message.n_records:
                discard(message.file)


def register_sink(
    spark: SparkSession, transport, manifests: str, max_attempts: int = MAX_ATTEMPTS, base_ms: int = BASE_DELAY_MS,
) -> str:
    """A format for ``writeStream`` of (partitionKey, data) rows that delivers through this transport."""
    known_as = f"messages_{uuid.uuid4().hex}"
    manifests = qualified(spark, manifests)

    class MessageSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return known_as

        def streamWriter(self, schema, overwrite) -> DataSourceStreamArrowWriter:
            return _Writer(transport, manifests, max_attempts, base_ms)

    spark.dataSource.register(MessageSink)
    return known_as


def export_committed(
    df: DataFrame, key: str, transport, checkpoint: str, manifests: str, partitions: int | None = None,
    name: str | None = None, drain: bool = True, max_attempts: int = MAX_ATTEMPTS, base_ms: int = BASE_DELAY_MS,
) -> StreamingQuery:
    """Encode and deliver with a manifest per epoch under ``manifests``; :func:`read_committed` has each record once.

    With ``partitions`` the rows are dealt evenly over that many tasks first. Starts the query and returns.
    """
    dealt = df.repartition(partitions) if partitions else df
    sink = register_sink(df.sparkSession, transport, manifests, max_attempts, base_ms)
    return start_stream(encode_messages(dealt, key), checkpoint=checkpoint, name=name, fmt=sink, drain=drain)


def read_manifests(spark: SparkSession, manifests: str) -> DataFrame:
    """A line per task and committed epoch that delivered anything."""
    ensure_table(spark, manifests, MANIFEST)
    return spark.read.schema(MANIFEST).parquet(manifests)


def read_committed(spark: SparkSession, folder: str, manifests: str, schema: str = DELIVERED) -> DataFrame:
    """The records in the folder's files that a manifest names."""
    ensure_table(spark, folder, schema)
    files = read_manifests(spark, manifests).select("file").distinct()
    rows = spark.read.schema(schema).parquet(folder).select("*", F.col("_metadata.file_name").alias("file"))
    return rows.join(files, "file", "left_semi").drop("file")
