"""A message source with a cap on the records of a fetch.

A topic is a folder with one folder per shard, ``shard=<name>``, of Parquet files of messages. A fetch takes at
most so many records of a shard, wherever in a file that ends, and a micro-batch so many fetches of each shard, one unless more
are asked for. So a backlog comes in even steps and a hot shard does not make a batch longer. Order within a shard is that
of its files, oldest first.

A micro-batch has a cost of its own, several tenths of a second, however small it is: a large backlog wants many fetches in one.
A task hands them on one by one, so that more of them take no more memory.

The position has one entry per shard, however many files there are. Files do not change, and a file that is added to
a shard has to be newer than those before it: one job at a time writes to a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from streamweir.schemas import ENVELOPE
from streamweir.session import qualified
from streamweir.streaming.sinks import append_table

MAX_RECORDS_PER_FETCH = 10_000
SHARDED = f"shard STRING, {ENVELOPE}"
_MOST_AT_ONCE = 65_536  # records in memory, whatever the cap

_ARROW = pa.schema([
    ("shard", pa.string()), ("data", pa.binary()), ("approximateArrivalTimestamp", pa.timestamp("us", "UTC")),
])


class _Range(InputPartition):
    """Records ``start`` to ``end`` of one file."""

    def __init__(self, shard: str, path: str, start: int, end: int):
        self.shard, self.path, self.start, self.end = shard, path, start, end


class _ShardReader(DataSourceStreamReader):
    """A position is, per shard, the file that was read last, its time, and the records taken from it."""

    def __init__(self, uri: str, cap: int, fetches: int = 1):
        self.uri = uri
        self.cap = cap
        self.fetches = fetches
        self.at: dict | None = None  # up to where batches are planned
        self.sizes: dict[str, int] = {}

    def _system(self) -> tuple[pyarrow.fs.FileSystem, str]:
        return pyarrow.fs.FileSystem.from_uri(self.uri)

    def _shards(self) -> list[tuple[str, str]]:
        system, base = self._system()
        found = system.get_file_info(pyarrow.fs.FileSelector(base, allow_not_found=True))
        folders = [f for f in found if f.type == pyarrow.fs.FileType.Directory and f.base_name.startswith("shard=")]
        return sorted((f.base_name.removeprefix("shard="), f.path) for f in folders)

    def _from(self, folder: str, position: dict) -> list[tuple[int, str, str]]:
        """(time, name, path) of the file of the position and those after it."""
        system, _ = self._system()
        files = [
            (f.mtime_ns, f.base_name, f.path) for f in system.get_file_info(pyarrow.fs.FileSelector(folder))
            if f.type == pyarrow.fs.FileType.File and not f.base_name.startswith(("_", "."))
        ]
        return sorted(f for f in files if f[:2] >= (position.get("time", 0), position.get("file", "")))

    def _size(self, path: str) -> int:
        if path not in self.sizes:
            self.sizes[path] = pq.read_metadata(path, filesystem=self._system()[0]).num_rows
        return self.sizes[path]

    def _after(self, folder: str, position: dict) -> dict:
        """The position at most ``fetches`` times ``cap`` records on."""
        room = self.cap * self.fetches
        for time, name, path in self._from(folder, position):
            done = position["row"] if (time, name) == (position.get("time"), position.get("file")) else 0
            step = min(room, self._size(path) - done)
            if step:
                position = {"time": time, "file": name, "row": done + step}
                room -= step
            if not room:
                break
        return position

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        known = self.at or {}
        moved = {shard: self._after(folder, known.get(shard, {})) for shard, folder in self._shards()}
        self.at = {shard: position for shard, position in {**known, **moved}.items() if position}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if self.at is None:  # after a restart Spark plans the last batch again, before it asks for more
            self.at = end
        ranges = []
        for shard, folder in self._shards():
            first, last = start.get(shard, {}), end.get(shard, {})
            if first == last:
                continue
            for time, name, path in self._from(folder, first):
                if (time, name) > (last["time"], last["file"]):
                    break
                low = first["row"] if (time, name) == (first.get("time"), first.get("file")) else 0
                high = last["row"] if (time, name) == (last["time"], last["file"]) else self._size(path)
                if high > low:
                    ranges.append(_Range(shard, path, low, high))
        return ranges

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        system, _ = self._system()
        with system.open_input_file(partition.path) as source, pq.ParquetFile(source) as file:
            passed = 0
            for group in range(file.num_row_groups):
                size = file.metadata.row_group(group).num_rows
                low, high = max(partition.start - passed, 0), min(partition.end - passed, size)
                passed += size
                if low >= high:
                    continue
                place = 0
                for batch in file.iter_batches(min(self.cap, _MOST_AT_ONCE), row_groups=[group], columns=_ARROW.names[1:]):
                    kept = batch.slice(max(low - place, 0), max(high - max(low, place), 0))
                    place += batch.num_rows
                    if kept.num_rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([partition.shard] * kept.num_rows), *[
                                kept.column(f.name).cast(f.type) for f in list(_ARROW)[1:]
                            ]],
                            schema=_ARROW,
                        )
                    if place >= high:
                        break


class ShardedMessages(DataSource):
    """``spark.readStream.format("sharded_messages")`` with ``path``, ``maxRecordsPerFetch`` and ``fetchesPerBatch``."""

    @classmethod
    def name(cls) -> str:
        return "sharded_messages"

    def schema(self) -> str:
        return SHARDED

    def streamReader(self, schema) -> DataSourceStreamReader:
        cap = int(self.options.get("maxRecordsPerFetch", MAX_RECORDS_PER_FETCH))
        if cap < 1:
            raise ValueError("maxRecordsPerFetch is at least 1")
        fetches = int(self.options.get("fetchesPerBatch", 1))
        if fetches < 1:
            raise ValueError("fetchesPerBatch is at least 1")
        return _ShardReader(self.options["path"], cap, fetches)


def read_shards(spark: SparkSession, path: str, max_records: int = MAX_RECORDS_PER_FETCH, fetches: int = 1) -> DataFrame:
    """The messages of a topic as a stream, ``max_records`` of a shard at a time and at most ``fetches`` times that per micro-batch.

    Drain it with :func:`streamweir.streaming.run.run_until_idle`: the trigger that takes what there is and
    stops asks a source of this kind for one batch only.
    """
    spark.dataSource.register(ShardedMessages)
    return spark.readStream.format("sharded_messages").load(
        qualified(spark, path), maxRecordsPerFetch=str(max_records), fetchesPerBatch=str(fetches)
    )


def land_shards(messages: DataFrame, path: str, shard: Column) -> None:
    """Append envelopes to the shards that ``shard`` names, a whole number or text."""
    rows = messages.select("data", "approximateArrivalTimestamp", shard.cast("string").alias("shard"))
    append_table(rows, path, by=["shard"])
