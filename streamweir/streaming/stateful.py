"""Keyed state with an event-time timeout: the newest impression and click per key.

Not a relational join. A key gives at most one row per micro-batch that has rows
for it, made of the last impression and the last click known by then, so the result
depends on the batching. State that sees no rows for a while goes without a trace.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

TIMEOUT_MS = 20_000
BUCKETS = 256
PARTS = 64

_NONE = np.iinfo(np.int64).min  # a side that is not known, smaller than any time


def tagged_union(
    impressions: DataFrame, clicks: DataFrame, key: str,
    impression_time: str, click_time: str,
) -> DataFrame:
    """Both streams as one: the row in the struct of its side, event time and key beside it."""
    impression = F.struct(*impressions.columns)
    click = F.struct(*clicks.columns)
    left = impressions.select(
        impression.alias("impression"),
        F.lit(None).cast(clicks.select(click).schema[0].dataType).alias("click"),
        F.col(impression_time).alias("eventTime"),
        F.col(key),
    )
    right = clicks.select(
        F.lit(None).cast(impressions.select(impression).schema[0].dataType).alias("impression"),
        click.alias("click"),
        F.col(click_time).alias("eventTime"),
        F.col(key),
    )
    return left.unionByName(right)


def _newest(rows: pd.DataFrame) -> pd.DataFrame:
    """Newest time of each side per key."""
    return rows.groupby("key", sort=False)[["part", "shown", "clicked"]].max()


def _combine(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Within a chunk only the newest row per key and side can matter."""
    for chunk in chunks:
        yield chunk.groupby(["bucket", "part", "key", "is_click"], as_index=False, sort=False)["eventTime"].max()


def _sides(chunk: pd.DataFrame) -> pd.DataFrame:
    at, is_click = chunk["at"].to_numpy(), chunk["is_click"].to_numpy()
    return pd.DataFrame({
        "part": chunk["part"].to_numpy(),
        "key": chunk["key"].to_numpy(),
        "shown": np.where(is_click, _NONE, at),
        "clicked": np.where(is_click, at, _NONE),
    })


def _packed(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


class _KeepNewest(StatefulProcessor):
    """The keys of one bucket, in parts by a second hash: a batch reads and writes the parts of its keys only.

    All parts of a call are worked on as one table; a part costs a read, a write and little else. ``due`` has for each
    part when its first and its last key expire. There is a timer as long as there is a part; it is
    set to no later than the first of these times, and set anew when it has fired.
    """

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getMapState("newest", "part INT", "rows BINARY")
        self.due = handle.getValueState("due", "parts BINARY")

    def _due(self) -> dict[int, tuple[int, int]]:
        stored = self.due.get()
        times = np.frombuffer(stored[0], np.int64).reshape(-1, 3).tolist() if stored else []
        return {part: (first, last) for part, first, last in times}

    def _set_due(self, due: dict[int, tuple[int, int]]) -> None:
        if due:
            self.due.update((np.array([(part, *times) for part, times in due.items()], np.int64).tobytes(),))
        else:
            self.due.clear()

    def _read(self, parts: list[int]) -> pd.DataFrame | None:
        """The rows of some parts that there are, by key."""
        if not parts:
            return None
        tables = [pa.ipc.open_stream(self.newest.getValue((part,))[0]).read_all() for part in parts]
        rows = pa.concat_tables(tables).to_pandas()
        rows["part"] = np.repeat(parts, [t.num_rows for t in tables])
        return rows.set_index("key")

    def _write(self, kept: pd.DataFrame, due: dict[int, tuple[int, int]]) -> None:
        """Each part that has rows, whole, and when it is due."""
        kept = kept.sort_values("part", kind="stable")
        parts, starts = np.unique(kept["part"].to_numpy(), return_index=True)
        expires = kept["expires"].to_numpy()
        rows = pa.RecordBatch.from_pandas(kept.drop(columns="part").reset_index(), preserve_index=False).replace_schema_metadata()
        for part, start, end in zip(parts.tolist(), starts.tolist(), [*starts[1:].tolist(), len(kept)]):
            self.newest.updateValue((part,), (_packed(rows.slice(start, end - start)),))
            due[part] = (int(expires[start:end].min()), int(expires[start:end].max()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark, seen = timerValues.getCurrentWatermarkInMs(), None
        for chunk in rows:
            sides = _sides(chunk)
            seen = _newest(sides if seen is None else pd.concat([seen.reset_index(), sides]))
        due = self._due()
        has_timer = bool(due)
        new = seen[["shown", "clicked"]].copy()
        old = self._read([part for part in seen["part"].unique().tolist() if part in due])
        if old is not None:
            # a side that this batch brought replaces what is known, even by an older time
            new = new.where(new != _NONE, old[["shown", "clicked"]].reindex(new.index, fill_value=_NONE))
        new["expires"], new["part"] = watermark + self.timeout_ms, seen["part"]
        idle = [] if old is None else [old[~old.index.isin(new.index) & (old["expires"] >= watermark)]]
        self._write(pd.concat([new, *idle]), due)
        self._set_due(due)
        both = new[(new["shown"] != _NONE) & (new["clicked"] != _NONE)]
        if len(both):
            yield both.reset_index()[["key", "shown", "clicked"]]
        if not has_timer:
            self.handle.registerTimer(max(watermark + self.timeout_ms, watermark + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, due = timerValues.getCurrentWatermarkInMs(), self._due()
        over = [part for part, (first, _) in due.items() if first < watermark]
        some = self._read([part for part in over if due[part][1] >= watermark])  # a part without a live key is not read
        for part in over:
            if due[part][1] < watermark:
                self.newest.removeKey((part,))
                del due[part]
        if some is not None:
            self._write(some[some["expires"] >= watermark], due)
        self._set_due(due)
        if due:
            self.handle.registerTimer(max(min(first for first, _ in due.values()), watermark + 1))
        yield from ()

    def close(self) -> None:
        pass


def stateful_join(
    union: DataFrame, key: str, delay: str = "20 seconds", timeout_ms: int = TIMEOUT_MS,
    buckets: int = BUCKETS, parts: int = PARTS,
) -> DataFrame:
    """(key, impressionTime, clickTime) from a :func:`tagged_union`.

    A call into Python costs milliseconds, and one to the state store a part of one: too much for each
    key. Keys are hashed into ``buckets``, a bucket's keys into ``parts``. A call handles one bucket;
    each part is one entry of its state, a small Arrow table, and only those of the batch's keys are read
    and written. Aim at some ten live keys per part, and keep both numbers for as long as the checkpoint lives.

    Only the newest row per key and side of a micro-batch matters. Each task reduces its
    Arrow chunks to those before the shuffle, so a hot key sends two rows per chunk.
    Rows without a key or time belong to no state and are left out.
    """
    kind = union.schema[key].dataType.simpleString()
    sides = union.where(F.col(key).isNotNull() & F.col("eventTime").isNotNull()).select(
        F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"),
        F.pmod(F.xxhash64(F.lit("part"), key), F.lit(parts)).cast("int").alias("part"),
        F.col(key).alias("key"),
        F.col("click").isNotNull().alias("is_click"),
        "eventTime",
    )
    newest = sides.mapInPandas(_combine, f"bucket INT, part INT, key {kind}, is_click BOOLEAN, eventTime TIMESTAMP")
    pairs = (
        newest.withColumn("at", F.unix_micros("eventTime"))
        .withWatermark("eventTime", delay)
        .groupBy("bucket")
        .transformWithStateInPandas(
            _KeepNewest(timeout_ms), f"key {kind}, shown LONG, clicked LONG", "Append", "EventTime",
        )
    )
    return pairs.select(
        F.col("key").alias(key),
        F.timestamp_micros("shown").alias("impressionTime"),
        F.timestamp_micros("clicked").alias("clickTime"),
    )
