"""Starting queries, draining them, and what they report."""

from __future__ import annotations

import json
import logging
import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger("streamweir")

PARTITIONS = "spark.sql.shuffle.partitions"
_starting = threading.Lock()


def state_partitions_for(spark: SparkSession) -> int:
    """The session's shuffle partitions if someone chose them, else one per core.

    State is split once, when a query first starts, and adaptive execution does not
    regroup it: Spark's own default is far too many for one machine and far too few
    for a large cluster. Under dynamic allocation set the number.
    """
    chosen = spark.conf.getAll.get(PARTITIONS)
    return int(chosen) if chosen is not None else spark.sparkContext.defaultParallelism


@dataclass
class RunReport:
    """What a drained query did, from its own progress reports."""

    name: str
    batches: list[int] = field(default_factory=list)
    input_rows: int = 0
    late_rows: int = 0
    state_rows: int = 0
    batch_ms: list[int] = field(default_factory=list)
    watermark: str | None = None

    def add(self, progress: dict) -> None:
        self.batches.append(progress["batchId"])
        self.input_rows += sum(s["numInputRows"] for s in progress["sources"])
        self.batch_ms.append(progress["batchDuration"])
        states = progress.get("stateOperators") or []
        self.late_rows += sum(s["numRowsDroppedByWatermark"] for s in states)
        if states:
            self.state_rows = sum(s["numRowsTotal"] for s in states)
        self.watermark = (progress.get("eventTime") or {}).get("watermark", self.watermark)


class _Reports(StreamingQueryListener):
    """Adds up every progress of the queries that were started here; Spark itself keeps the last 100."""

    def __init__(self):
        self.reports: dict[str, RunReport] = {}
        self.ended: dict[str, threading.Event] = {}

    def expect(self, run_id: str) -> None:
        self.reports.setdefault(run_id, RunReport(run_id))
        self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self.expect(str(event.runId))

    def onQueryProgress(self, event) -> None:
        report = self.reports.get(str(event.progress.runId))
        if report is not None:
            report.add(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        ended = self.ended.get(str(event.runId))
        if ended is not None:
            ended.set()

    def take(self, run_id: str) -> RunReport | None:
        """The report of an ended query; its last progress comes shortly after its end."""
        ended = self.ended.get(run_id)
        if ended is None or not ended.wait(60):
            return None
        self.ended.pop(run_id)
        return self.reports.pop(run_id)


_listeners: dict[int, tuple[SparkSession, _Reports]] = {}


def _reports_of(spark: SparkSession) -> _Reports:
    """The session's listener, added once."""
    known = _listeners.get(id(spark))
    if known is None or known[0] is not spark:
        known = _listeners[id(spark)] = (spark, _Reports())
        spark.streams.addListener(known[1])
    return known[1]


def start_stream(
    df: DataFrame,
    checkpoint: str | None = None,
    path: str | None = None,
    name: str | None = None,
    fmt: str = "parquet",
    mode: str = "append",
    drain: bool = True,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    writer: object | None = None,
    state_partitions: int | None = None,
    options: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Start a query; the call returns at once, so several can run side by side.

    With ``drain`` it takes all input there is and stops, else it runs on.
    ``each_batch`` and ``writer`` replace the table sink ``fmt``/``path``.
    ``state_partitions`` counts at the first start only: the checkpoint keeps it. The
    default is :func:`state_partitions_for` the session.
    """
    out = df.writeStream.outputMode(mode).options(**(options or {}))
    if checkpoint:
        out = out.option("checkpointLocation", checkpoint)
    if name:
        out = out.queryName(name)
    if partition_by:
        out = out.partitionBy(*partition_by)
    if drain:
        out = out.trigger(availableNow=True)
    if each_batch is not None:
        out = out.foreachBatch(each_batch)
    elif writer is not None:
        out = out.foreach(writer)
    else:
        out = out.format(fmt)

    spark = df.sparkSession
    _reports_of(spark)
    with _starting:  # the setting is the session's: one start at a time
        before = spark.conf.getAll.get(PARTITIONS)
        spark.conf.set(PARTITIONS, state_partitions or state_partitions_for(spark))
        try:
            return out.start(path) if path else out.start()
        finally:
            if before is None:
                spark.conf.unset(PARTITIONS)
            else:
                spark.conf.set(PARTITIONS, before)


def drain(*queries: StreamingQuery, timeout: int | None = None) -> list[RunReport]:
    """Wait until each query has taken all its input; the first error is raised."""
    reports = []
    for query in queries:
        finished = query.awaitTermination(timeout) if timeout else query.awaitTermination()
        if finished is False:
            query.stop()
            raise TimeoutError(f"{query.name or query.id} did not finish in {timeout} s")
        # a finished query no longer knows its session; the listener that saw it start does
        report = next((r for _, known in list(_listeners.values()) if (r := known.take(str(query.runId)))), None)
        if report is None:
            raise ValueError(f"{query.name or query.id} was not started by start_stream")
        report.name = query.name or str(query.id)
        log.info("drained %s: %s rows", report.name, report.input_rows, extra={"report": report})
        reports.append(report)
    return reports


def run_stream(df: DataFrame, timeout: int | None = None, **how) -> RunReport:
    """Drain one query; arguments as for :func:`start_stream`."""
    return drain(start_stream(df, **how), timeout=timeout)[0]


def run_until_idle(df: DataFrame, **how) -> RunReport:
    """Run micro-batches until the sources have nothing more, then stop: for sources that bound a batch themselves.

    Arguments as for :func:`start_stream`. A batch that was not committed is taken up again by the next start.
    """
    query = start_stream(df, drain=False, **how)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return drain(query)[0]


def drain_to_table(df: DataFrame, root: str, fmt: str = "parquet", **how) -> DataFrame:
    """Drain an append query into ``root``/data and read the table back."""
    run_stream(df, path=f"{root}/data", checkpoint=f"{root}/checkpoint", fmt=fmt, **how)
    return df.sparkSession.read.format(fmt).load(f"{root}/data")


def memory_table(spark: SparkSession, name: str) -> DataFrame:
    """The table of a memory sink. It lives on the driver: for small checks only."""
    return spark.table(name)
