"""Named datasets that are built from one another.

A dataset is a function that returns a DataFrame. It names its inputs by reading
them, and each one is drained into its own table before its reader goes on::

    flow = DatasetFlow(spark, root)

    @flow.dataset
    def bronze():
        return decode_messages(flow.read_stream("raw"), IMPRESSION)

    flow.refresh("bronze")

Another refresh takes what has arrived since.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streamweir.sources.streams import read_stream
from streamweir.streaming.run import RunReport, run_stream


class DatasetFlow:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.reports: dict[str, RunReport] = {}
        self._makers: dict[str, Callable[[], DataFrame]] = {}
        self._fresh: set[str] = set()
        self._busy: list[str] = []

    def dataset(self, maker: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        """Decorator: the function's name is the dataset's name."""
        self._makers[maker.__name__] = maker
        return maker

    def refresh(self, name: str) -> DataFrame:
        """Bring the dataset and all it reads up to date, each of them once."""
        self._fresh.clear()
        self._build(name)
        return self.table(name)

    def read_stream(self, name: str, limits: bool = True) -> DataFrame:
        """Another dataset as a stream, inside a dataset function; ``limits=False`` in front of a watermark."""
        self._build(name)
        return read_stream(self.spark, self._data(name), limits=limits)

    def table(self, name: str) -> DataFrame:
        """The stored dataset, also registered under its name for SQL."""
        self.spark.read.parquet(self._data(name)).createOrReplaceTempView(name)
        return self.spark.table(name)

    def _data(self, name: str) -> str:
        return f"{self.root}/{name}/data"

    def _build(self, name: str) -> None:
        if name in self._fresh:
            return
        if name in self._busy:
            raise ValueError(f"datasets read each other: {' -> '.join([*self._busy, name])}")
        self._busy.append(name)
        try:
            self.reports[name] = run_stream(
                self._makers[name](), path=self._data(name),
                checkpoint=f"{self.root}/{name}/checkpoint", name=name,
            )
        finally:
            self._busy.pop()
        self._fresh.add(name)
