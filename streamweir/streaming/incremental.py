"""A left join of two growing tables, kept up to date.

The result equals the batch left join of everything read so far, as a bag. Both sides are kept in
state, as one list per side and bucket of keys, to which a batch appends its rows. Each change is
written once, in the batch that brought its cause:

    new left  JOIN  all right       pairs; a left row without a partner so far is written alone
    old left  JOIN  new right       pairs; a left row that was alone until now is taken back

The reader nets what was written alone against what was taken back. A batch opens no file of
earlier batches: it reads the buckets that its keys fall into from the state store, and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from streamweir.streaming.run import start_stream, state_partitions_for

MATCHED, ALONE, TAKEN_BACK = "matched", "alone", "taken back"

# rows pass Python as text, which keeps whole numbers with nulls among them, and times to the microsecond
_AS_TEXT = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_STATE = "rows BINARY"  # Arrow tables of key and row
_TOGETHER = 10_000  # rows in one of them
_CHANGES = "kind STRING, left STRING, right STRING"


class _Buckets(StatefulProcessor):
    """One bucket of keys: the rows of both sides so far, in a list each, thousands to an entry.

    An entry passes between Python and the state store at a cost of its own, so rows are not entries.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.left = handle.getListState("left", _STATE)
        self.right = handle.getListState("right", _STATE)

    @staticmethod
    def _stored(entries, keys: set) -> pd.DataFrame:
        """What a list has of some keys; a list is read through once and never held whole."""
        wanted, found = pa.array(keys, pa.string()), [pd.DataFrame({"key": [], "row": []}, dtype=object)]
        for (entry,) in entries.get() if keys and entries.exists() else ():
            table = pa.ipc.open_stream(entry).read_all()
            own = table.filter(pc.is_in(table["key"], wanted))
            if own.num_rows:
                found.append(own.to_pandas())
        return pd.concat(found)

    @staticmethod
    def _packed(rows: pd.DataFrame) -> Iterator[tuple[bytes]]:
        for start in range(0, len(rows), _TOGETHER):
            some = rows.iloc[start : start + _TOGETHER]
            batch = pa.RecordBatch.from_arrays([pa.array(some[c], pa.string()) for c in ("key", "row")], ["key", "row"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            yield (sink.getvalue().to_pybytes(),)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        left, right = (new.loc[new["is_left"] == side, ["key", "row"]] for side in (True, False))
        left_keys, right_keys = set(left["key"]), set(right["key"])
        old_right = self._stored(self.right, left_keys | right_keys)
        old_left = self._stored(self.left, right_keys)
        known = set(old_right["key"])

        fresh = left.merge(pd.concat([old_right, right]), on="key", suffixes=("", "_right"))
        late = old_left.merge(right, on="key", suffixes=("", "_right"))
        alone = left[~left["key"].isin(known | right_keys)]
        back = old_left[~old_left["key"].isin(known)]
        for kind, changed in ((MATCHED, fresh), (MATCHED, late), (ALONE, alone), (TAKEN_BACK, back)):
            if len(changed):
                partner = changed["row_right"] if kind == MATCHED else None
                yield pd.DataFrame({"kind": kind, "left": changed["row"], "right": partner})

        for stored, added in ((self.left, left), (self.right, right)):
            if len(added):
                for entry in self._packed(added):
                    stored.appendValue(entry)

    def close(self) -> None:
        pass


class IncrementalLeftJoin:
    """``left_keys`` and ``right_keys`` pair up by position and have equal types; all columns need distinct names.

    Aim at some thousand rows per bucket and side; ``buckets`` is fixed by the first start, like the
    state's partitions. The default is 16 for each of those. Keys with a null part match nothing: such
    left rows are written alone at once and are in no state.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        left_schema: StructType,
        right_schema: StructType,
        left_keys: list[str],
        right_keys: list[str],
        buckets: int | None = None,
    ):
        shared = set(left_schema.names) & set(right_schema.names)
        if shared:
            raise ValueError(f"rename before joining, both sides have {sorted(shared)}")
        for a, b in zip(left_keys, right_keys, strict=True):
            if left_schema[a].dataType != right_schema[b].dataType:
                raise ValueError(f"keys of one type only: {a} is not of the type of {b}")
        self.spark = spark
        self.path = path
        self.left = left_schema
        self.right = right_schema
        self.left_keys = left_keys
        self.right_keys = right_keys
        self.buckets = buckets or 16 * state_partitions_for(spark)

    def _side(self, rows: DataFrame, schema: StructType, keys: list[str], is_left: bool) -> DataFrame:
        none = F.lit(False)
        for k in keys:
            none = none | F.col(k).isNull()
        key = F.when(~none, F.to_json(F.struct(*[F.col(k).alias(f"k{n}") for n, k in enumerate(keys)]), _AS_TEXT))
        return rows.select(
            F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int").alias("bucket"), key.alias("key"),
            F.lit(is_left).alias("is_left"), F.to_json(F.struct(*schema.names), _AS_TEXT).alias("row"),
        )

    def changes(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """``kind`` and the columns of both sides: what the rows of a batch add to the join, or take back."""
        shown = self._side(left, self.left, self.left_keys, True)
        clicked = self._side(right, self.right, self.right_keys, False)
        keyed = shown.where("key IS NOT NULL").unionByName(clicked.where("key IS NOT NULL"))
        changed = keyed.groupBy("bucket").transformWithStateInPandas(_Buckets(), _CHANGES, "Append", "None")
        keyless = shown.where("key IS NULL").select(F.lit(ALONE).alias("kind"), F.col("row").alias("left"), F.lit(None).cast("string").alias("right"))
        all = changed.unionByName(keyless)
        return all.select("kind", self._read("left", self.left).alias("l"), self._read("right", self.right).alias("r")).select("kind", "l.*", "r.*")

    @staticmethod
    def _read(text: str, schema: StructType) -> Column:
        return F.from_json(text, schema, _AS_TEXT)

    def start(self, left: DataFrame, right: DataFrame, name: str | None = None, drain: bool = True) -> StreamingQuery:
        """Follow both streams; a stopped query goes on from its checkpoint. A replayed batch counts once."""
        return start_stream(
            self.changes(left, right), checkpoint=f"{self.path}/checkpoint", path=f"{self.path}/out", name=name, drain=drain,
            partition_by=["kind"],
        )

    def written(self) -> DataFrame:
        """All changes of the committed batches."""
        schema = StructType([*self.left.fields, *self.right.fields]).add("kind", "string")
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/out")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)  # before the first batch

    def result(self) -> DataFrame:
        """The join as of the last committed batch."""
        written = self.written()
        matched = written.where(F.col("kind") == MATCHED).select(*self.left.names, *self.right.names)
        count = F.sum(F.when(F.col("kind") == ALONE, 1).otherwise(-1))
        alone = written.where(F.col("kind").isin(ALONE, TAKEN_BACK)).groupBy(*self.left.names).agg(count.alias("n_rows_alone"))
        each = alone.where("n_rows_alone > 0").withColumn("n_rows_alone", F.explode(F.sequence(F.lit(1), F.col("n_rows_alone").cast("int"))))
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.right.fields]
        return matched.unionByName(each.select(*self.left.names, *nothing))
