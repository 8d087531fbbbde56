import random
import shutil
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from streamweir.operators.bags import bag_difference, bag_union, reconcile
from streamweir.plans import inputs
from streamweir.sources.streams import read_stream
from streamweir.streaming.incremental import ALONE, MATCHED, TAKEN_BACK, IncrementalLeftJoin, _Buckets
from streamweir.streaming.run import drain
from tests.helpers import at, bag, instants

LEFT = "adId LONG, impressionTime TIMESTAMP"
RIGHT = "clickAdId LONG, clickTime TIMESTAMP"
SF = "/root/testdata/sf0.001"


class Followed:
    """A join of two landing folders: each step lands rows and drains them as one batch."""

    def __init__(self, spark, folder, left=LEFT, right=RIGHT, keys=(["adId"], ["clickAdId"]), buckets=4):
        self.spark, self.folder, self.ddl = spark, folder, (left, right)
        self.all = [instants(spark, [], d) for d in self.ddl]
        for name, none in zip("lr", self.all):
            none.write.parquet(f"{folder}/{name}")
        self.keys = keys
        self.join = IncrementalLeftJoin(spark, f"{folder}/join", self.all[0].schema, self.all[1].schema, *keys, buckets)

    def land(self, left, right):
        for n, rows in enumerate((left, right)):
            new = instants(self.spark, rows, self.ddl[n])
            new.coalesce(1).write.mode("append").parquet(f"{self.folder}/{'lr'[n]}")
            self.all[n] = self.all[n].union(new)

    def drain(self):
        return drain(self.join.start(*[read_stream(self.spark, f"{self.folder}/{n}", df.schema) for n, df in zip("lr", self.all)]))[0]

    def step(self, left, right):
        self.land(left, right)
        self.drain()

    def truth(self):
        on = [F.col(a) == F.col(b) for a, b in zip(*self.keys)]
        return self.all[0].join(self.all[1], on, "left")


def rows(seed, n):
    rng = random.Random(seed)
    keys = [1, 1, 1, 2, 3, 4, 5, 6, None]
    made = [(rng.choice(keys), at(rng.randrange(50))) for _ in range(n)]
    return made + made[:3]


def test_equal_to_the_batch_join_after_each_batch(spark, folder):
    kept = Followed(spark, folder)
    assert kept.join.result().isEmpty()
    for left, right in [(rows(1, 12), []), ([], rows(2, 3)), (rows(3, 8), rows(4, 8)), ([], rows(5, 10))]:
        kept.step(left, right)
        truth, result = kept.truth(), kept.join.result()
        assert bag(result) == bag(truth)
        assert bag_difference(truth, result).isEmpty() and bag_difference(result, truth).isEmpty()
        assert reconcile(truth, result).isEmpty()
    kinds = {r.kind for r in kept.join.written().select("kind").distinct().collect()}
    assert kinds == {MATCHED, ALONE, TAKEN_BACK}


def last(folder, number):
    """The files that say that a batch is done: of the query, and of its table."""
    return Path(f"{folder}/join/checkpoint/commits/{number}"), Path(f"{folder}/join/out/_spark_metadata/{number}")


@pytest.mark.parametrize("written", [True, False], ids=["after the table's commit", "before the table's commit"])
def test_a_crash_replays_the_batch(spark, folder, written):
    kept = Followed(spark, folder)
    kept.step(rows(1, 10), rows(2, 4))
    before = bag(kept.join.result())
    kept.step(rows(3, 10), rows(4, 10))
    after = bag(kept.join.result())
    done, table = last(folder, 1)
    for path in [done] if written else [done, table]:
        path.unlink()
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    assert bag(kept.join.result()) == (after if written else before)
    kept.drain()
    assert bag(kept.join.result()) == after == bag(kept.truth())
    kept.step([], rows(6, 5))
    assert bag(kept.join.result()) == bag(kept.truth())


def test_no_batch_opens_a_file_of_an_earlier_one(spark, folder):
    kept = Followed(spark, folder)
    kept.step([(1, at(0)), (2, at(0))], [(3, at(0))])
    old = [p for n in ("l", "r", "join/out") for p in Path(f"{folder}/{n}").rglob("*.parquet")]
    kept.land([(3, at(1))], [(1, at(5))])
    shutil.copytree(folder, f"{folder}-copy")
    for path in old:
        path.write_bytes(b"unreadable")
    kept.drain()
    for path in old:
        shutil.copy(f"{folder}-copy/{path.relative_to(folder)}", path)
    assert bag(kept.join.result()) == {(1, at(0), 1, at(5)): 1, (2, at(0), None, None): 1, (3, at(1), 3, at(0)): 1}


def test_each_pair_is_written_once(spark, folder):
    source = inputs.events(spark, SF)
    shown, clicked = inputs.impressions(source), inputs.clicks(source)
    join = IncrementalLeftJoin(spark, f"{folder}/join", shown.schema, clicked.schema, ["adId"], ["clickAdId"])
    slices = inputs.time_slices(source, 4)
    for k in (2, 0, 3, 1):
        slices[k].write.mode("append").parquet(f"{folder}/in")
        stream = read_stream(spark, f"{folder}/in")
        drain(join.start(inputs.impressions(stream), inputs.clicks(stream), name="kept"))
    truth = shown.join(clicked, F.col("adId") == F.col("clickAdId"), "left")
    assert bag(join.result()) == bag(truth)
    written = join.written().groupBy("kind").count().collect()
    counts = {r["kind"]: r["count"] for r in written}
    assert counts[MATCHED] == 2687 and counts.get(TAKEN_BACK, 0) <= counts[ALONE] <= shown.count()


def test_values_come_back_as_they_were(spark, folder):
    left = "k STRING, n LONG, big LONG, x DOUBLE, s STRING, t TIMESTAMP, b BOOLEAN"
    right = "rk STRING, rn LONG, d DOUBLE"
    kept = Followed(spark, folder, left, right, (["k", "n"], ["rk", "rn"]))
    t = at(1).replace(microsecond=123457)
    some = [
        ("a", 1, 2**62 + 1, 0.1 + 0.2, 'q"\\\n ü😀', t, True), ("a", 1, None, None, None, None, None), ("a", None, 5, float("inf"), "", t, False),
        (None, 1, 6, -0.5, "x", t, False), ("a|1", 1, 7, 1e300, "y", t, True),
    ]
    kept.step(some + some[:2], [("a", 2, 1.5), (None, 1, 2.5)])
    assert bag(kept.join.result()) == bag(kept.truth())
    kept.step([], [("a", 1, 1 / 3), ("a", None, None), ("a", 1, 1 / 3)])
    assert bag(kept.join.result()) == bag(kept.truth()) and kept.join.result().count() == 11


def test_names_must_differ_and_types_must_not(spark, folder):
    schema = instants(spark, [], LEFT).schema
    with pytest.raises(ValueError, match="rename"):
        IncrementalLeftJoin(spark, folder, schema, schema, ["adId"], ["adId"])
    with pytest.raises(ValueError, match="one type"):
        IncrementalLeftJoin(spark, folder, schema, instants(spark, [], "i INT").schema, ["adId"], ["i"])


def test_streams_land_side_by_side_with_others(spark, folder):
    """Two joins of the same streams keep their own state."""
    source = inputs.events(spark, SF)
    shown, clicked = inputs.impressions(source), inputs.clicks(source)
    source.write.parquet(f"{folder}/in")
    stream = read_stream(spark, f"{folder}/in")
    joins = [
        IncrementalLeftJoin(spark, f"{folder}/{n}", shown.schema, clicked.schema, ["adId"], ["clickAdId"], n) for n in (1, 7)
    ]
    drain(*[j.start(inputs.impressions(stream), inputs.clicks(stream)) for j in joins])
    assert bag(joins[0].result()) == bag(joins[1].result()) == bag(bag_union(shown.join(clicked, F.col("adId") == F.col("clickAdId"), "left")))


class FakeList:
    """A list state that counts what is passed to it."""

    def __init__(self):
        self.kept = []

    def exists(self):
        return bool(self.kept)

    def get(self):
        return iter(self.kept)

    def appendValue(self, value):
        self.kept.append(value)

    def appendList(self, values):
        self.kept += values


def test_rows_pass_to_the_state_thousands_at_a_time():
    """25,000 left rows, then 3 right rows: some entries, and the pairs of the keys asked for."""
    bucket = _Buckets()
    bucket.left, bucket.right = FakeList(), FakeList()
    shown = pd.DataFrame({"key": [f"k{n}" for n in range(25_000)], "row": [f"shown {n}" for n in range(25_000)], "is_left": True})
    (alone,) = bucket.handleInputRows(None, iter([shown[:20_000], shown[20_000:]]), None)
    assert len(alone) == 25_000 and set(alone["kind"]) == {ALONE}
    assert 1 <= len(bucket.left.kept) < 10 and not bucket.right.kept
    clicked = pd.DataFrame({"key": ["k7", "k24999", "none"], "row": ["a", "b", "c"], "is_left": False})
    matched, back = bucket.handleInputRows(None, iter([clicked]), None)
    assert sorted(zip(matched["left"], matched["right"])) == [("shown 24999", "b"), ("shown 7", "a")]
    assert sorted(back["left"]) == ["shown 24999", "shown 7"] and set(back["kind"]) == {TAKEN_BACK}
    assert len(bucket.right.kept) == 1
