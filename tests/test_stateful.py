import random
from collections import Counter
from datetime import datetime
from pathlib import Path

import pandas as pd

from streamweir.sources.streams import read_stream
from streamweir.streaming.run import run_stream
from streamweir.streaming.stateful import _KeepNewest, stateful_join, tagged_union
from tests.helpers import START, at, bag, instants, land_ordered

SHOWN = "adId INT, impressionTime TIMESTAMP"
CLICKED = "adId INT, clickTime TIMESTAMP"


def run(spark, folder, batches):
    """Each batch: (impressions, clicks) as (key, seconds)."""
    def frames(part, ddl):
        return [instants(spark, [(k, at(s)) for k, s in b[part]], ddl) for b in batches]

    land_ordered(frames(0, SHOWN), f"{folder}/shown")
    land_ordered(frames(1, CLICKED), f"{folder}/clicked")
    shown = read_stream(spark, f"{folder}/shown", max_files=1)
    clicked = read_stream(spark, f"{folder}/clicked", max_files=1)
    union = tagged_union(shown, clicked, "adId", "impressionTime", "clickTime")
    report = run_stream(
        stateful_join(union, "adId"), path=f"{folder}/data", checkpoint=f"{folder}/cp", name="state",
        state_partitions=2,
    )
    return bag(spark.read.parquet(f"{folder}/data")), report


def test_union_is_tagged(spark):
    shown = instants(spark, [(1, at(0))], SHOWN)
    clicked = instants(spark, [(1, at(5))], CLICKED)
    union = tagged_union(shown, clicked, "adId", "impressionTime", "clickTime")
    assert union.columns == ["impression", "click", "eventTime", "adId"]
    assert union.where("impression IS NOT NULL AND click IS NULL").count() == 1
    assert union.where("impression IS NULL AND click.adId = 1 AND eventTime = click.clickTime").count() == 1


def test_one_row_per_key_and_batch_with_the_newest_of_each_side(spark, folder):
    got, _ = run(spark, folder, [
        ([(1, 0), (1, 3), (2, 1), (None, 1)], [(1, 4), (1, 2), (3, 1), (None, 1)]),
    ])
    assert got == {(1, at(3), at(4)): 1}


def test_later_batches_see_the_state(spark, folder):
    # batch 0 leaves the watermark at 12:05:00 - 20 s; its own timeout was set from 0, so it
    # survives only where the next batch brings the key again
    got, report = run(spark, folder, [
        ([(1, 300)], [(2, 300)]),
        ([(2, 301)], [(1, 302)]),
        ([(1, 303)], []),
    ])
    assert got == {(1, at(300), at(302)): 1, (2, at(301), at(300)): 1, (1, at(303), at(302)): 1}
    # key 1 was seen at a watermark that the last batch has not moved 20 s past
    assert report.late_rows == 0


def test_later_batch_wins_even_with_an_older_row(spark, folder):
    got, _ = run(spark, folder, [
        ([(1, 310)], [(1, 311)]),
        ([(1, 305)], []),
    ])
    assert got == {(1, at(310), at(311)): 1, (1, at(305), at(311)): 1}


def test_state_times_out_without_a_row(spark, folder):
    got, report = run(spark, folder, [
        ([(1, 0)], [(9, 0)]),
        ([(2, 1000)], []),  # key 1 is absent, the watermark has moved on
        ([], [(1, 1001), (2, 1002)]),
    ])
    assert (2, at(1000), at(1002)) in got
    assert all(key != 1 for key, _, _ in got)


def test_rows_behind_the_watermark_are_dropped(spark, folder):
    got, report = run(spark, folder, [
        ([(1, 1000)], []),
        ([(1, 1001)], []),
        ([], [(1, 900)]),
    ])
    assert got == {} and report.late_rows >= 1


def simulated(batches):
    """Key by key, in plain Python. Times are seconds since START; the watermark begins in 1970."""
    state, watermark, out = {}, -(START - datetime(1970, 1, 1)).total_seconds(), []
    for shown, clicked in [*batches, ([], [])]:
        rows = [(k, s, 0) for k, s in shown] + [(k, s, 1) for k, s in clicked]
        touched = set()
        for key in {k for k, _, _ in rows}:
            newest = [
                max((s for k, s, side in rows if (k, side) == (key, want) and s > watermark), default=None)
                for want in (0, 1)
            ]
            if newest == [None, None]:
                continue
            touched.add(key)
            old = state[key][0] if key in state else [None, None]
            both = [o if n is None else n for n, o in zip(newest, old)]
            state[key] = (both, watermark + 20)
            if None not in both:
                out.append((key, at(both[0]), at(both[1])))
        for key in [k for k, (_, until) in state.items() if k not in touched and until < watermark]:
            del state[key]
        watermark = max([watermark, *[s - 20 for _, s, _ in rows]])
    return Counter(out)


def test_random_batches_against_a_simulation(spark, folder):
    rng = random.Random(11)
    batches, clock = [], 0
    for _ in range(9):
        clock += rng.choice([1, 5, 15, 30, 60])

        def some():
            return [(rng.randrange(6), clock - rng.choice([0, 0, 1, 3, 40])) for _ in range(rng.randrange(4))]

        batches.append((some() + [(99, clock)], some()))
    got, _ = run(spark, folder, batches)
    assert got == simulated(batches) and got.total() > 8


def test_a_batch_writes_the_state_of_its_keys_only(spark, folder):
    """60,000 live keys, then a batch of 20 keys: what the state store writes follows the keys."""
    ids = spark.range(60_000).selectExpr("CAST(id AS INT) AS adId", f"TIMESTAMP '{START}' AS impressionTime")
    some = spark.range(20).selectExpr("CAST(id * 2999 AS INT) AS adId", f"TIMESTAMP '{START}' AS impressionTime")
    land_ordered([ids, some], f"{folder}/shown")
    land_ordered([instants(spark, [], CLICKED), some.withColumnRenamed("impressionTime", "clickTime")], f"{folder}/clicked")
    shown = read_stream(spark, f"{folder}/shown", max_files=1)
    clicked = read_stream(spark, f"{folder}/clicked", max_files=1)
    union = tagged_union(shown, clicked, "adId", "impressionTime", "clickTime")
    # no delay and no time that moves on: nothing expires
    run_stream(stateful_join(union, "adId", timeout_ms=10**13, buckets=128), path=f"{folder}/data", checkpoint=f"{folder}/cp", state_partitions=4)
    assert spark.read.parquet(f"{folder}/data").count() == 20
    written = Counter()
    for path in Path(f"{folder}/cp/state/0").rglob("*.changelog"):
        written[int(path.name.split(".")[0].split("_")[0])] += path.stat().st_size
    first, second = written[1], written[2]
    assert first > 500_000 and second < first / 20


class FakeState:
    """A map and a value state, timers and a clock; counts the calls."""

    def __init__(self):
        self.kept, self.value, self.calls, self.timer, self.now = {}, None, Counter(), None, 0

    def getMapState(self, name, *_):
        return self if name == "newest" else FakeState()

    def getValueState(self, *_):
        return self

    def containsKey(self, key):
        self.calls["contains"] += 1
        return key in self.kept

    def getValue(self, key):
        self.calls["read"] += 1
        return self.kept[key]

    def updateValue(self, key, value):
        self.calls["write"] += 1
        self.kept[key] = value

    def removeKey(self, key):
        self.calls["remove"] += 1
        del self.kept[key]

    def exists(self):
        return bool(self.value)

    def get(self):
        self.calls["due"] += 1
        return self.value

    def update(self, value):
        self.calls["due"] += 1
        self.value = value

    def clear(self):
        self.calls["due"] += 1
        self.value = None

    def registerTimer(self, at):
        self.timer = at

    def getCurrentWatermarkInMs(self):
        return self.now


def test_a_part_costs_a_write_and_a_bucket_one_list_of_times():
    """64 parts of ten keys: written, three keys written again, all but their parts removed unread, then those."""
    state, bucket = FakeState(), _KeepNewest(20)
    bucket.init(state)
    keys = pd.DataFrame({"key": range(640), "part": [k % 64 for k in range(640)], "is_click": False, "at": 1})
    assert list(bucket.handleInputRows(None, iter([keys]), state)) == []
    assert state.calls == {"write": 64, "due": 2} and state.timer == 20
    state.now, state.calls = 10, Counter()
    (pairs,) = bucket.handleInputRows(None, iter([keys[:3].assign(is_click=True, at=2)]), state)
    assert pairs.values.tolist() == [[0, 1, 2], [1, 1, 2], [2, 1, 2]]
    assert state.calls == {"read": 3, "write": 3, "due": 2}
    state.now, state.calls = 25, Counter()
    assert list(bucket.handleExpiredTimer(None, state, None)) == []
    assert state.calls == {"read": 3, "write": 3, "remove": 61, "due": 2} and state.timer == 30
    state.now, state.calls = 31, Counter()
    assert list(bucket.handleExpiredTimer(None, state, None)) == []
    assert state.calls == {"remove": 3, "due": 2} and not state.kept and state.value is None
