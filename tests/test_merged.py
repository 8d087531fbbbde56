import random

import pytest

from streamweir.plans import inputs
from streamweir.plans.queries import WINDOW_KEYS, windowed
from streamweir.sources.streams import read_stream
from streamweir.streaming.merged import CHANGED, MergedSink, merges_in, read_merged, runs_after
from streamweir.streaming.run import run_stream
from tests.helpers import bag, land_ordered

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("fanout", [2, 3, 8])
def test_runs_hold_every_batch_once(fanout):
    written = set()
    for batch in range(300):
        written.add((0, batch))
        for level, number in merges_in(batch, fanout):
            assert {(level - 1, number * fanout + n) for n in range(fanout)} <= written
            written.add((level, number))
        runs = runs_after(batch + 1, fanout)
        assert set(runs) <= written
        held = [b for level, n in runs for b in range(n * fanout**level, (n + 1) * fanout**level)]
        assert held == list(range(batch + 1))
    assert len(runs_after(200)) <= 7 * 3 and runs_after(0) == []


def test_many_batches_are_a_few_files(spark, folder):
    """Every batch changes some of 40 keys, nulls among keys and values."""
    rng, sink, want = random.Random(3), MergedSink(folder, ["k", "l"], 3), {}
    for batch in range(28):
        rows = {(rng.choice([None, *range(9)]), rng.choice(["a", "b", None])): rng.choice([None, batch]) for _ in range(6)}
        if batch == 11:
            rows = {}
        want.update(rows)
        df = spark.createDataFrame([(*k, v) for k, v in rows.items()], "k LONG, l STRING, v LONG").coalesce(1)
        sink(df, batch)
        if batch % 9 == 4:
            sink(df, batch)  # a replay
        if batch in (0, 2, 8, 20, 27):
            got = read_merged(spark, folder, ["k", "l"])
            assert got.columns == ["k", "l", "v"] and bag(got) == {(*k, v): 1 for k, v in want.items()}
    # 28 is 1001 to the base 3: one run of 27 batches, one of one
    files = read_merged(spark, folder, ["k", "l"]).inputFiles()
    assert {f.split("/runs/")[1].rsplit("/", 1)[0] for f in files} == {"level=3/run=0", "level=0/run=27"}
    assert spark.read.parquet(f"{folder}/commits").count() == 2


def test_a_batch_that_died_before_its_commit_is_not_read(spark, folder):
    sink = MergedSink(folder, ["k"], 2)
    for batch, value in enumerate([1, 2, 3]):
        sink(spark.sql(f"SELECT 'a' AS k, {value} AS v"), batch)
    # batch 3 wrote its change and its merges and no more
    late = spark.sql(f"SELECT 'a' AS k, 9 AS v, 3L AS {CHANGED}")
    for run in ("level=0/run=3", "level=1/run=1", "level=2/run=0"):
        late.write.parquet(f"{folder}/runs/{run}")
    assert bag(read_merged(spark, folder, ["k"])) == {("a", 3): 1}
    sink(spark.sql("SELECT 'a' AS k, 4 AS v"), 3)
    assert bag(read_merged(spark, folder, ["k"])) == {("a", 4): 1}


def test_names_and_fanout(spark, folder):
    with pytest.raises(ValueError, match="rename"):
        MergedSink(folder, ["k"])(spark.sql(f"SELECT 1 AS k, 2 AS {CHANGED}"), 0)
    with pytest.raises(ValueError, match="at least 2"):
        MergedSink(folder, ["k"], 1)


def test_update_mode_over_eight_batches(spark, folder):
    land_ordered(inputs.time_slices(inputs.events(spark, SF), 8), f"{folder}/landing")
    sums = windowed(inputs.cdc(read_stream(spark, f"{folder}/landing", max_files=1)), "30 minutes")
    run_stream(sums, mode="update", checkpoint=f"{folder}/cp", each_batch=MergedSink(folder, WINDOW_KEYS, 3))
    truth = windowed(inputs.cdc(inputs.events(spark, SF)), "30 minutes")
    assert bag(read_merged(spark, folder, WINDOW_KEYS)) == bag(truth)
