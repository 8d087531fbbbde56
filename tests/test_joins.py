import random
from datetime import timedelta

import pytest
from pyspark.sql.types import StructType
from pyspark.sql import functions as F

from streamweir.operators import joins, skew
from streamweir.plans import inputs
from streamweir.sources.streams import read_stream
from streamweir.streaming.run import drain_to_table, run_stream
from streamweir.streaming.static_join import RefreshedStaticJoin
from tests.helpers import at, bag, instants, interval_pairs, land_ordered

HORIZON = timedelta(seconds=60)
LEFT = "adId LONG, impressionTime TIMESTAMP"
RIGHT = "clickAdId LONG, clickTime TIMESTAMP"


def some_rows(seed: int, n: int) -> list[tuple]:
    """A third of the rows on key 1, copies, missing keys and times, exact bounds, times before 1970."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        key = 1 if rng.random() < 0.34 else rng.choice([2, 3, 4, 5, None])
        seconds = rng.choice([rng.uniform(0, 600), 60.0 * rng.randrange(10), -1_800_000_000 + rng.randrange(200)])
        rows.append((key, None if rng.random() < 0.05 else at(round(seconds, 6))))
    return rows + rows[:10]


def sides(spark, n=150):
    left, right = some_rows(1, n), some_rows(2, n)
    return left, right, instants(spark, left, LEFT), instants(spark, right, RIGHT)


def joined(left, right, how="inner", **more):
    return joins.interval_join(
        left, right, "adId", "clickAdId", "impressionTime", "clickTime", HORIZON, how, **more
    )


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("split", [False, True])
def test_interval_join_against_all_pairs(spark, how, split):
    left, right, left_df, right_df = sides(spark)
    hot = skew.hot_keys(left_df, "adId", parts=4) if split else None
    assert bag(joined(left_df, right_df, how, hot=hot)) == interval_pairs(left, right, HORIZON, how)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_equi_join_with_hot_keys(spark, how):
    _, _, left, right = sides(spark)
    hot = skew.hot_keys(left, "adId", parts=4)
    plain = bag(joins.equi_join(left, right, "adId", "clickAdId", how))
    assert plain == bag(joins.equi_join(left, right, "adId", "clickAdId", how, hot, cells=3))
    if how == "inner":
        count = joins.join_count(left, right, "adId", "clickAdId").first()[0]
        assert count == plain.total()


def test_join_count_of_nothing(spark):
    _, _, left, right = sides(spark)
    assert joins.join_count(left.where("false"), right, "adId", "clickAdId").first()[0] == 0


def test_hot_keys_are_few_and_hot(spark):
    rows = spark.range(900).selectExpr("IF(id < 300, 0, id) AS k")
    assert [r[0] for r in skew.hot_keys(rows, "k", parts=10).collect()] == [0]
    assert skew.hot_keys(spark.range(900).selectExpr("id % 9 AS k"), "k", parts=10).count() == 9


def test_a_key_spread_over_time_is_not_hot_within_a_bucket(spark):
    rows = spark.range(900).selectExpr("IF(id < 300, 0, IF(id < 600, 1, id)) AS k", "IF(id < 300, id, 7) AS b")
    assert bag(skew.hot_keys(rows, "k", parts=10)) == {(0,): 1, (1,): 1}
    assert bag(skew.hot_keys(rows, "k", parts=10, within=F.col("b"))) == {(1,): 1}


def test_hot_keys_of_any_type_and_of_nothing(spark):
    rows = spark.range(100).selectExpr("IF(id < 40, NULL, IF(id < 80, 'a', CAST(id AS STRING))) AS k")
    assert bag(skew.hot_keys(rows, "k", parts=4)) == {("a",): 1}
    assert skew.hot_keys(rows.where("false"), "k").count() == 0


def test_a_hot_key_is_dealt_out(spark):
    """A third of the rows on one key, all of them copies: no cell holds more than its part."""
    left = spark.range(30000).selectExpr(
        "IF(id < 10000, 0, IF(id < 15000, NULL, id)) AS adId", "timestamp_seconds(0) AS impressionTime")
    right = spark.range(10).selectExpr("id AS clickAdId", "timestamp_seconds(1) AS clickTime")
    hot = skew.hot_keys(left, "adId", parts=10)
    dealt, repeated, _ = skew.spread(left, right, "adId", "clickAdId", hot, 8)
    sizes = [r["count"] for r in dealt.where("adId = 0").groupBy("left_cell").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.3 * 10000 / 8
    nulls = [r["count"] for r in dealt.where("adId IS NULL").groupBy("left_cell").count().collect()]
    assert len(nulls) == 8 and max(nulls) < 1.3 * 5000 / 8
    assert repeated.where("clickAdId = 0").count() == 8 and repeated.where("clickAdId = 1").count() == 1
    assert joined(left, right, "left", hot=hot).count() == 30000
    assert joined(left, right, hot=hot).where("adId = 0").count() == 10000


def test_a_key_with_a_third_of_every_bucket_is_hot_within(spark):
    rows = spark.range(120_000).selectExpr("IF(id % 100 < 34, 1, id) AS k", "id DIV 1000 AS b")
    assert bag(skew.hot_keys(rows, "k", within=F.col("b"))) == {(1,): 1}


def test_a_burst_in_one_bucket_is_found(spark):
    rows = spark.range(120_000).selectExpr("IF(id BETWEEN 5000 AND 5400, 1, id) AS k", "id DIV 1000 AS b")
    assert skew.hot_keys(rows, "k").count() == 0
    assert bag(skew.hot_keys(rows, "k", within=F.col("b"))) == {(1,): 1}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_key_listed_twice_changes_nothing(spark, how):
    left, right, left_df, right_df = sides(spark)
    hot = spark.createDataFrame([(1,), (1,), (None,), (2,)], "hot_key LONG")
    assert bag(joined(left_df, right_df, how, hot=hot)) == interval_pairs(left, right, HORIZON, how)


def test_an_inner_join_splits_both_sides(spark):
    """80 rows on the left, 80,000 on the right, one key: no cell of the grid holds more than its part."""
    left = spark.range(80).selectExpr("0 AS adId", "id AS left_id")
    right = spark.range(80_000).selectExpr("0 AS clickAdId", "id AS right_id")
    hot = spark.createDataFrame([(0,)], "hot_key LONG")
    a, b, _ = skew.spread(left, right, "adId", "clickAdId", hot, 8, 8, "left_id", "right_id")
    for side in (a, b):
        row = side.columns[-1]
        cells = side.groupBy(side.columns[-2], row).count().collect()
        assert len(cells) == 64
    sizes = [r["count"] for r in b.groupBy("right_cell", "right_row").count().collect()]
    assert max(sizes) < 1.5 * 80_000 / 8
    pairs = joins.equi_join(left, right, "adId", "clickAdId", hot=hot, left_id="left_id", right_id="right_id")
    assert pairs.count() == 80 * 80_000


def test_the_deal_by_an_id_does_not_depend_on_the_order(spark):
    left = spark.range(1000).selectExpr("0 AS adId", "id AS left_id")
    right = spark.range(3).selectExpr("0 AS clickAdId", "id AS right_id")
    hot = spark.createDataFrame([(0,)], "hot_key LONG")
    deals = [
        bag(skew.spread(side, right, "adId", "clickAdId", hot, 8, 1, "left_id")[0].select("left_id", "left_cell"))
        for side in (left, left.orderBy(F.desc("left_id")), left.repartition(7))
    ]
    assert deals[0] == deals[1] == deals[2]


def test_a_count_beyond_long_is_summed(spark):
    a = spark.range(1).selectExpr("4000000000 AS n_left", "4000000000 AS n_right")
    assert a.selectExpr("CAST(n_left AS DECIMAL(19,0)) * CAST(n_right AS DECIMAL(19,0))").first()[0] == 16 * 10**18


def test_pinned_hot_keys_do_not_change(spark, folder):
    path = f"{folder}/hot"
    first = skew.pinned_hot_keys(spark.range(90).selectExpr("IF(id < 30, 0, id) AS k"), "k", path, 10)
    second = skew.pinned_hot_keys(spark.range(90).selectExpr("IF(id < 30, 7, id) AS k"), "k", path, 10)
    assert bag(first) == bag(second) == {(0,): 1}


def test_names_must_differ(spark):
    _, _, left, _ = sides(spark, 5)
    with pytest.raises(ValueError, match="rename"):
        joins.equi_join(left, left, "adId", "adId")
    with pytest.raises(ValueError, match="inner or left"):
        joins.equi_join(left, left.toDF("a", "b"), "adId", "a", "full")


def test_two_streams_need_delays(spark, folder):
    _, _, left, right = sides(spark, 5)
    left.write.parquet(f"{folder}/l")
    right.write.parquet(f"{folder}/r")
    with pytest.raises(ValueError, match="watermark"):
        joined(read_stream(spark, f"{folder}/l"), read_stream(spark, f"{folder}/r"), left_delay="10 seconds")


SF = "/root/testdata/sf0.001"


def quarters(spark, folder):
    """The events in time order, four files, one per micro-batch."""
    land_ordered(inputs.time_slices(inputs.events(spark, SF), 4), f"{folder}/landing")
    return read_stream(spark, f"{folder}/landing", max_files=1)


@pytest.mark.parametrize("how, rows", [("inner", 25), ("left", 187)])
def test_four_batches_give_what_one_gives(spark, folder, how, rows):
    stream = quarters(spark, folder)
    pairs = joins.interval_join(
        inputs.impressions(stream), inputs.clicks(stream), "adId", "clickAdId", "impressionTime",
        "clickTime", timedelta(hours=6), how, "10 seconds", "20 seconds",
        hot=skew.hot_keys(inputs.events(spark, SF), "user_id"),
    )
    report = run_stream(pairs, path=f"{folder}/data", checkpoint=f"{folder}/cp", name=f"four_{how}")
    got = spark.read.parquet(f"{folder}/data")
    assert got.count() == rows
    assert report.batches == [0, 1, 2, 3, 4] and report.late_rows == 0
    # the watermark has let go of everything but the last horizon; an inner join's grid has left rows once per cell too
    assert report.state_rows < (30 if how == "left" else 60)


def test_unbounded_join_over_four_batches(spark, folder):
    stream = quarters(spark, folder)
    hot = skew.hot_keys(inputs.events(spark, SF), "user_id")
    assert hot.count() == 15  # all users: every pair goes through the grid
    pairs = joins.equi_join(
        inputs.impressions(stream), inputs.clicks(stream), "adId", "clickAdId", hot=hot, cells=3
    )
    report = run_stream(pairs, path=f"{folder}/data", checkpoint=f"{folder}/cp")
    source = inputs.events(spark, SF)
    truth = joins.equi_join(inputs.impressions(source), inputs.clicks(source), "adId", "clickAdId")
    assert bag(spark.read.parquet(f"{folder}/data")) == bag(truth)
    sides = source.where("event_type IN ('view', 'click')").count()
    assert report.state_rows == 3 * sides  # nothing ever leaves, each row is there once per cell of its side


def test_streams_restart_from_the_checkpoint(spark, folder):
    for part in inputs.time_slices(inputs.events(spark, SF), 4):
        part.write.mode("append").parquet(f"{folder}/landing")
        stream = read_stream(spark, f"{folder}/landing")
        pairs = joins.interval_join(
            inputs.impressions(stream), inputs.clicks(stream), "adId", "clickAdId", "impressionTime",
            "clickTime", timedelta(hours=6), "left", "10 seconds", "20 seconds",
        )
        got = drain_to_table(pairs, f"{folder}/run")
    assert got.count() == 187


def test_refreshed_static_side_sees_new_files(spark, folder):
    left, right, left_df, right_df = sides(spark)
    early = [r for r in right if r[0] == 1]
    late = [r for r in right if r[0] != 1]
    left_df.write.parquet(f"{folder}/left")
    instants(spark, early, RIGHT).write.parquet(f"{folder}/clicks")
    step = RefreshedStaticJoin(
        f"{folder}/clicks", f"{folder}/out", ["clickAdId", "clickTime"], "adId", "clickAdId",
        "impressionTime", "clickTime", HORIZON,
    )
    stream = read_stream(spark, f"{folder}/left", LEFT)
    instants(spark, late, RIGHT).write.mode("append").parquet(f"{folder}/clicks")
    run_stream(stream, checkpoint=f"{folder}/cp", each_batch=step)
    schema = StructType([*left_df.schema.fields, *right_df.schema.fields])
    assert bag(step.result(spark, schema)) == interval_pairs(left, right, HORIZON, "inner")
    # a batch that was written and not committed is not read
    right_df.crossJoin(left_df).select(*schema.names).limit(5).write.parquet(f"{folder}/out/data/batch_id=99")
    assert bag(step.result(spark, schema)) == interval_pairs(left, right, HORIZON, "inner")


def test_matched_only(spark):
    left, right, left_df, right_df = sides(spark)
    kept = joins.matched_only(joined(left_df, right_df, "left"), "clickTime")
    assert bag(kept) == interval_pairs(left, right, HORIZON, "inner")


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("cells", [2, 5])
def test_a_left_join_with_a_split_right_side(spark, split, cells):
    """Copies of lone and of paired rows, keys without partners, missing keys and times."""
    left, right, left_df, right_df = sides(spark)
    lone = [(7, at(5.0))] * 3 + [(7, at(6.0))]
    left, left_df = left + lone, left_df.union(instants(spark, lone, LEFT))
    hot_right = spark.createDataFrame([(1,), (1,), (2,), (7,), (None,)], "hot_key LONG")
    hot = spark.createDataFrame([(1,), (3,)], "hot_key LONG") if split else None
    got = joined(left_df, right_df, "left", hot=hot, hot_right=hot_right, cells=cells)
    assert got.columns == ["adId", "impressionTime", "clickAdId", "clickTime"]
    assert bag(got) == interval_pairs(left, right, HORIZON, "left")
    none = joined(left_df, right_df, "left", hot_right=hot_right.limit(0))
    assert bag(none) == interval_pairs(left, right, HORIZON, "left")
    nobody = joined(left_df, right_df.limit(0), "left", hot_right=hot_right)
    assert bag(nobody) == interval_pairs(left, [], HORIZON, "left")


def test_a_left_join_splits_a_hot_right_side(spark):
    """80,000 right rows on one key within one horizon: no cell has over 1.5 times its share."""
    left = spark.range(40).selectExpr("0 AS adId", "id AS left_id")
    right = spark.range(80_000).selectExpr("0 AS clickAdId", "id AS right_id")
    hot = spark.createDataFrame([(0,)], "hot_key LONG")
    spread_left, spread_right, _ = skew.spread(left, right, "adId", "clickAdId", hot, 4, 4, "left_id", "right_id")
    per_cell = [r["count"] for r in spread_right.groupBy("right_cell", "right_row").count().collect()]
    assert len(per_cell) == 16 and max(per_cell) < 1.5 * 80_000 / 4
    pairs = skew.left_over_grid(
        left.withColumn("x", F.col("left_id") % 2), right, "adId", "clickAdId",
        (F.col("adId") == F.col("clickAdId")) & (F.col("x") == 0), hot, 4, "left_id", "right_id",
    )
    # pairs of one left row are spread over the tasks of the last step as well
    shares = [r["count"] for r in pairs.where("right_id IS NOT NULL").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == 20 * 80_000 and max(shares) < 1.5 * sum(shares) / len(shares)
    assert pairs.where("right_id IS NULL").count() == 20


def test_a_split_right_side_over_four_batches(spark, folder):
    """Lone rows leave the cells in the same micro-batch; a restart in between changes nothing."""
    hot_right = skew.hot_keys(inputs.events(spark, SF), "user_id").limit(9)
    land_ordered(inputs.time_slices(inputs.events(spark, SF), 4), f"{folder}/landing")

    def pairs(df, **delays):
        return joins.interval_join(
            inputs.impressions(df), inputs.clicks(df), "adId", "clickAdId", "impressionTime", "clickTime",
            timedelta(hours=6), "left", hot_right=listed, cells=3, **delays,
        )

    hot_right.write.parquet(f"{folder}/hot")
    listed = spark.read.parquet(f"{folder}/hot")
    stream = read_stream(spark, f"{folder}/landing", max_files=1)
    delays = {"left_delay": "10 seconds", "right_delay": "20 seconds"}
    report = run_stream(pairs(stream, **delays), path=f"{folder}/data", checkpoint=f"{folder}/cp")
    got = spark.read.parquet(f"{folder}/data")
    assert got.count() == 187 and report.late_rows == 0 and report.state_rows < 60
    truth = bag(pairs(inputs.events(spark, SF)))
    assert not bag(got) - truth
    # held back are the impressions of the last horizon only
    assert all(row[3] is None for row in truth - bag(got))
