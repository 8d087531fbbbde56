import random

import pytest

from streamweir.operators import bags
from tests.helpers import bag


def frame(spark, rows):
    return spark.createDataFrame(rows, "k INT, v STRING")


def test_union_keeps_copies_and_goes_by_name(spark):
    a = frame(spark, [(1, "a"), (1, "a")])
    assert bags.bag_union(a, a.select("v", "k"), a).count() == 6


def test_one_missing_and_one_doubled_row(spark):
    truth = frame(spark, [(1, "a"), (2, "b"), (2, "b"), (3, None)])
    result = frame(spark, [(1, "a"), (1, "a"), (2, "b"), (3, None)])
    assert [tuple(r) for r in bags.bag_difference(truth, result).collect()] == [(2, "b")]
    assert [tuple(r) for r in bags.bag_difference(result, truth).collect()] == [(1, "a")]
    both = {tuple(r) for r in bags.reconcile(truth, result).collect()}
    assert both == {(2, "b", 1, 0), (1, "a", 0, 1)}


def test_equal_bags_leave_nothing(spark):
    rows = frame(spark, [(1, None), (1, None), (None, "x")])
    assert bags.reconcile(rows, rows.select("v", "k")).isEmpty()
    tallied = bags.tally(rows, rows).collect()
    assert sum(r.n_truth for r in tallied) == sum(r.n_result for r in tallied) == 3


def some_bag(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.choice([0.0, None, 1.5])) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "k LONG, l STRING, x DOUBLE")


@pytest.mark.parametrize("buckets", [1, 3, 4096])
def test_reconcile_by_hashes_is_reconcile(spark, buckets):
    """Nulls that change places, copies, rows on one side only, empty sides."""
    _, a = some_bag(spark, 1)
    _, b = some_bag(spark, 2)
    moved = spark.createDataFrame([(1, None, None), (None, "1", None)], "k LONG, l STRING, x DOUBLE")
    for truth, result in [(a, b), (a, a.limit(0)), (a.limit(0), b), (a, a.union(a)), (a.union(moved.limit(1)), a.union(moved.offset(1)))]:
        want = bag(bags.reconcile(truth, result))
        assert want and bag(bags.reconcile_hashed(truth, result, buckets)) == want


def test_equal_bags_differ_in_no_bucket(spark):
    rows, a = some_bag(spark, 1)
    shuffled = spark.createDataFrame(random.Random(5).sample(rows, len(rows)), a.schema).repartition(5)
    assert bags.differing_buckets(a, shuffled.select("x", "k", "l")) == []
    same = bags.reconcile_hashed(a, shuffled)
    assert same.columns == ["k", "l", "x", "n_missing", "n_surplus"] and same.count() == 0
    # the rows of neither side are looked at again
    assert "LocalTableScan <empty>" in same._jdf.queryExecution().optimizedPlan().toString() or "LocalRelation <empty>" in same._jdf.queryExecution().optimizedPlan().toString()


def test_one_changed_row_is_one_bucket_of_many(spark):
    a = spark.range(20_000).selectExpr("id", "CAST(id AS STRING) AS text")
    b = a.where("id <> 777").union(spark.sql("SELECT 777L AS id, 'other' AS text"))
    assert len(bags.differing_buckets(a, b)) == 2
    assert bag(bags.reconcile_hashed(a, b)) == {(777, "777", 1, 0): 1, (777, "other", 0, 1): 1}
