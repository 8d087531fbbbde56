"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from streamweir.llm.tables import Workspace


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the node's smallest neighbour."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    rest = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b"))).distinct()


def roots(links: DataFrame, work: Workspace) -> DataFrame:
    """``node, root`` for every linked node that is not the smallest of its component.

    ``links`` has two LONG columns ``a`` and ``b``. Alternates large and small stars
    until nothing changes. A node's smallest neighbour is found by partial minima and
    joined back, so the links of a hub are spread over tasks. Links with a null end or
    from a node to itself say nothing and are ignored; no links give no rows.
    """
    now = work.keep(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before, state = None, _state(now)
    while state[0] and state != before:
        now = work.keep(_small_star(_large_star(now)))
        before, state = state, _state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
