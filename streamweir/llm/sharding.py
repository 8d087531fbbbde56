"""Shards of near-equal bytes by sampled splitters.

A sample in which large documents are more likely gives the quantiles of a key; they cut
the keys into many small ranges, whose exact sizes are then counted. Ranges that came out
too full are sampled and cut again. Consecutive ranges make up the shards. DataFrame
functions only; what reaches the driver are the sample and one row per range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from streamweir.llm.tables import Workspace, packed, quoted, unpacked

SMALLEST = -(1 << 63)


@dataclass(frozen=True)
class Plan:
    """Ranges ``i`` of keys from ``cuts[i - 1]`` up to ``cuts[i]``, their rows and bytes."""

    cuts: list[tuple[int, int]]
    rows: dict[int, int]
    sizes: dict[int, int]


def range_of(key: Column, tie: Column, cuts: list[tuple[int, int]]) -> Column:
    """How many cuts are at or below (key, tie): a binary search over the cuts as literals."""
    if not cuts:
        return F.lit(0)
    depth = len(cuts).bit_length()
    keys, ties = F.lit([k for k, _ in cuts]), F.lit([t for _, t in cuts])

    def step(at: Column, jump: Column) -> Column:
        k, t = F.get(keys, at + jump - 1), F.get(ties, at + jump - 1)  # null beyond the last cut
        return at + F.when((k < key) | ((k == key) & (t <= tie)), jump).otherwise(0)

    return F.reduce(F.lit([1 << b for b in reversed(range(depth))]), F.lit(0), step)


def counted(rows: DataFrame, cuts: list[tuple[int, int]]) -> Plan:
    found = rows.groupBy(range_of(F.col("key"), F.col("tie"), cuts).alias("range")).agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
    return Plan(cuts, {r["range"]: r["n"] for r in found}, {r["range"]: r["size"] for r in found})


def sampled(rows: DataFrame, n: int, total_rows: int, total_size: int) -> list[tuple[int, int, float]]:
    """About ``sample`` keys in order with the weight each stands for; a row is drawn by its share of bytes and rows."""
    weight = (F.col("size") / F.lit(float(max(1, total_size))) + F.lit(1.0 / max(1, total_rows))) / 2
    draw = F.pmod(F.xxhash64("key", "tie", F.lit("splitters")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    drawn = rows.select("key", "tie", weight.alias("weight"), draw.alias("draw")).where(F.col("draw") < F.col("weight") * n)
    return sorted((r["key"], r["tie"], max(r["weight"], 1.0 / n)) for r in drawn.select("key", "tie", "weight").collect())


def quantiles(sample: list[tuple[int, int, float]], parts: int, whole: float) -> list[tuple[int, int]]:
    """Cuts between ``parts`` ranges of equal weight.

    A cut goes in front of all rows of its key, unless the key has more than the share
    ``whole`` of the weight: then its rows are cut by their ties, and nothing else is in those ranges.
    """
    total = sum(w for *_, w in sample)
    heavy: dict[int, float] = {}
    for key, _, w in sample:
        heavy[key] = heavy.get(key, 0.0) + w
    cuts, seen, step = set(), 0.0, total / parts if parts else 0.0
    due = step
    for key, tie, w in sample:
        if heavy[key] > whole * total:
            cuts |= {(key, SMALLEST), (min(key + 1, -(SMALLEST + 1)), SMALLEST)}
        if seen + w > due:
            cuts.add((key, tie) if heavy[key] > whole * total else (key, SMALLEST))
            due = step * (int((seen + w) / step) + 1)
        seen += w
    return sorted(cuts)


def planned(rows: DataFrame, n_shards: int, ranges: int, sample: int, whole: float) -> Plan:
    """Cuts such that no range has over four times its share, unless it is a single key that stays whole."""
    total = rows.agg(F.count("*").alias("n"), F.sum("size").alias("size")).first()
    n, size = total["n"], total["size"] or 0
    if not n:
        return Plan([], {}, {})
    cuts = quantiles(sampled(rows, sample, n, size), ranges, whole / n_shards)
    plan = counted(rows, cuts)
    while True:
        share = max(4 / ranges, 2 * whole / n_shards)
        over = [r for r in plan.rows if plan.rows[r] > share * n + 1 or plan.sizes[r] > share * size + 1]
        if not over:
            return plan
        inside = rows.where(range_of(F.col("key"), F.col("tie"), plan.cuts).isin(over))
        n_in, size_in = sum(plan.rows[r] for r in over), sum(plan.sizes[r] for r in over)
        parts = min(ranges, int(ranges * max(n_in / n, size_in / max(1, size))) + 2 * len(over))
        more = sorted({*plan.cuts, *quantiles(sampled(inside, sample, n_in, size_in), parts, 1 / parts)})
        if more == plan.cuts:
            return plan  # equal rows only: no key can part them
        plan = counted(rows, more)


def shards_of_ranges(plan: Plan, n_shards: int, whole: float) -> list[int]:
    """The shard of each range by the middle of its bytes. Ranges of one key that has at most ``whole`` of a shard go together."""
    n, total = len(plan.cuts) + 1, sum(plan.sizes.values())
    starts, ends = [None, *plan.cuts], [*plan.cuts, None]
    # a range that ends with the key it starts in, or before, has rows of that key only
    keys = [s[0] if s and e and e <= (s[0] + 1, SMALLEST) else None for s, e in zip(starts, ends)]
    of_key: dict[int, int] = {}
    for r, key in enumerate(keys):
        if key is not None:
            of_key[key] = of_key.get(key, 0) + plan.sizes.get(r, 0)
    shards, before, done = [], 0, {}
    for r, key in enumerate(keys):
        together = key is not None and of_key[key] * n_shards <= whole * total
        size = of_key[key] if together else plan.sizes.get(r, 0)
        shard = min(n_shards - 1, int(n_shards * (before + size / 2) / total)) if total else 0
        shards.append(done.setdefault(key, shard) if together else shard)
        before += plan.sizes.get(r, 0)
    return shards


def sharded(
    docs: DataFrame, size: Column, n_shards: int = 8, key: Column | None = None, tie: Column | None = None,
    ranges: int = 1024, sample: int = 8192, whole: float = 0.05, text: str = "text", id: str = "doc_id",
) -> DataFrame:
    """The columns plus ``shard`` (0 up to ``n_shards``) and ``slot`` (from 0, without gaps in a shard).

    Shards hold near-equal sums of ``size`` (any LONG of one or more): they differ by the share
    of a range, or by one row if rows are larger. Rows of one key (default: the hash of the
    text) stay in one shard unless they have more than ``whole`` of a shard's size; then they are cut by
    ``tie`` (default: the id). Many small rows of one key are several ranges of one shard. Null keys and ties are hashed like values. Rows equal in key and tie
    cannot be parted. The sample's expected size is ``sample``, whatever the input. Columns named
    like a result give way to it. An empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "sharding")
    key = F.xxhash64(quoted(text)) if key is None else key
    tie = F.coalesce(quoted(id).cast("long"), F.xxhash64(quoted(id).cast("string"))) if tie is None else tie
    rows = packed(docs, key=key, tie=tie, size=size)
    keys = work.keep(rows.select("key", "tie", "size"))
    plan = planned(keys, n_shards, ranges, sample, whole)
    shard_of, slots, in_shard = shards_of_ranges(plan, n_shards, whole), [], {}
    for r, shard in enumerate(shard_of):
        slots.append(in_shard.get(shard, 0))
        in_shard[shard] = slots[-1] + plan.rows.get(r, 0)
    placed = rows.withColumn("range", range_of(F.col("key"), F.col("tie"), plan.cuts))
    place = F.row_number().over(Window.partitionBy("range").orderBy("key", "tie")) - 1
    # columns from the window on: the range's first slot, plus the row's place in its range
    numbered = placed.withColumn("place", place)
    at = F.col("range") + 1
    return unpacked(
        numbered, docs.columns, F.element_at(F.lit(shard_of), at).alias("shard"),
        (F.element_at(F.lit(slots), at) + F.col("place")).cast("long").alias("slot"), names=["shard", "slot"],
    )
