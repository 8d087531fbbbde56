"""Mixing sources to target weights by nested hash thresholds.

Every document has a fixed place on a hash line. A source takes whole rounds of its
documents and, for the rest of its target, the documents up to a threshold on the line.
The threshold is found from sums by hash bucket; only the bucket in which the budget ends
is looked into further. No documents are sorted, and a larger budget takes a superset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from streamweir.llm.tables import Workspace, packed, quoted, unpacked
from streamweir.llm.words import split_words

KEY_BITS, BUCKET_BITS = 60, 12


def place(*columns: Column) -> Column:
    """A number of 60 bits from the digits of an MD5 over the columns (null: empty)."""
    joined = F.concat(*[x for c in columns for x in (F.coalesce(c.cast("string"), F.lit("")), F.lit("|"))])
    return F.conv(F.substring(F.md5(joined), 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, most: int = 3) -> DataFrame:
    """``source, source_size, weight`` to those plus ``target``.

    The sum of all sizes is shared by weight; no source gets more than ``most`` times its
    size, and what is left over is shared among the others by weight, until none gets too
    much. In order of size per weight the full sources come first, so one pass finds them:
    a source is full if its share, after the full ones before it, reaches its limit.
    """
    d = lambda c: F.col(c).cast("decimal(38,0)")
    full = most * d("source_size")
    before = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    all = Window.partitionBy()
    ranked = sizes.select(
        "*", F.coalesce(F.sum(full).over(before), F.lit(0)).alias("full_before"),
        F.coalesce(F.sum(d("weight")).over(before), F.lit(0)).alias("weight_before"),
        F.sum(d("source_size")).over(all).alias("total"), F.sum(d("weight")).over(all).alias("weights"),
    )
    is_full = full * (F.col("weights") - F.col("weight_before")) <= (F.col("total") - F.col("full_before")) * d("weight")
    marked = ranked.withColumn("full", is_full)
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), full)).over(all), F.lit(0))
    sharing = F.sum(F.when(~F.col("full"), F.col("weight"))).over(all)
    share = F.col("weight").cast("double") * left.cast("double") / sharing.cast("double")
    return marked.select(
        "source", "source_size", "weight",
        F.when(F.col("full"), (most * F.col("source_size")).cast("double")).otherwise(share).alias("target"),
    )


def thresholds(placed: DataFrame, wanted: DataFrame, work: Workspace) -> DataFrame:
    """``source, target, rounds, limit``: whole rounds, and the last place that one more round takes.

    ``placed`` has source, size and place, ``wanted`` source, source_size and target. Documents at
    one place are taken together; the place at which the budget ends is taken if that comes nearer.
    """
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    open = wanted.select("source", "source_size", "target", rounds.alias("rounds"))
    open = open.withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    inside = placed
    for shift in range(KEY_BITS - BUCKET_BITS, -1, -BUCKET_BITS):
        bucket = F.shiftright("place", shift)
        sums = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
        up_to = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("after", F.sum("size").over(up_to))
        met = open.select("source", "rest").join(sums.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        # the bucket in which the budget ends; none if nothing more is wanted
        met = met.where("after - size < rest AND rest <= after")
        open = work.keep(open.select("source", "source_size", "target", "rounds").join(
            met.select(F.col("s"), F.col("bucket"), F.col("size").alias("in_bucket"), (F.col("rest") - F.col("after") + F.col("size")).alias("rest")),
            F.col("source").eqNullSafe(F.col("s")), "left",
        ).drop("s"))
        if shift:
            ends = open.where("bucket IS NOT NULL").select(F.col("source").alias("s"), F.col("bucket").alias("b"))
            inside = inside.join(ends, F.col("source").eqNullSafe(F.col("s")) & (bucket == F.col("b")), "left_semi")
    limit = F.when(F.col("in_bucket") < 2 * F.col("rest"), F.col("bucket")).otherwise(F.coalesce(F.col("bucket") - 1, F.lit(-1)))
    return open.select("source", "source_size", "target", "rounds", limit.alias("limit"))


def mixed(
    docs: DataFrame, source: str = "source", id: str = "doc_id", text: str = "text",
    weights: tuple[int, ...] = (1, 2, 3), most: int = 3, keep_text: bool = True,
) -> DataFrame:
    """The columns plus a struct ``mix``: size, source_size, target, rounds taken and words taken.

    Sources in the order of their code points, null last, weigh ``weights`` in turn and
    share the words of all documents. Size is the number of words (null and blank texts: 0).
    A document's place comes from its id and text, so equal rows are taken together, reruns
    agree, and a third of the rows in one source makes that source no harder. Sources of size zero have
    target zero. A column named mix gives way to it. An empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "mixing")
    columns = [c for c in docs.columns if keep_text or c != text]
    placed = packed(
        docs, columns, source=quoted(source).cast("string"), size=F.size(split_words(quoted(text))).cast("long"),
        place=place(quoted(id), quoted(text)),
    )
    # numbers are kept for the passes over them; texts are not copied but placed again at the end
    numbers = work.keep(placed.select("source", "size", "place") if keep_text else placed)
    placed = placed if keep_text else numbers
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.lit(list(weights)), ((F.row_number().over(ordered) - 1) % len(weights) + 1).cast("int"))
    sizes = numbers.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", turn.cast("long"))
    wanted = work.keep(targets(sizes, most))
    found = thresholds(numbers.select("source", "size", "place"), wanted, work).withColumnRenamed("source", "s")
    taken = F.col("rounds") + F.when(F.col("place") <= F.col("limit"), 1).otherwise(0)
    mix = F.struct(
        "size", "source_size", "target", taken.alias("rounds"), (F.col("size") * taken).alias("taken"),
    ).alias("mix")
    return unpacked(placed.join(found, F.col("source").eqNullSafe(F.col("s"))), columns, mix, names=["mix"])


def drawn(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: every document as often as it is taken."""
    rows = mixed(docs, **options)
    return rows.withColumn("mix", F.explode(F.array_repeat(F.lit(0), F.col("mix.rounds").cast("int")))).drop("mix")
