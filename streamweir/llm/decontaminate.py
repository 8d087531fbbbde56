"""Passages of a benchmark inside documents, whole or nearly whole.

Windows of a document that are as long as an item get a SimHash. Cut into one block more than
bits may differ, two fingerprints within the radius agree on at least one block, so a join on
the blocks of equally long windows and items finds all of them; what it finds is verified by the
exact weighted similarity of the shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from streamweir.llm.simhash import _add_bits
from streamweir.llm.tables import Workspace, packed, quoted, unpacked
from streamweir.llm.words import ALNUM, WordHashes, grouped, mixed, shingles

FILTER_BITS = 23
RADIUS = 24  # two texts at 0.8 differ in about 9 bits; none of 80,000 pairs differed in more than 24
WINDOWS = "row_key LONG, doc_id LONG, start LONG, n_words INT, item_words INT, fp LONG, shingles ARRAY<LONG>"


def _simhash(hashes: np.ndarray) -> int:
    total = np.zeros(64, np.int64)
    _add_bits(total, hashes)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<i8")[0])


def least_common(n: int, similarity: float) -> int:
    """Shingles that two bags of ``n`` each must have in common: m / (2n - m) reaches the similarity."""
    return ceil(2 * n * similarity / (1 + similarity) - 1e-9)


def numbered(hashes: np.ndarray) -> np.ndarray:
    """The bag as a set: the second and later copies of a shingle get hashes of their own."""
    ordered = np.argsort(hashes, kind="stable")
    values = hashes[ordered]
    first = np.r_[True, values[1:] != values[:-1]] if len(values) else np.empty(0, bool)
    starts = np.maximum.accumulate(np.where(first, np.arange(len(values)), 0))
    copy = (np.arange(len(values)) - starts).astype(np.uint64)
    return values + copy * np.uint64(0x9E3779B97F4A7C15)


def slots(hashes: np.ndarray, n_words: int = 0) -> np.ndarray:
    """Places of the shingles in a filter, other ones for items of each length."""
    if n_words:
        hashes = mixed(hashes ^ np.uint64(n_words * 0xD6E8FEB86659FD93 & (1 << 64) - 1))
    return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def items_of(benchmark: DataFrame, k: int, text: str, id: str) -> DataFrame:
    """``item_id, n_words, fp, bag, slots, own_slots`` of every item with a word."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = WordHashes()
        for batch in batches:
            out = []
            for item, t in zip(batch["item_id"], batch["text"]):
                words = memory.of(t, ALNUM)
                if len(words):
                    s = shingles(words, k)
                    out.append((item, len(words), _simhash(s), numbered(s).view(np.int64), slots(s), slots(s, len(words))))
            yield pd.DataFrame(out, columns=["item_id", "n_words", "fp", "bag", "slots", "own_slots"]).astype({"item_id": "Int64"})

    rows = benchmark.select(quoted(id).cast("long").alias("item_id"), quoted(text).alias("text"))
    return rows.mapInPandas(encode, "item_id LONG, n_words INT, fp LONG, bag ARRAY<LONG>, slots ARRAY<LONG>, own_slots ARRAY<LONG>")


def known_slots(items: DataFrame, column: str) -> np.ndarray:
    """A bit for each of 2 ** 23 slots that some item's shingle has: a megabyte, whatever the benchmark."""
    taken = items.select(F.explode(column).alias("slot"))
    words = taken.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
    known = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in words.toLocalIterator():
        known[row["at"]] = row["bits"]
    return known.view(np.uint8)


def windows_of(docs: DataFrame, items: DataFrame, k: int, similarity: float) -> DataFrame:
    """Windows as long as some item, at every word, that can be similar enough to an item of that length.

    For items that are longer than the document, the whole document is the window.
    A window must have enough shingles that items of its length have. Counting them with running sums skips the
    windows that cannot be similar to anything, which are nearly all, before they get a fingerprint.
    """
    known, own_known = known_slots(items, "slots"), known_slots(items, "own_slots")
    lengths = sorted(r["n_words"] for r in items.select("n_words").distinct().toLocalIterator())
    needs = [(n, max(1, n - k + 1), least_common(max(1, n - k + 1), similarity)) for n in lengths]
    # of a smaller bag, so many must be the item's
    parts = [ceil(n * similarity - 1e-9) for _, n, _ in needs]
    fewest, brief = min(parts, default=0), bool(lengths) and lengths[0] < k

    def windows(words: np.ndarray, own_table: np.ndarray) -> Iterator[tuple]:
        full = shingles(words, k)
        for (n_words, n, need), part in zip(needs, parts):
            if n_words > len(words):
                if part > len(full):
                    return
                if np.count_nonzero(own_table[slots(full, n_words)]) >= part:
                    yield 0, len(words), n_words, _simhash(full), numbered(full).view(np.int64)
                continue
            # an item shorter than a shingle is one shingle
            own = full if n_words >= k else shingles(words, n_words)
            hit = np.concatenate(([0], np.cumsum(own_table[slots(own, n_words)])))
            for at in np.flatnonzero(hit[n:] - hit[:-n] >= need):
                yield int(at), n_words, n_words, _simhash(own[at : at + n]), numbered(own[at : at + n]).view(np.int64)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory, names = WordHashes(), [c.split()[0] for c in WINDOWS.split(", ")]
        table, own_table = (np.unpackbits(x, bitorder="little").view(bool) for x in (known, own_known))
        for batch in batches:
            found = []
            keys, docs, texts = (batch[c].tolist() for c in ("row_key", "doc_id", "text"))
            for rows in grouped(texts):
                # known shingles of many texts at once; those across two texts only add texts to look at
                words, ends = memory.of_all([texts[i] for i in rows], ALNUM)
                hits = np.concatenate(([0], np.cumsum(table[slots(shingles(words, k))])))
                hits = np.diff(hits[np.minimum(ends, len(hits) - 1)], prepend=0)
                for i, start, end, n in zip(rows, np.r_[0, ends[:-1]], ends, hits):
                    if needs and end > start and (brief or n >= fewest):
                        found += [(keys[i], docs[i], *w) for w in windows(words[start:end], own_table)]
            for at in range(0, len(found), 10_000):
                yield pd.DataFrame(found[at : at + 10_000], columns=names).astype({"doc_id": "Int64"})

    return docs.mapInPandas(search, WINDOWS)


def blocks(fp: Column, radius: int) -> Column:
    """The fingerprint in ``radius + 1`` parts, each as a number with the part's position in front."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    parts = []
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        part = F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 63 else -1))
        parts.append(F.struct(F.lit(i).alias("block"), part.alias("bits")))
    return F.array(*parts)


def leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", id: str = "doc_id", item_text: str = "text",
    item_id: str = "item_id", k: int = 5, similarity: float = 0.8, radius: int = RADIUS,
) -> DataFrame:
    """``row_key, doc_id, item_id, similarity, start, n_words``: the best window per row and item.

    Words are runs of letters and digits, A-Z lower-cased; similarity is that of bags of ``k``-word
    shingles, sum of smaller over sum of larger counts. All windows whose fingerprint is within
    ``radius`` bits of an equally long item are verified; a text shorter than an item is one window for it. Items of fewer words than a shingle has are one
    shingle; null and empty items and texts match nothing. ``row_key`` is the hash of id and text: equal
    rows have one, null ids too. Of equally similar windows the first is named. Empty tables give no rows.
    """
    work = Workspace(docs.sparkSession, "leaks")
    items = work.keep(items_of(benchmark, k, item_text, item_id))
    rows = docs.select(row_key(docs, text, id).alias("row_key"), quoted(id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    windows = work.keep(windows_of(rows, items, k, similarity))
    parts = windows.withColumn("part", F.explode(blocks(F.col("fp"), radius))).select("*", "part.*").drop("part")
    other = items.select("item_id", F.col("n_words").alias("m_words"), F.col("fp").alias("item_fp"), "bag", F.explode(blocks(F.col("fp"), radius)).alias("part"))
    other = other.select("item_id", "m_words", "item_fp", "bag", F.col("part.block").alias("b"), F.col("part.bits").alias("v"))
    met = parts.join(other, (F.col("item_words") == F.col("m_words")) & (F.col("block") == F.col("b")) & (F.col("bits") == F.col("v")))
    # a pair that agrees on several blocks is taken at the first of them
    agree = F.array_position(F.zip_with(blocks(F.col("fp"), radius), blocks(F.col("item_fp"), radius), lambda x, y: x == y), F.lit(True))
    near = met.where((F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius) & (agree == F.col("block") + 1))
    common = F.size(F.array_intersect("shingles", "bag"))
    scored = near.withColumn("similarity", common / (F.size("shingles") + F.size("bag") - common)).where(F.col("similarity") >= similarity)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words")).alias("best")
    return scored.groupBy("row_key", "doc_id", "item_id").agg(best).select(
        "row_key", "doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("start"), "best.n_words"
    )


def row_key(docs: DataFrame, text: str = "text", id: str = "doc_id") -> Column:
    """One number for a row's id and text, also where they are null."""
    return F.xxhash64(quoted(id).isNull(), quoted(id), quoted(text))


def cleaned(docs: DataFrame, benchmark: DataFrame, text: str = "text", id: str = "doc_id", **options) -> DataFrame:
    """The rows that hold no item of the benchmark; all columns as they were."""
    found = leaks(docs, benchmark, text, id, **options).select(F.col("row_key").alias("leaked")).distinct()
    rows = packed(docs, own_key=row_key(docs, text, id))
    return unpacked(rows.join(found, F.col("own_key") == F.col("leaked"), "left_anti"), docs.columns)
