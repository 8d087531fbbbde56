"""Near copies by SimHash and ball hashing that meets in the middle.

Two fingerprints within ``2 * half`` bits have a common variant within ``half`` bits of
both. Every fingerprint is sent to all its variants; those that meet are linked.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from streamweir.llm import components
from streamweir.llm.tables import Workspace, packed, quoted, unpacked
from streamweir.llm.words import LOWER, pieces

BLOCK = 4096


def _add_bits(total: np.ndarray, hashes: np.ndarray) -> None:
    """Adds to each of the 64 counters how many of the hashes have that bit."""
    for at in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, k: int = 3) -> int:
    """Bits set in over half of the XXH64 (seed 42) of the k-word shingles, repeats included."""
    digest = xxhash.xxh64_intdigest
    total, n, last = np.zeros(64, np.int64), 0, []
    for words in pieces(text, LOWER):
        words = last + words
        if len(words) >= k:
            grams = map(b" ".join, zip(*(words[j:] for j in range(k))))
            hashes = np.fromiter((digest(g, 42) for g in grams), np.uint64, len(words) - k + 1)
            _add_bits(total, hashes)
            n += len(hashes)
        last = words[max(0, len(words) - k + 1) :]
    if not n and last:  # fewer words than a shingle has: the whole sequence
        _add_bits(total, np.array([digest(b" ".join(last), 42)], np.uint64))
        n = 1
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprint_of(text: Column, k: int) -> Column:
    @F.pandas_udf(LongType())
    def of_batch(texts: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((fingerprint(t, k) for t in texts), np.uint64, len(texts)).view(np.int64))

    return of_batch(text)


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def masks(bits: int, half: int) -> list[int]:
    """All numbers of ``bits`` bits with at most ``half`` ones, as signed 64-bit numbers."""
    found = [sum(1 << b for b in c) for n in range(half + 1) for c in combinations(range(bits), n)]
    return [x - (1 << 64) if x >> 63 else x for x in found]


def meeting_links(fingerprints: DataFrame, id: str, key: str, bits: int, half: int) -> DataFrame:
    """Links ``a, b`` between the ids whose keys have a common variant, along the ids of each variant.

    Only the lower ``bits`` bits vary: what stands above them keeps apart what must not meet. Keys should be
    distinct, so that a variant meets at most as many rows as its ball has points; whatever meets is within
    ``2 * half`` bits, so linking neighbours keeps all of a variant's rows connected, without making all
    their pairs. A key that many ids have is a longer chain, never a product.
    """
    variants = fingerprints.select(F.col(id).alias("b"), F.col(key).alias("key"), F.explode(F.lit(masks(bits, half))).alias("mask"))
    variants = variants.select("b", F.col("key").bitwiseXOR(F.col("mask")).alias("variant"))
    met = variants.select("b", F.lag("b").over(Window.partitionBy("variant").orderBy("b")).alias("a"))
    return met.where("a <> b").select("a", "b").distinct()


def components_of_fingerprints(fingerprints: DataFrame, work: Workspace, bits: int = 2) -> DataFrame:
    """``fp, component_id`` for each fingerprint: the smallest ``doc_id`` of all that links of at most ``bits`` bits reach."""
    if bits < 0 or bits % 2:
        raise ValueError("fingerprints meet in the middle: an even number of bits is needed")
    distinct = work.keep(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    links = meeting_links(distinct, "fp", "fp", 64, bits // 2)
    roots = components.roots(links, work)
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root").select("fp", "component_id")


def simhash_components(docs: DataFrame, text: str = "text", id: str = "doc_id", k: int = 3, bits: int = 2) -> DataFrame:
    """The columns but the text, plus ``fingerprint`` (16 hex digits) and ``component_id``.

    The fingerprint is over ``k``-word shingles (A-Z lower-cased, repeats included). Fingerprints at ``bits``
    (an even number) or fewer differing bits are linked; the component is the smallest id reachable. Null and blank
    texts have fingerprint zero and are linked like any other; shorter texts are one shingle. Rows
    with a null id take part but name no component unless it has no other row. Equal rows stay as
    many as they were. Other columns are carried along; those named like a result give way to it.
    An empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "simhash")
    kept = [c for c in docs.columns if c != text]
    fps = work.keep(packed(docs, kept, fp=fingerprint_of(quoted(text), k), doc_id=quoted(id)))
    named = fps.join(components_of_fingerprints(fps, work, bits), "fp")
    results = [hex_digits(F.col("fp")).alias("fingerprint"), F.col("component_id")]
    return unpacked(named, kept, *results, names=["fingerprint", "component_id"])


def one_of_each(docs: DataFrame, text: str = "text", id: str = "doc_id", k: int = 3, bits: int = 2) -> DataFrame:
    """The rows without near copies: of each component of ``simhash_components`` the one with the smallest id stays, as it was.

    Null and blank texts are copies of one another. Null ids come last; rows of one id stay apart by
    their texts, and of those with equal id and text one stays. Other columns are untouched, whatever their
    names. An empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "near-copies")
    number = quoted(id).cast("long")
    # ordered as the rows are to be chosen, and without nulls, so that it joins
    name = F.struct(number.isNull().alias("none"), F.coalesce(number, F.lit(0)).alias("id"), F.xxhash64(quoted(text)).alias("text"))
    found = simhash_components(docs.select(name.alias("name"), quoted(text).alias("text")), "text", "name", k, bits)
    stay = work.keep(found.where("name = component_id").select("name").distinct())
    # equal rows go before any text is shuffled: the least of each task is enough
    turn = F.row_number().over(Window.partitionBy("name").orderBy("name"))
    rows = packed(docs, name=name).withColumn("turn", turn).where("turn = 1")
    return unpacked(rows.join(stay, "name", "left_semi"), docs.columns)
