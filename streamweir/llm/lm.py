"""Stupid-backoff scores of documents by the counts of all other documents.

Texts become blocks of word codes, stored once. For every order, blocks send their distinct n-grams with counts to
the part of the count table that the hash names; a part adds up what all blocks sent and answers each
with the totals; a block takes off what a document has itself and adds up the document's scores.
An n-gram is only asked for if its two shorter n-grams are known from other documents, since it
cannot be otherwise. What travels are sorted hashes and counts of a block and part as bytes: never more rows
than n-grams.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from streamweir.llm.files import Folder
from streamweir.llm.tables import Workspace, quoted
from streamweir.llm.words import LOWER, grouped, mixed, pieces

BLOCK_CHARS = 16 << 20
PART_GRAMS = 1 << 20
SCORES = "doc_id LONG, n_words LONG, log_score DOUBLE, backed_off LONG"


# --- blocks -----------------------------------------------------------------------------


class _Codes(dict):
    """Word to its number in order of first appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _packed_codes(codes: np.ndarray) -> bytes:
    """Codes below 2 ** 32 byte by byte, the higher bytes packed: frequent words have zeros there."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4)
    high = zlib.compress(np.ascontiguousarray(planes[:, 1:].T).tobytes(), 1)
    return planes[:, 0].tobytes() + high


def _unpacked_codes(data: bytes, n: int) -> np.ndarray:
    planes = np.empty((n, 4), np.uint8)
    planes[:, 0] = np.frombuffer(data, np.uint8, n)
    planes[:, 1:] = np.frombuffer(zlib.decompress(data[n:]), np.uint8).reshape(3, n).T
    return planes.view("<u4").ravel().astype(np.int64)


def pack_counts(counts: np.ndarray) -> bytes:
    """One byte each, packed; larger ones once more behind."""
    small, large = np.minimum(counts, 255).astype(np.uint8), counts[counts >= 255]
    return zlib.compress(small.tobytes(), 1) + large.astype("<i8").tobytes()


def unpack_counts(data: bytes) -> np.ndarray:
    unpacking = zlib.decompressobj()
    counts = np.frombuffer(unpacking.decompress(data), np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(unpacking.unused_data, "<i8")
    return counts


class Block:
    """Word hashes of some documents one after another; n-grams stay within a document."""

    def __init__(self, vocabulary: np.ndarray, codes: np.ndarray, lengths: np.ndarray):
        self.codes = codes
        self.words = vocabulary[codes]
        self.lengths = lengths
        self.document = np.repeat(np.arange(len(lengths)), lengths)
        self.place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)  # within the document

    @staticmethod
    def store(out, texts: list[str | None]) -> tuple[np.ndarray, tuple[int, int]]:
        """Writes words and codes; returns the documents' lengths, and the sizes of both."""
        known, parts, lengths = _Codes(), [], []
        for text in texts:
            n = 0
            for words in pieces(text, LOWER):
                parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                n += len(words)
            lengths.append(n)
        codes = np.concatenate(parts) if parts else np.empty(0, np.int64)
        # frequent words get small codes, which take less room
        order = np.argsort(-np.bincount(codes, minlength=len(known)), kind="stable")
        rank = np.empty(len(known), np.int64)
        rank[order] = np.arange(len(known))
        words = list(known)
        data = zlib.compress(b" ".join(words[i] for i in order), 1), _packed_codes(rank[codes])
        for part in data:
            out.write(part)
        return np.array(lengths, np.int64), (len(data[0]), len(data[1]))

    @classmethod
    def load(cls, folder: Folder, row) -> Block:
        with folder.open(row.file) as f:
            f.seek(row.at)
            words = zlib.decompress(f.read(row.vocabulary_bytes)).split()
            data = f.read(row.codes_bytes)
        lengths = np.asarray(row.lengths, np.int64)
        return cls(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), _unpacked_codes(data, int(lengths.sum())), lengths)

    def grams(self, n: int) -> np.ndarray:
        """At each place the hash of the n-gram that ends there; nothing sensible where the document has fewer words."""
        out = self.words
        for j in range(1, n):
            out = np.concatenate((out[:1], mixed(out[:-1] * np.uint64(0x9E3779B97F4A7C15) + self.words[1:])))
        return out if n > 1 else mixed(out)

    def own(self, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the document itself has the n-gram, for the places ``at``."""
        keys = mixed(grams[at] + self.document[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        return counts[inverse]


def _wanted(block: Block, n: int, below: np.ndarray | None) -> np.ndarray:
    """Places whose n-gram may be known from other documents: both (n-1)-grams are."""
    if n == 1:
        return np.arange(len(block.words))
    return np.flatnonzero((block.place >= n - 1) & (below > 0) & (np.concatenate(([0], below[:-1])) > 0))


def _write_counts(folder: Folder, counts: np.ndarray) -> str:
    name = folder.new_name("counts/block", ".bin")
    with folder.create(name) as out:
        out.write(pack_counts(counts))
    return name


def _read_counts(folder: Folder, name: str) -> np.ndarray:
    with folder.open(name) as f:
        return unpack_counts(f.read())


def _all_counts(folder: Folder, block: Block, names: list[str]) -> list[np.ndarray]:
    """Per order and place how often other documents have the n-gram. Those of words are stored per word."""
    counts = [_read_counts(folder, name) for name in names]
    if counts:
        counts[0] = counts[0][block.codes] - block.own(block.grams(1), np.arange(len(block.words)))
    return counts


# --- the count table --------------------------------------------------------------------


def pack(hashes: np.ndarray) -> bytes:
    """Ascending hashes by their differences, six bytes each if that is enough, else eight."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    if len(steps) > 1 and steps[1:].max() >> np.uint64(48) == 0:
        return b"\x06" + hashes[:1].astype("<u8").tobytes() + steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    return b"\x08" + hashes.astype("<u8").tobytes()


def unpack(data: bytes) -> np.ndarray:
    if data[0] == 8:
        return np.frombuffer(data, "<u8", offset=1)
    wide = np.zeros(((len(data) - 9) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8, offset=9).reshape(-1, 6)
    return np.cumsum(np.concatenate((np.frombuffer(data, "<u8", 1, 1), wide.view("<u8").ravel())), dtype=np.uint64)


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _answered(group: pd.DataFrame) -> pd.DataFrame:
    """All that blocks asked of one part of the table: the totals of their n-grams, in their order."""
    asked = [unpack(h) for h in group["hashes"]]
    counts = np.concatenate([unpack_counts(c) for c in group["counts"]])
    _, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    totals = np.bincount(inverse, weights=counts).astype(np.int64)[inverse]
    ends = np.cumsum([len(h) for h in asked])
    return pd.DataFrame({"block": group["block"], "part": group["part"], "totals": [pack_counts(t) for t in np.split(totals, ends[:-1])]})


# --- scoring ----------------------------------------------------------------------------


def block_scores(block: Block, counts: list[np.ndarray], total: int, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the log scores per document, and how many of its words were not found at the highest order that they could have."""
    rest = total - block.lengths[block.document]
    score = np.log(np.maximum(counts[0], 0.5) / np.maximum(rest, 1))
    found = np.ones(len(score), np.int64)
    for n in range(2, len(counts) + 1):
        here = counts[n - 1] > 0
        context = np.concatenate(([1], counts[n - 2][:-1]))
        score = np.where(here, np.log(np.maximum(counts[n - 1], 1) / np.maximum(context, 1)), score)
        found = np.where(here, n, found)
    behind = np.minimum(block.place + 1, len(counts)) - found
    n_docs = len(block.lengths)
    sums = np.bincount(block.document, weights=score + behind * np.log(alpha), minlength=n_docs)
    return sums, np.bincount(block.document, weights=behind > 0, minlength=n_docs).astype(np.int64)


def scored(
    docs: DataFrame, text: str = "text", id: str = "doc_id", order: int = 3, alpha: float = 0.4,
    block_chars: int = BLOCK_CHARS, part_grams: int = PART_GRAMS,
) -> DataFrame:
    """``doc_id, n_words, log_score, backed_off`` for every document.

    Words stand between white space, A-Z lower-cased. A word after others scores the count of the longest n-gram, up
    to ``order``, that other documents have, over the count of its first words there; times ``alpha`` for each
    word by which that is shorter than it could be. A single word scores its count over the number of all words of other
    documents; half a count if they don't have it. Log scores are natural and summed; texts without words, null too, sum
    to zero. Equal rows are documents of their own, and count for each other. Null ids stay null. Other columns are left
    out. Counts cover all documents. An empty table gives no rows.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "lm")
    folder = Folder(work.path)

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, out, at, number = None, None, 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = [None if pd.isna(x) else int(x) for x in batch["doc_id"]], batch["text"].tolist()
            blocks = []
            for rows in grouped(texts, block_chars):
                if out is None:
                    name = folder.new_name("words/blocks", ".bin")
                    out = folder.create(name)
                lengths, sizes = Block.store(out, [texts[i] for i in rows])
                blocks.append((number, name, at, *sizes, [ids[i] for i in rows], lengths))
                at, number = at + sum(sizes), number + 1
            yield pd.DataFrame(blocks, columns=["block", "file", "at", "vocabulary_bytes", "codes_bytes", "ids", "lengths"])
        if out is not None:
            out.close()

    rows = docs.select(quoted(id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    blocks = work.keep(rows.mapInPandas(store, "block LONG, file STRING, at LONG, vocabulary_bytes LONG, codes_bytes LONG, ids ARRAY<LONG>, lengths ARRAY<LONG>"))
    found = blocks.select(F.count("*"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda n, x: n + x))).first()
    n_blocks, total = max(1, found[0]), found[1] or 0
    parts = max(1, -(-total // part_grams), min(4 * spark.sparkContext.defaultParallelism, total >> 16))
    known = blocks.withColumn("counts", F.array().cast("array<string>"))
    columns = known.columns

    for n in range(1, order + 1):

        def asked(block: Block, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            at, grams = _wanted(block, n, below), block.grams(n)
            return grams, at, grams[at]

        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    block = Block.load(folder, row)
                    hashes, counts = np.unique(asked(block, (_all_counts(folder, block, row.counts) or [None])[-1])[2], return_counts=True)
                    if not len(hashes):
                        continue  # nothing but blank texts
                    cuts = np.flatnonzero(np.diff(_part_of(hashes, parts))) + 1
                    pieces = list(zip(np.split(hashes, cuts), np.split(counts, cuts)))
                    yield pd.DataFrame({
                        "block": row.block, "part": [int(_part_of(h[:1], parts)[0]) for h, _ in pieces],
                        "hashes": [pack(h) for h, _ in pieces], "counts": [pack_counts(c) for _, c in pieces],
                    })

        def learned(group: pd.DataFrame) -> tuple[tuple, Block, list[np.ndarray], np.ndarray]:
            """The block of the group, what it knew, and the answers in the order of the hashes."""
            row = next(group[group["file"].notna()].itertuples(index=False))
            answers = group[group["part"].notna()].sort_values("part")["totals"]
            block = Block.load(folder, row)
            return row, block, _all_counts(folder, block, row.counts), np.concatenate([np.empty(0, np.int64), *map(unpack_counts, answers)])

        def spread(block: Block, known: list[np.ndarray], totals: np.ndarray) -> np.ndarray:
            grams, at, own = asked(block, known[-1] if known else None)
            counts = np.zeros(len(block.words), np.int64)
            counts[at] = totals[np.unique(own, return_inverse=True)[1]] - block.own(grams, at)
            return counts

        def learn(group: pd.DataFrame) -> pd.DataFrame:
            row, block, before, totals = learned(group)
            if n == 1:
                counts = np.zeros(int(block.codes.max(initial=-1)) + 1, np.int64)
                counts[block.codes] = totals[np.unique(block.grams(1), return_inverse=True)[1]]
            else:
                counts = spread(block, before, totals)
            given = group[group["file"].notna()][columns]
            return given.assign(counts=[[*row.counts, _write_counts(folder, counts)]])

        def score(group: pd.DataFrame) -> pd.DataFrame:
            row, block, before, totals = learned(group)
            sums, backed = block_scores(block, [*before, spread(block, before, totals)], total, alpha)
            ids = pd.array([None if pd.isna(x) else int(x) for x in row.ids], dtype="Int64")
            return pd.DataFrame({"doc_id": ids, "n_words": block.lengths, "log_score": sums, "backed_off": backed})

        requests = known.repartition(n_blocks, "block").mapInPandas(ask, "block LONG, part INT, hashes BINARY, counts BINARY")
        answers = requests.groupBy("part").applyInPandas(_answered, "block LONG, part INT, totals BINARY")
        both = known.unionByName(answers, allowMissingColumns=True).repartition(n_blocks, "block").groupBy("block")
        if n == order:
            return both.applyInPandas(score, SCORES)
        known = work.keep(both.applyInPandas(learn, known.schema))
    raise ValueError("the order is one or more")
