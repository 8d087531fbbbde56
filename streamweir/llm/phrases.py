"""Phrases whose words stand together more often than chance, counted in burstable tries.

Every place of a text is a path of up to three words from there on. A task inserts its paths into a
shallow trie over numbers of words: a node's children are by the next word, and what is below the last
node is a hash container of counts, which bursts into a node when it is too large. When the trie is full, its
largest subtrees leave as sorted runs with the counts of all their prefixes. Spark brings the runs
of a prefix together and adds them up. The count of a phrase is that of its path's prefix.

No phrase is more frequent than a pair in it. So a first pass counts hashes of all neighbours, and a path ends
where a pair is too rare by that count; hashes that fall together only make paths longer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import nlargest
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from streamweir.llm.tables import Workspace, quoted
from streamweir.llm.words import WordHashes, mixed

# bytes to bytes: A-Z to a-z, what ends a piece to a mark that no lower-cased text has, tabs to spaces
MARK = b"A"
ENDS = b".,;:!?\n\x0b\x0c\r"
PIECES = bytes(c + 32 if 65 <= c <= 90 else MARK[0] if c in ENDS else 32 if c == 9 else c for c in range(256))

BITS = 21  # of a word's number; three of them in one number make a path
WORD = (1 << BITS) - 1


class _Numbers(dict):
    """Words to numbers from one on; zero is no word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class HatTrie:
    """Counts of paths of three numbers (zero: no word), in hash containers under nodes.

    The first level is always a node. A container of over ``burst`` paths becomes a node by its second number.
    """

    def __init__(self, burst: int = 1 << 15):
        self.burst, self.root, self.sizes, self.size = burst, {}, {}, 0

    def add(self, paths: list[int], counts: list[int]) -> None:
        """Sorted distinct paths; those of one first number together."""
        root, sizes, low, burst = self.root, self.sizes, (1 << 2 * BITS) - 1, self.burst
        first, below, grown = -1, {}, 0
        for path, n in zip(paths, counts):
            word, rest = path >> 2 * BITS, path & low
            if word != first:
                if first >= 0:
                    sizes[first] = sizes.get(first, 0) + grown
                    self.size += grown
                first, below, grown = word, root.setdefault(word, {}), 0
            holder = below
            if -1 in below:  # a node: its children are containers by the second number
                holder = below.get(rest >> BITS)
                if holder is None:
                    holder = below[rest >> BITS] = {}
            known = holder.get(rest)
            if known is None:
                holder[rest] = n
                grown += 1
                if holder is below and len(below) > burst:
                    below = root[word] = self._burst(below)
            else:
                holder[rest] = known + n
        if first >= 0:
            sizes[first] = sizes.get(first, 0) + grown
            self.size += grown

    @staticmethod
    def _burst(container: dict[int, int]) -> dict:
        node: dict = {-1: None}
        for rest, n in container.items():
            node.setdefault(rest >> BITS, {})[rest] = n
        return node

    def largest(self, upto: int) -> list[int]:
        """First numbers of the largest subtrees, such that the others have at most ``upto`` paths."""
        rest, chosen = self.size, []
        for word in nlargest(len(self.sizes), self.sizes, key=self.sizes.__getitem__):
            if rest <= upto:
                break
            chosen.append(word)
            rest -= self.sizes[word]
        return chosen

    def take(self, words: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The whole subtrees of the words, which leave the trie: paths and their counts."""
        sizes = [self.sizes.pop(word) for word in words]
        self.size -= sum(sizes)
        held = [h for below in map(self.root.pop, words) for h in ([x for k, x in below.items() if k >= 0] if -1 in below else [below])]
        rest = np.fromiter(chain.from_iterable(held), np.int64, sum(sizes))
        counts = np.fromiter(chain.from_iterable(h.values() for h in held), np.int64, sum(sizes))
        return np.repeat(np.array(words, np.int64) << 2 * BITS, sizes) | rest, counts


class Neighbours:
    """The words of some texts that are set apart by marks, and the hashes of neighbours in their language."""

    def __init__(self):
        self.hashes = WordHashes()

    def read(self, lang: str, data: bytes, ahead: bytes) -> None:
        """What comes ahead has neighbours of the last words, but none of its own."""
        raw = data + ahead
        self.letters = raw.replace(MARK, b" ")
        hashes, starts = self.hashes.of_part(np.frombuffer(self.letters, np.uint8))
        piece = np.cumsum(np.frombuffer(raw, np.uint8) == MARK[0], dtype=np.int32)[starts]
        self.n = int(np.searchsorted(starts, len(data)))
        self.together = piece[1:] == piece[:-1]
        self.pairs = mixed(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:] + np.uint64(xxhash.xxh64_intdigest(lang)))

    def of_own(self) -> np.ndarray:
        """The hashes of the neighbours that begin before what comes ahead."""
        return self.pairs[: self.n][self.together[: self.n]]


class Filter:
    """Which hashes may be frequent: one bit for all that share their highest bits."""

    MOST = 28

    def __init__(self, bits: int, words: np.ndarray):
        self.shift, self.words = np.uint64(64 - bits), words

    @classmethod
    def of(cls, hashes: DataFrame) -> Filter:
        """Of a column ``hash``; about 32 bits for each, and 32 MB at most."""
        bits = min(cls.MOST, max(16, (32 * hashes.count()).bit_length()))
        slot = F.shiftrightunsigned("hash", 64 - bits)
        own = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - bits}) & 63 AS int))")
        words = np.zeros(1 << bits - 6, np.int64)
        for row in hashes.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(own).alias("own")).toLocalIterator():
            words[row["at"]] = row["own"]
        return cls(bits, words.view(np.uint64))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slots = hashes >> self.shift
        return (self.words[slots >> np.uint64(6)] >> (slots & np.uint64(63)) & np.uint64(1)).astype(bool)


def _paths(read: Neighbours, frequent: Filter, numbers: _Numbers) -> np.ndarray:
    """The path of every word, as far as its pairs may be frequent."""
    words = read.letters.split()
    ids = np.zeros(len(words) + 2, np.int64)
    ids[: len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    linked = np.zeros(len(words) + 1, bool)
    linked[: len(read.pairs)] = read.together & frequent.has(read.pairs)
    first, second = linked[:-1], linked[:-1] & linked[1:]
    return (ids[:-2] << 2 * BITS | np.where(first, ids[1:-1], 0) << BITS | np.where(second, ids[2:], 0))[: read.n]


def _parts(data: bytes, most: int = 2 << 20) -> Iterator[tuple[bytes, bytes]]:
    """A very long text in parts that no word crosses, each with what comes ahead of it: two words at least, or up to the end."""
    space, start = re.compile(b" +"), 0
    while start < len(data):
        end = data.find(b" ", start + most)
        end = len(data) if end < 0 else end
        upto = end
        for _ in range(2):  # over the spaces, then over a word
            begun = space.match(data, upto)
            upto = data.find(b" ", begun.end() if begun else upto)
            upto = len(data) if upto < 0 else upto
        yield data[start:end], data[end:upto]
        start = end


class PhraseCounter:
    """One task's tries, one per language, and the runs that leave them."""

    COLUMNS = ["lang", "prefix", "rest", "n"]

    def __init__(self, frequent: Filter, limit: int = 500_000, words: int = 500_000):
        self.frequent, self.read, self.limit, self.words = frequent, Neighbours(), limit, min(words, 1 << BITS - 1)
        self._anew()

    def _anew(self) -> None:
        self.numbers, self.tries = _Numbers({b"": 0}), {}

    def add(self, lang: str, data: bytes, ahead: bytes) -> Iterator[pa.RecordBatch]:
        """Counts the words of some texts of one language, and yields what has to leave."""
        trie = self.tries.setdefault(lang, HatTrie())
        self.read.read(lang, data, ahead)
        paths, counts = np.unique(_paths(self.read, self.frequent, self.numbers), return_counts=True)
        trie.add(paths.tolist(), counts.tolist())
        if len(self.numbers) > self.words:
            yield from self.rest()
        else:
            while sum(t.size for t in self.tries.values()) > self.limit:
                lang = max(self.tries, key=lambda x: self.tries[x].size)
                yield from self._run(lang, self.tries[lang].largest(self.tries[lang].size // 4))

    def rest(self) -> Iterator[pa.RecordBatch]:
        for lang, trie in self.tries.items():
            yield from self._run(lang, list(trie.root))
        self._anew()

    def _run(self, lang: str, subtrees: list[int]) -> Iterator[pa.RecordBatch]:
        """A sorted run: all prefixes in the subtrees with their counts, a longer phrase cut after its second word."""
        if not subtrees:
            return
        paths, n = self.tries[lang].take(subtrees)
        seconds = paths >> BITS & WORD > 0
        lengths = [np.zeros(len(paths), np.int64), paths & ~((1 << 2 * BITS) - 1), (paths & ~WORD)[seconds], paths[paths & WORD > 0]]
        weights = [n, n, n[seconds], n[paths & WORD > 0]]
        keys, counts = [], []
        for level, weight in zip(lengths, weights):
            at, which = np.unique(level, return_inverse=True)
            keys.append(at)
            counts.append(np.bincount(which, weight, len(at)).astype(np.int64))
        key, count = np.concatenate(keys), np.concatenate(counts)
        # number the words of this run in their own order, so that sorted numbers are sorted words
        ids = np.unique(np.concatenate([key >> 2 * BITS, key >> BITS & WORD, key & WORD]))
        spelled = list(self.numbers)
        by_name = sorted(ids.tolist(), key=lambda i: spelled[i] if i else b"")
        ranks = np.empty(len(spelled), np.int64)
        ranks[by_name] = np.arange(len(by_name))
        names = pa.array([spelled[i] if i else b"" for i in by_name], pa.binary())
        one, two, three = (ranks[key >> 2 * BITS], ranks[key >> BITS & WORD], ranks[key & WORD])
        none = int(ranks[0]) if len(ids) and ids[0] == 0 else -1
        order = np.lexsort((three, two, one))
        for at in range(0, len(order), 1 << 16):
            some = order[at : at + (1 << 16)]
            yield self._batch(lang, names, one[some], two[some], three[some], none, count[some])

    @staticmethod
    def _batch(lang, names, one, two, three, none, count) -> pa.RecordBatch:
        first, second, third = (names.take(pa.array(x)) for x in (one, two, three))
        pair = pc.binary_join_element_wise(first, second, pa.scalar(b" ", pa.binary()))
        prefix = pc.if_else(pa.array(two == none), first, pair).cast(pa.string())
        rest = pc.if_else(pa.array(three == none), pa.scalar(None, pa.binary()), third).cast(pa.string())
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(count), pa.string()), prefix, rest, pa.array(count)], PhraseCounter.COLUMNS)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes, bytes]]:
    """About a megabyte of texts of one language at a time, or a part of a longer text and what comes ahead of it."""
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text")
        sizes = pc.binary_length(texts).to_pylist()
        for lang in sorted(set(langs)):
            rows, size = [], 0
            for i in [i for i, x in enumerate(langs) if x == lang] + [None]:
                if rows and (i is None or size + sizes[i] > 1 << 20):
                    joined = "\n".join(texts.take(pa.array(rows)).to_pylist()).encode("utf-8", "surrogatepass").translate(PIECES)
                    for part, ahead in _parts(joined):
                        yield lang, part, ahead
                    rows, size = [], 0
                if i is not None:
                    rows.append(i)
                    size += sizes[i]


def _pair_counts(batches: Iterator[pa.RecordBatch], most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """``hash, n`` of neighbours, summed up over some megabytes."""
    read, held, size = Neighbours(), [], 0
    for block in chain(_blocks(batches), [None]):
        if block:
            read.read(*block)
            held.append(read.of_own())
            size += len(held[-1])
        if held and (block is None or size > most):
            hashes, n = np.unique(np.concatenate(held), return_counts=True)
            held, size = [], 0
            for at in range(0, len(hashes), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(hashes[at : at + (1 << 16)].view(np.int64)), pa.array(n[at : at + (1 << 16)].astype(np.int32))], ["hash", "n"])


def _runs(batches: Iterator[pa.RecordBatch], frequent: Filter, limit: int, words: int) -> Iterator[pa.RecordBatch]:
    counter = PhraseCounter(frequent, limit, words)
    for lang, part, ahead in _blocks(batches):
        yield from counter.add(lang, part, ahead)
    yield from counter.rest()


def counted_phrases(docs: DataFrame, work: Workspace, text: str = "text", lang: str = "lang", least: int = 10, limit: int = 500_000, words: int = 500_000) -> DataFrame:
    """``lang, phrase, words, f``: how often phrases of one to three words stand in pieces of texts, if at least ``least`` times.

    The row of no words has a language's number of words, whatever ``least`` is. ``limit`` paths or ``words`` words are the most
    that a task holds.
    """
    own = docs.select(F.coalesce(quoted(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    pairs = own.mapInArrow(_pair_counts, "hash LONG, n INT").groupBy("hash").agg(F.sum("n").alias("n"))
    frequent = Filter.of(work.keep(pairs.where(F.col("n") >= least).select("hash")))
    runs = own.mapInArrow(lambda b: _runs(b, frequent, limit, words), "lang STRING, prefix STRING, rest STRING, n LONG")
    # the runs of one prefix meet in one task, whose rows are as few as the runs have made them
    merged = runs.repartition("lang", "prefix").groupBy("lang", "prefix", "rest").agg(F.sum("n").alias("f"))
    merged = merged.where((F.col("f") >= least) | (F.col("prefix") == ""))
    spaces = F.length("prefix") - F.length(F.replace("prefix", F.lit(" "), F.lit("")))
    size = F.when(F.col("prefix") == "", 0).when(F.col("rest").isNotNull(), 3).otherwise(1 + spaces)
    return merged.select("lang", F.concat_ws(" ", "prefix", "rest").alias("phrase"), size.cast("int").alias("words"), "f")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, covered: int = 50, top: int = 2000,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of two and three words.

    Texts (A-Z lower-cased) are cut at ``.,;:!?`` and line ends into pieces, those at spaces and tabs into words; a
    null language is ``und``, a null, empty or blank text has no words. A phrase that stands ``a >= least`` times is a
    candidate. It is cut into a first part (``l`` times) and the rest (``r`` times) where
    floor(1000000 a a / (l r)) is least, ties after the first possible word; that is its score. Candidates that have
    ``covered`` percent or more of their places inside one longer candidate go. ``n`` counts the language's words. Order:
    score, a, phrase by bytes; equal rows of the input count as often as they stand. Other columns are
    ignored. An empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "phrases")
    counts = work.keep(counted_phrases(docs, work, text, lang, least))
    f = counts.where("words > 0").select(F.col("lang").alias("of"), F.col("phrase").alias("part"), "f")
    found = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = found.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("second", F.expr("substring_index(phrase, ' ', k - words)"))
    for part, name in (("first", "l"), ("second", "r")):
        counted = f.select(F.col("of").alias("lang"), F.col("part").alias(part), F.col("f").alias(name))
        cuts = cuts.join(counted, ["lang", part])
    # exact beyond 64 bits
    cuts = cuts.withColumn("score", F.expr("(1000000 * cast(a AS decimal(18,0)) * cast(a AS decimal(18,0))) div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))"))
    best = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    longer = found.where("words = 3")
    inside = longer.select("lang", "a", F.explode(F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2))).alias("phrase"))
    most = inside.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    left = best.join(most, ["lang", "phrase"], "left").where(f"words = 3 OR most IS NULL OR 100 * most < {covered} * a")
    rows = left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # first the best of many parts of a language, then the best of those
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = rows.withColumn("part", part).withColumn("at", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("at") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
