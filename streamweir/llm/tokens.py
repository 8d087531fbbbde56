"""Token ids of all documents as raw files in key order, and an index that finds any document in constant time.

The ids of a shard are one file of little-endian numbers, without separators or headers. Where a
document's ids are stands in an index: a minimal perfect hash maps every key to a slot of its own, and the
slot holds a fingerprint of the key, the shard, the place and the length. The fingerprint tells
keys that were never stored. Both are spread over files by ranges of the key and hashes of the key.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable, Iterator
from itertools import accumulate, chain, islice, product
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from streamweir.llm.files import Folder
from streamweir.llm.pieces import _Memory
from streamweir.llm.tables import Workspace, quoted
from streamweir.llm.words import PIECE, grouped, mixed

BREAK = re.compile("[ \n]")
GAMMA = 1.6
ENTRY = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("at", "<u8"), ("n", "<u8")])


class _Words(_Memory):
    """Two halves of so many words: some 60 MB at most."""

    CHUNKS, CHARACTERS = 200_000, 3 << 20

    def learn(self, words: list, ids: Callable[[list], list[bytes]]) -> list[bytes]:
        """Ids of distinct words; those of new ones are made all at once and not kept before the others are found."""
        self.trim()
        found = [*map(self.get, words)]
        missing = [i for i, known in enumerate(found) if known is None]
        for i in missing:
            found[i] = self.before.get(words[i])
        new = [i for i in missing if found[i] is None]
        for i, made in zip(new, ids([words[i] for i in new]), strict=True):
            found[i] = made
        for i in missing:
            if len(words[i]) <= 256:
                self[words[i]] = found[i]
                self.characters += len(words[i])
        return found


def _listed(values: pa.BinaryArray) -> list[bytes]:
    """As ``to_pylist``, but faster, for an array that is no slice and has no nulls."""
    _, offsets, data = values.buffers()
    ends, data = np.frombuffer(offsets, np.int32, len(values) + 1).tolist() if len(values) else [], data.to_pybytes() if data else b""
    return [data[start:end] for start, end in zip(ends, ends[1:])]


class WordEncoder:
    """Ids of whole texts, from those of their words, which it remembers.

    Right for tokenizers whose tokens never cross white space and which drop it. Words are what stands between spaces and line
    ends; the library encodes each new one. Texts of Latin letters, digits and marks are cut further, if
    normaliser and pre-tokenizer turn every such character on its own to lower case and cut between all but two
    letters and two marks, which is asked for all pairs at the start: the library's model then encodes each new
    run of letters or marks. Few words with other characters leave the rest of a text as it is. Texts are worked on in parts of about a megabyte.
    """

    LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
    MARKS, DIGITS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", "0123456789"  # an apostrophe may belong to the letters after it
    ODD = re.compile(f"[^{LETTERS}{re.escape(MARKS)}{DIGITS} \n]")

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), kind
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added]
        self.odd_or_added = re.compile("|".join([self.ODD.pattern, *map(re.escape, self.added)]))
        groups = {c: group for group, some in enumerate((self.LETTERS, self.MARKS, self.DIGITS), 1) for c in some}
        self.groups = bytes(groups.get(chr(c), 0) for c in range(256))
        self.lower = bytes(ord(chr(c).lower()) if self.groups[c] == 1 else c for c in range(256))
        self.table = None if any(token.normalized for token in added) else self._table([*groups])
        said = re.search(r'"end_of_word_suffix":\s*"([^"]+)"', self.tokenizer.to_str())
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, id in self.tokenizer.get_vocab().items():
            self.ends[id] = bool(said) and token.endswith(said[1])
        self.words, self.runs = _Words(None), _Words(None)

    def _table(self, every: list[str]) -> dict[int, str] | None:
        """What each letter, mark and digit becomes in the library; none if texts of them are not cut as here."""
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if cut is None:
            return None

        def pieces(text: str) -> list[str]:
            return [piece for piece, _ in cut.pre_tokenize_str(normal.normalize_str(text) if normal else text)]

        alone = {ord(c): pieces(c) for c in every}
        if any(len(found) != 1 for found in alone.values()):
            return None
        table = {c: found[0] for c, found in alone.items()}
        pairs = ["".join(map("".join, product(some, some))) for some in (self.LETTERS, self.MARKS)]
        text = " ".join([*pairs, *map("".join, product(every, every))])
        want = [run.decode("latin-1").translate(table) for run in _listed(self._cut(text)[0])]
        return table if pieces(text) == want else None

    def _cut(self, text: str) -> tuple[pa.Array, np.ndarray]:
        """Runs of letters or marks and single digits in lower case, and where they start."""
        data = text.encode("latin-1")
        groups, lower = (np.frombuffer(data.translate(table), np.uint8) for table in (self.groups, self.lower))
        inside, first = groups > 0, groups == 3
        first[1:] |= groups[1:] != groups[:-1]
        first[:1] = True
        starts = np.flatnonzero(first & inside)
        kept = np.cumsum(inside, dtype=np.int32)
        offsets = np.append(kept[starts] - 1, kept[-1:]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(lower[inside])]), starts

    def _ids_of_runs(self, runs: list[bytes]) -> list[bytes]:
        tokenize = self.tokenizer.model.tokenize
        pieces = [run.decode() if run.isascii() else run.decode("latin-1").translate(self.table) for run in runs]
        made = [[token.id for token in tokenize(piece)] for piece in pieces]
        data, width = np.array([*chain.from_iterable(made)], self.kind).tobytes(), np.dtype(self.kind).itemsize
        ends = [*accumulate(len(ids) * width for ids in made)]
        return [data[start:end] for start, end in zip([0, *ends], ends)]

    def _ids_of_words(self, words: list[str]) -> list[bytes]:
        return [ids for start in range(0, len(words), 1000) for ids in self._ids_of_some(words[start : start + 1000])]

    def _ids_of_some(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, those of letters or letters and a mark as one text.

        That is if tokens tell by their spelling that a piece ends, and pieces are as many as such words have at least.
        """
        pieces = [(w, 1 if w.isalpha() else 2) for w in words if w.isalpha() or w[-1:] in self.MARKS and w[:-1].isalpha()] if len(words) > 1 else []
        found = {}
        if pieces and self.ends.any():
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(w for w, _ in pieces)], add_special_tokens=False)[0].ids, self.kind)
            at, upto = np.flatnonzero(self.ends[ids]) + 1, [*accumulate(n for _, n in pieces)]
            if len(at) == upto[-1]:
                ends, data = (at[np.array(upto) - 1] * ids.itemsize).tolist(), ids.tobytes()
                found = {w: data[start:end] for (w, _), start, end in zip(pieces, [0, *ends], ends)}
        rest = [w for w in words if w not in found]
        made = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else []
        found.update((w, np.array(e.ids, self.kind).tobytes()) for w, e in zip(rest, made))
        return [found[w] for w in words]

    def _segments(self, text: str) -> Iterator[tuple[bool, str]]:
        """The text cut into what is told by runs (true) and single or many words that are not."""
        odd = self.ODD if not any(token in text for token in self.added) else self.odd_or_added
        few = len(text) >> 4
        if self.table is None or sum(1 for _ in islice(odd.finditer(text), few + 1)) > few:
            yield False, text
            return
        at = 0
        while found := odd.search(text, at):
            start = max(text.rfind(" ", at, found.start()), text.rfind("\n", at, found.start()), at - 1) + 1
            end = BREAK.search(text, found.end())
            end = end.start() if end else len(text)
            yield True, text[at:start]
            yield False, text[start:end]
            at = end
        yield True, text[at:]

    def _by_runs(self, texts: list[str]) -> list[np.ndarray]:
        runs, starts = self._cut("\n".join(texts))
        coded = runs.dictionary_encode()
        ids = self.runs.learn(_listed(coded.dictionary), self._ids_of_runs)
        flat, codes = np.frombuffer(b"".join(ids), self.kind), coded.indices.to_numpy()
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // flat.itemsize
        at, sizes = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
        before = np.cumsum(sizes) - sizes
        found = flat[np.repeat(at - before, sizes) + np.arange(sizes.sum())]
        ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])[:-1])
        return np.split(found, np.append(before, len(found))[ends])

    def _by_words(self, texts: list[str]) -> list[np.ndarray]:
        cut = [text.replace("\n", " ").split(" ") for text in texts]
        words = [*dict.fromkeys(chain.from_iterable(cut))]
        ids = dict(zip(words, self.words.learn(words, self._ids_of_words)))
        return [np.frombuffer(b"".join(map(ids.__getitem__, some)), self.kind) for some in cut]

    def _parts(self, text: str) -> Iterator[str]:
        start = 0
        while start < len(text):
            found = BREAK.search(text, start + PIECE) if start + PIECE < len(text) else None
            end = found.end() if found else len(text)
            yield text[start:end]
            start = end

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [(i, told, some) for i, text in enumerate(texts) for part in self._parts(text) for told, some in self._segments(part)]
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for group in grouped([some for *_, some in parts]):
            of_group = parts[group.start : group.stop]
            runs, words = ([some for _, told, some in of_group if told == kind] for kind in (True, False))
            ids = {True: iter(self._by_runs(runs) if runs else []), False: iter(self._by_words(words) if words else [])}
            for i, told, _ in of_group:
                out[i].append(next(ids[told]))
        return [np.concatenate(found) if found else np.empty(0, self.kind) for found in out]


def word_encoder(path: str, kind: str) -> WordEncoder:
    """The encoder that this Python worker has from an earlier task, with what it remembers, or a new one."""
    kept = sys.modules.setdefault("streamweir_worker_memory", ModuleType("streamweir_worker_memory"))
    if getattr(kept, "words", (None, None))[0] != (path, kind):
        kept.words = (path, kind), WordEncoder(path, kind)
    return kept.words[1]


# --- minimal perfect hash ---------------------------------------------------------------


def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return mixed(keys + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)


def build_hash(keys: np.ndarray) -> list[np.ndarray]:
    """Levels of bits: a key that is alone in its bit of a level stays there, the others go on to the next."""
    levels = []
    while len(keys):
        size = max(64, int(GAMMA * len(keys)) + 63 & ~63)
        at = _slots(keys, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(np.packbits(alone, bitorder="little"))
        keys = keys[~alone[at]]
        if len(levels) > 200:
            raise ValueError("keys are not distinct")
    return levels


class PerfectHash:
    """Number of each stored key, 0 up to how many there are; any number or -1 for other keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.bits = [np.unpackbits(b, bitorder="little").view(bool) for b in levels]
        self.before = np.cumsum([0] + [int(b.sum()) for b in self.bits])
        self.ranks = [np.cumsum(b) - 1 for b in self.bits]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out, open = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, bits in enumerate(self.bits):
            at = _slots(keys[open], level, len(bits))
            here = bits[at]
            out[open[here]] = self.before[level] + self.ranks[level][at[here]]
            open = open[~here]
        return out


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


def write_index(out, keys: np.ndarray, shard: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
    """Header (levels, their bytes), the levels' bits, then an entry per key in the order of the hash."""
    levels = build_hash(keys)
    entries = np.zeros(len(keys), ENTRY)
    slot = PerfectHash(levels)(keys)
    entries["fingerprint"][slot], entries["shard"][slot], entries["at"][slot], entries["n"][slot] = _fingerprints(keys), shard, at, n
    out.write(np.array([len(levels), *[len(b) for b in levels]], "<u8").tobytes())
    for bits in levels:
        out.write(bits.tobytes())
    out.write(entries.tobytes())


class Index:
    """A part of the index in memory: keys to (found, shard, at, n)."""

    def __init__(self, data: bytes):
        head = np.frombuffer(data, "<u8", 1)[0]
        sizes = np.frombuffer(data, "<u8", head, 8).astype(int)
        at, levels = 8 + 8 * int(head), []
        for size in sizes:
            levels.append(np.frombuffer(data, np.uint8, size, at))
            at += size
        self.hash, self.entries = PerfectHash(levels), np.frombuffer(data, ENTRY, offset=at)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = self.hash(keys)
        entry = self.entries[np.maximum(slot, 0)] if len(self.entries) else np.zeros(len(keys), ENTRY)
        return (slot >= 0) & (entry["fingerprint"] == _fingerprints(keys)), entry


# --- the corpus -------------------------------------------------------------------------


def key_hash(key: Column, copy: Column) -> Column:
    """A document's key is its id and, for repeated ids, which of them it is."""
    return F.xxhash64(key.isNull(), key, copy)


class TokenCorpus:
    """Shards of ids with their index, in one folder; ``manifest`` and ``parts`` name the files that count."""

    def __init__(self, path: str, kind: str, manifest: DataFrame, parts: DataFrame, n_parts: int):
        self.path, self.kind, self.manifest, self.parts, self.n_parts = path, kind, manifest, parts, n_parts

    def located(self, keys: DataFrame) -> DataFrame:
        """The columns of ``keys`` (with LONG ``key_hash``) plus found, shard, at and n.

        Keys go to the part of the index that their hash names; each part is read once per task that needs it.
        """
        folder, n_parts = Folder(self.path), self.n_parts
        rows = keys.withColumn("part", F.pmod("key_hash", F.lit(n_parts)).cast("int")).join(self.parts, "part", "left")
        rows = rows.repartition("part").sortWithinPartitions("part")
        names = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields]

        def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            name, index = None, None
            for batch in batches:
                for file, own in batch.groupby("index_file", sort=False, dropna=False):
                    own = own.copy()
                    hashes = own["key_hash"].to_numpy(np.int64).view(np.uint64)
                    if file is None or file != file:
                        found, entry = np.zeros(len(own), bool), np.zeros(len(own), ENTRY)
                    else:
                        if file != name:
                            with folder.open(file) as f:
                                name, index = file, Index(f.read())
                        found, entry = index(hashes)
                    own["found"] = found
                    for c in ("shard", "at", "n"):
                        own[c] = entry[c].astype(np.int64)
                    yield own

        return rows.mapInPandas(look, ", ".join([*names, "found BOOLEAN", "shard LONG", "at LONG", "n LONG"])).drop("part", "index_file")

    def read(self, located: DataFrame, kind: str | None = None, batch_bytes: int = 4 << 20) -> DataFrame:
        """The found rows plus their ids as bytes (``ids``), read at their places, in file order.

        The number format is that of the files, or ``kind``. Rows leave a task when their ids come to ``batch_bytes``.
        """
        folder, stored, kind = Folder(self.path), self.kind, kind or self.kind
        width = np.dtype(stored).itemsize
        rows = located.where("found").join(self.manifest, "shard")
        rows = rows.repartition("shard", F.floor(F.col("at") / (1 << 22))).sortWithinPartitions("shard", "at")
        names = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields]

        def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            name, file = None, None
            for batch in batches:
                start, size, ids = 0, 0, []
                for i, (path, at, n) in enumerate(zip(batch["file"], batch["at"], batch["n"])):
                    if path != name:
                        name, file = path, folder.open(path)
                    file.seek(int(at) * width)
                    data = file.read(int(n) * width)
                    ids.append(data if kind == stored else np.frombuffer(data, stored).astype(kind).tobytes())
                    size += len(ids[-1])
                    if size >= batch_bytes or i + 1 == len(batch):
                        yield batch.iloc[start : i + 1].assign(ids=ids)
                        start, size, ids = i + 1, 0, []

        return rows.mapInPandas(fetch, ", ".join([*names, "ids BINARY"]))


def written(
    docs: DataFrame, encoder: Callable[[], WordEncoder], kind: str, end_id: int, text: str = "text", id: str = "doc_id",
    shard_bytes: int = 256 << 20, part_keys: int = 1 << 18,
) -> TokenCorpus:
    """Encodes every text, adds ``end_id``, and writes the ids in ascending order of the id.

    ``encoder`` makes an encoder inside a task; ``kind`` is the number format of the ids. Null ids come first, equal
    ids in the order of their texts (``copy`` 0, 1, ...), equal rows each on their own. Null and empty texts are
    the end id alone. Shards are ranges of the id, found by sampling, of at most about ``shard_bytes`` of text, less if
    that would leave cores idle; each is written by one task, whose memory is a batch of documents. Part files of
    the index hold at most about ``part_keys`` keys. An empty table makes no files. Columns other than id and text are not stored.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "tokens")
    folder = Folder(work.path)
    rows = docs.select(quoted(id).alias("doc_id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    n_rows, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    cores = spark.sparkContext.defaultParallelism
    n_shards = max(1, -(-size // shard_bytes), min(4 * cores, size >> 23))
    first = F.col("doc_id").asc_nulls_first()
    # ranges of the id alone: their sample goes to the driver and must not hold texts
    ranged = rows.repartitionByRange(n_shards, first).sortWithinPartitions(first, "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, name, out, at = encoder(), None, None, 0
        end = np.array([end_id], kind).tobytes()
        for batch in batches:
            if out is None:
                name = folder.new_name("ids/shard", ".bin")
                out = folder.create(name)
            for start in range(0, batch.num_rows, 256):  # texts leave Arrow a few at a time
                some = batch.slice(start, 256)
                texts, sizes = some.column("text").to_pylist(), []
                for rows in grouped(texts):
                    for ids in encode.encode([texts[i] for i in rows]):
                        out.write(ids.tobytes())
                        out.write(end)
                        sizes.append(len(ids) + 1)
                n = np.array(sizes, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(n)), some.column("doc_id"), pa.array(at + np.cumsum(n) - n), pa.array(n)],
                    ["file", "doc_id", "at", "n"],
                )
                at += int(n.sum())
        if out is not None:
            out.close()

    batch_rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch_rows)
    spark.conf.set(batch_rows, "1000")  # texts are long: the default would hold them by the ten thousand outside the heap
    try:
        placed = work.keep(ranged.mapInArrow(write, f"file STRING, doc_id {id_type}, at LONG, n LONG"))
    finally:
        spark.conf.set(batch_rows, before)
    files = placed.groupBy("file").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "at")).alias("first"), F.sum("n").alias("n_ids"))
    order = Window.orderBy("first.some", "first.doc_id", F.col("first.at").desc())
    manifest = work.keep(files.select(
        "file", "n_ids", (F.row_number().over(order) - 1).cast("long").alias("shard"),
        (F.sum("n_ids").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_ids")).alias("base"),
    ))
    n_parts = max(1, -(-n_rows // part_keys), min(8 * cores, n_rows >> 10))
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy("shard", "at")) - 1
    keyed = placed.join(manifest.select("file", "shard"), "file").select("shard", "at", "n", key_hash(F.col("doc_id"), copy).alias("key_hash"))
    keyed = keyed.withColumn("part", F.pmod("key_hash", F.lit(n_parts)).cast("int"))

    def index(group: pd.DataFrame) -> pd.DataFrame:
        name = folder.new_name("index/part", ".mph")
        with folder.create(name) as out:
            write_index(out, group["key_hash"].to_numpy(np.int64).view(np.uint64), *(group[c].to_numpy() for c in ("shard", "at", "n")))
        return pd.DataFrame({"part": [group["part"].iloc[0]], "index_file": [name]})

    parts = work.keep(keyed.groupBy("part").applyInPandas(index, "part INT, index_file STRING"))
    return TokenCorpus(work.path, kind, manifest.select("shard", "file", "base"), parts, n_parts)
