"""Sentence pieces: exact merge-type encoding by backtracking, and decoding.

Merge-type encoding joins the best-scored pair of neighbours, the first of equals, until no
pair is a piece. Whether pieces are the encoding of their text can be told from neighbours
alone: a row of pieces is what merging makes of it exactly if every piece and every two
neighbours are. So the encoder takes the longest piece at each place (found by an Aho-Corasick
automaton) that its left neighbour allows, goes back where none is left, and notes in a field of bits
the places from which no way leads on. Every prefix of a text has one encoding, so a place needs no second visit.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from struct import pack
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from streamweir.llm.tables import packed, quoted, unpacked

SPACE = "▁"  # what the library writes for a space
PART = 1 << 20
BLOCK = 4096


class _Memory(dict):
    """Ids of chunks as bytes, made when first asked for. The older half goes when there are too many."""

    CHUNKS, CHARACTERS = 400_000, 4 << 20

    def __init__(self, make):
        self.make, self.before, self.characters = make, {}, 0

    def __missing__(self, chunk: str) -> bytes:
        ids = self.before.get(chunk)
        if ids is None:
            ids = self.make(chunk)
        if len(chunk) <= 256:
            self[chunk] = ids
            self.characters += len(chunk)
        return ids

    def trim(self) -> None:
        if len(self) > self.CHUNKS or self.characters > self.CHARACTERS:
            self.before, self.characters = dict(self), 0
            self.clear()


class PieceEncoder:
    """Ids of whole texts as the library gives them, for BPE models with byte fallback and without unused or user-defined pieces.

    The library normalises and names the pieces, their scores and their ids; the encoding is made here.
    If no piece goes on after a space that follows another character, the text is encoded chunk
    by chunk, a chunk being a run of spaces and what follows up to the next one; else as one chunk.
    """

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_file=path)
        special = [sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(sp.get_piece_size())]
        self.ids = {sp.id_to_piece(i): i for i, s in enumerate(special) if not s}
        self.scores = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(i == sp.unk_id() for i in self.bytes) or any(sp.is_unused(i) for i in range(len(special))):
            raise ValueError("not a model with byte fallback and without unused pieces")
        self.longest = max(map(len, self.ids), default=1)
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:  # a character is always found, and a piece that merging does not make never taken
            if len(piece) == 2 or len(piece) > 2 and self._merges(piece, ""):
                self.automaton.add_word(piece, (piece, len(piece) - 1))
        self.automaton.make_automaton()
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self.chunks = (lambda text: [text]) if crossing else re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
        self.cut = None if crossing else re.compile(f"[^{SPACE}](?={SPACE})")
        self.known = _Memory(self._ids_of)
        self.fitting: dict[tuple[str, str], bool] = {}

    def _merges(self, left: str, right: str) -> bool:
        """Whether merging makes exactly these two pieces of their characters (or the one, if there is no right)."""
        scores, parts, border = self.scores, [*left, *right], len(left)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return len(parts) == (2 if right else 1)
            if right and sum(map(len, parts[: at + 1])) == border:
                return False  # across the border
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, left: str, right: str) -> bool:
        if len(self.fitting) > 400_000:
            self.fitting.clear()
        fits = self.fitting[left, right] = self._merges(left, right)
        return fits

    def _found(self, text: str, start: int) -> list[list[str]]:
        """For each of a block of places the pieces that begin there, the longest last; a character is always one."""
        end = min(len(text), start + BLOCK)
        found = [[c] for c in text[start:end]]
        if len(text) == 1 or not len(self.automaton):
            return found
        for last, (piece, back) in self.automaton.iter(text, start, min(len(text), end + self.longest - 1)):
            if last - back < end:
                found[last - back - start].append(piece)
        return found

    def _pieces_of(self, text: str) -> list[str]:
        failed, taken, left = bytearray(len(text) + 1), [], []  # left: how many shorter pieces there were to try
        at, untried, first, found, fitting, last = 0, -1, 0, self._found(text, 0), self.fitting, None
        while at < len(text):
            if not first <= at < first + BLOCK:
                first = at // BLOCK * BLOCK
                found = self._found(text, first)
            options = found[at - first]
            if untried < 0:
                untried = len(options)
            while untried:
                untried -= 1
                piece = options[untried]
                if failed[at + len(piece)]:
                    continue
                if last is not None:
                    fits = fitting.get((last, piece))
                    if not (self._fits(last, piece) if fits is None else fits):
                        continue
                taken.append(piece)
                left.append(untried)
                at, untried, last = at + len(piece), -1, piece
                break
            else:
                failed[at] = 1
                at -= len(taken.pop())
                untried, last = left.pop(), taken[-1] if taken else None
        return taken

    def _ids_of(self, chunk: str) -> bytes:
        out: list[int] = []
        for piece in self._pieces_of(chunk):
            if piece in self.ids:
                out.append(self.ids[piece])
            else:
                out.extend([self.bytes[b] for b in piece.encode()])
        return pack(f"<{len(out)}I", *out)

    def _parts(self, text: str) -> Iterator[str]:
        """Parts of about a megabyte that end where a chunk does."""
        start = 0
        while start < len(text):
            found = self.cut.search(text, start + PART) if self.cut and start + PART < len(text) else None
            end = found.end() if found else len(text)
            yield text[start:end]
            start = end

    def encode(self, text: str) -> bytes:
        """All ids, with those of begin and end, as little-endian unsigned 32-bit numbers."""
        out = [pack("<I", self.library.bos_id())]
        for part in self._parts(self.library.normalize(text)):
            self.known.trim()
            out.append(b"".join(map(self.known.__getitem__, self.chunks(part))))
        out.append(pack("<I", self.library.eos_id()))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return self.library.decode(np.frombuffer(ids, "<u4").tolist())


def _encoder(path: str) -> PieceEncoder:
    """The encoder that this Python worker has from an earlier task, with what it remembers, or a new one."""
    kept = sys.modules.setdefault("streamweir_worker_memory", ModuleType("streamweir_worker_memory"))
    if getattr(kept, "pieces", (None, None))[0] != path:
        kept.pieces = path, PieceEncoder(path)
    return kept.pieces[1]


def encoded(docs: DataFrame, path: str, text: str = "text", keep_text: bool = True, decode: bool = False, batch_bytes: int = 4 << 20) -> DataFrame:
    """The columns plus ``ids`` (little-endian unsigned 32-bit numbers, begin and end included) and, if asked for, ``decoded``.

    A null text is encoded as an empty one: the begin and end ids alone. Blank texts have the pieces of their spaces.
    A very long text is encoded a megabyte at a time, a very long word in blocks. Equal rows stay as many as they
    were and get equal ids. Other columns are carried along; those named like a result give way to it. An empty
    table gives no rows. ``path`` is a file that every executor has.
    """
    columns = [c for c in docs.columns if keep_text or c != text]
    rows = packed(docs, columns, text=quoted(text).cast("string"))
    schema = StructType([rows.schema["row"], StructField("ids", BinaryType()), StructField("decoded", StringType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoder = _encoder(path)
            texts, start, size, ids, back = batch.column("text"), 0, 0, [], []
            for i in range(batch.num_rows):
                found = encoder.encode(texts[i].as_py() or "")
                ids.append(found)
                back.append(encoder.decode(found) if decode else None)
                size += len(ids[-1])
                if size >= batch_bytes or i + 1 == batch.num_rows:
                    given = batch.column("row").slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays([given, pa.array(ids, pa.binary()), pa.array(back, pa.string())], ["row", "ids", "decoded"])
                    start, size, ids, back = i + 1, 0, [], []

    results = ["ids", "decoded"] if decode else ["ids"]
    return unpacked(rows.mapInArrow(encode, schema), columns, *results, names=results)
