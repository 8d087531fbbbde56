"""Words of a text, inside Python tasks and as column expressions.

Texts are cut at white space into pieces of about a megabyte, so that a very
long text never becomes one list of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, functions as F

WHITE = b" \t\n\x0b\x0c\r"
PIECE = 1 << 20

# bytes to bytes: A-Z to a-z, white space to spaces
LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if c in WHITE else c for c in range(256))
# the same, and everything else in ASCII that is no letter or digit to a space
ALNUM = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in LOWER)


def encoded(text: str | None, table: bytes) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(table)


def cuts(data: bytes) -> Iterator[tuple[int, int]]:
    """Ends of parts of a megabyte or less that no word crosses (one longer word stays whole)."""
    start = 0
    while start < len(data):
        end = min(len(data), start + PIECE)
        if end < len(data):
            at = data.rfind(b" ", start, end)
            end = at if at > start else data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield start, end
        start = end


def pieces(text: str | None, table: bytes) -> Iterator[list[bytes]]:
    """The words of the text in order, as lists of a megabyte of text or less."""
    data = encoded(text, table)
    for start, end in cuts(data):
        yield data[start:end].split()


class WordHashes:
    """64-bit hashes of words: values of a polynomial over their bytes, from running sums over the text."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.powers = self.inverses = np.empty(0, np.uint64)

    def _reach(self, n: int) -> None:
        if n > len(self.powers):
            n = max(n, PIECE + 1)
            ones = np.ones(n, np.uint64)
            ones[1:] = self.BASE
            self.powers = np.cumprod(ones)
            ones[1:] = pow(self.BASE, -1, 1 << 64)
            self.inverses = np.cumprod(ones)

    def of_part(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of some bytes, and where they start."""
        self._reach(len(data))
        letter = np.zeros(len(data) + 2, bool)
        np.not_equal(data, 32, out=letter[1:-1])
        edges = np.flatnonzero(letter[1:] != letter[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts]), starts

    def of_all(self, texts: list[str | None], table: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of all texts, and up to which of them each text goes."""
        data = [encoded(t, table) for t in texts]
        ends = np.cumsum([len(d) + 1 for d in data])
        joined = b" ".join(data)
        found = [(h, s + start) for start, end in cuts(joined) for h, s in [self.of_part(np.frombuffer(joined, np.uint8, end - start, start))]]
        if not found:
            return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
        hashes, starts = (np.concatenate(x) for x in zip(*found))
        return hashes, np.searchsorted(starts, ends)

    def of(self, text: str | None, table: bytes) -> np.ndarray:
        return self.of_all([text], table)[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit (the finaliser of a 64-bit hash)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles; fewer words are one shingle, no words none."""
    if len(words) == 0:
        return words
    k = min(k, len(words))
    out = words[: len(words) - k + 1].copy()
    for j in range(1, k):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[j : j + len(out)]
    return mixed(out)


def grouped(texts: list[str | None], most: int = PIECE) -> Iterator[range]:
    """Numbers of consecutive texts that come to about a megabyte together (or so many characters)."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield range(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield range(start, len(texts))


def split_words(text: Column) -> Column:
    """The words between white space, as an array; none for null and blank texts."""
    trimmed = F.btrim(text, F.lit(WHITE.decode()))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))
