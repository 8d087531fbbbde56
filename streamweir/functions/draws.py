"""Repeatable random values as plain column expressions.

Every value is a function of (seed, row id, slot), so a task that runs again
or a stream that is replayed makes the same rows, in any partitioning. The bits
come from an MD5 digest, which SQL engines agree on.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Digits of base 26 and the letters they stand for.
BASE26_DIGITS = "0123456789ABCDEFGHIJKLMNOP"
LETTERS = "abcdefghijklmnopqrstuvwxyz"

_BITS_HEX = 12  # 48 bits per number: no visible bias for ranges up to 10^9
_WORD = 10  # letters from one 60-bit draw


def digest(row_id: Column, seed: int, slot: str) -> Column:
    return F.md5(F.concat_ws("/", F.lit(str(seed)), F.lit(slot), row_id.cast("string")).cast("binary"))


def draw_int(row_id: Column, seed: int, slot: str, low: int, high: int) -> Column:
    """A LONG in low..high, both included."""
    bits = F.conv(F.substring(digest(row_id, seed, slot), 1, _BITS_HEX), 16, 10).cast("long")
    return F.pmod(bits, F.lit(high - low + 1)) + F.lit(low)


def draw_choice(row_id: Column, seed: int, slot: str, options: list[str]) -> Column:
    at = draw_int(row_id, seed, slot, 1, len(options)).cast("int")
    return F.element_at(F.array(*[F.lit(o) for o in options]), at)


def draw_time(row_id: Column, seed: int, slot: str, first_year: int, last_year: int) -> Column:
    """A timestamp from the start of first_year, over 365 days per year of the range."""
    days = 365 * (last_year - first_year + 1)
    seconds = draw_int(row_id, seed, slot, 0, days * 86400 - 1)
    start = F.unix_seconds(F.lit(f"{first_year}-01-01 00:00:00+00:00").cast("timestamp"))
    return F.timestamp_seconds(start + seconds)


def draw_word(row_id: Column, seed: int, slot: str, length: int) -> Column:
    """Lowercase letters. One digest gives two words of ten, read off in base 26."""
    words = []
    for n in range(-(-length // (2 * _WORD))):
        hexes = digest(row_id, seed, f"{slot}{n}")
        for start in (1, 17):
            number = F.conv(F.substring(hexes, start, 15), 16, 26)
            words.append(F.right(F.lpad(number, 16, "0"), F.lit(_WORD)))
    text = F.translate(F.concat(*words), BASE26_DIGITS, LETTERS)
    return F.substring(text, 1, length)
