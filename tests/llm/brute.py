"""Plain-Python answers."""

from __future__ import annotations

import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def alnum(text):
    return ALNUM.findall(lower(text))


def grams(ws, k):
    return [tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))] if ws else []


def jaccard(a, b, k=5):
    x, y = set(grams(words(a), k)), set(grams(words(b), k))
    return len(x & y) / len(x | y) if x | y else 1.0


def measures(text):
    ws = WORD.findall(text or "")
    windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    count = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)


def backoff(texts, order, alpha=0.4):
    """Log score, words and words backed off, by the counts of the other texts."""
    all = [words(t) for t in texts]
    count = [Counter(tuple(w[i : i + n]) for w in all for i in range(len(w) - n + 1)) for n in range(1, order + 1)]
    total, out = sum(map(len, all)), []
    for w in all:
        own = [Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) for n in range(1, order + 1)]
        score = backed = 0
        for i in range(len(w)):
            top = min(order, i + 1)
            for n in range(top, 0, -1):
                g = tuple(w[i - n + 1 : i + 1])
                c = count[n - 1][g] - own[n - 1][g]
                if c > 0 or n == 1:
                    below = count[n - 2][g[:-1]] - own[n - 2][g[:-1]] if n > 1 else max(1, total - len(w))
                    score += math.log(max(c, 0.5) / below) + (top - n) * math.log(alpha)
                    backed += n < top
                    break
        out.append((score, len(w), backed))
    return out
