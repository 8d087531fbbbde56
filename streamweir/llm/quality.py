"""Quality by weak supervision: rules vote or abstain, and a posterior decides.

Every rule says good, bad or nothing about a document. How far each rule can be trusted
is estimated by expectation-maximisation over the counts of all vote patterns, without
labels. A document stays if it is more probably good than bad. DataFrame functions only.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame, functions as F

from streamweir.llm.tables import Workspace, packed, quoted, unpacked
from streamweir.llm.words import WHITE, split_words

SYMBOLS = "#*$%&|<>"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body over a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _length_without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _in_repeats(windows: Column) -> Column:
    """Of the words in 3-word windows, how many are in a window found twice or more.

    Windows that are all different, as in most texts, are told by a hash set. Else equal
    ones are brought together by sorting; a repeated window adds the words up to the next one.
    """

    def covered(ordered: Column) -> Column:
        same = lambda e, i: (e["h"] == F.get(ordered, i - 1)["h"]) | (e["h"] == F.get(ordered, i + 1)["h"])
        places = F.array_sort(F.transform(F.filter(ordered, lambda e, i: F.coalesce(same(e, i), F.lit(False))), lambda e: e["i"]))
        return _let(places, lambda at: F.aggregate(
            F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))), F.lit(0), lambda n, x: n + x,
        ))

    numbered = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(F.array_sort(numbered), covered))


def _of_words(words: Column) -> Column:
    n = F.size(words)
    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.struct(
        n.cast("long").alias("n_words"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct_words"),
        _let(windows, _in_repeats).cast("long").alias("n_repeat_words"),
    )


def _of_lines(lines: Column) -> Column:
    n = F.size(lines)
    return F.struct(n.cast("long").alias("n_lines"), (n - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))


def measured(docs: DataFrame, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """The columns as a struct ``row``, and one struct ``measures`` of what the rules look at; a null text has no words."""
    t = F.coalesce(quoted(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE.decode()))) > 0)
    parts = packed(
        docs, columns,
        words=_let(split_words(t), _of_words),
        lines=_let(lines, _of_lines),
        word_chars=_length_without(t, WHITE.decode()).cast("long"),
        n_symbols=(F.length(t) - _length_without(t, SYMBOLS)).cast("long"),
        n_digits=(F.length(t) - _length_without(t, "0123456789")).cast("long"),
        n_marks=(F.length(t) - _length_without(t, MARKS)).cast("long"),
    )
    w, x = F.col("words"), F.col("lines")
    failed = (w["n_words"] < 50) | (100 * w["n_repeat_words"] > 50 * w["n_words"])
    # a generator: what is asked of the measures further up cannot be moved below it and computed again for each question
    return parts.select("row", F.explode(F.array(F.struct(
        w["n_words"].alias("n_words"), "word_chars", "n_symbols", x["n_dup_lines"].alias("n_dup_lines"),
        w["n_repeat_words"].alias("n_repeat_words"), w["n_distinct_words"].alias("n_distinct_words"),
        x["n_lines"].alias("n_lines"), "n_digits", "n_marks", failed.alias("base_failed"),
    ))).alias("measures"))


@dataclass(frozen=True)
class Rule:
    """Votes bad or good where the SQL condition over the measures holds; bad wins, neither abstains."""

    name: str
    bad: str
    good: str


RULES = [
    Rule("length", "n_words < 50", "n_words >= 80"),
    Rule("repeated words", "100 * n_repeat_words > 50 * n_words", "100 * n_repeat_words <= 20 * n_words"),
    Rule("word length", "word_chars < 2 * n_words OR word_chars > 15 * n_words", "word_chars BETWEEN 3 * n_words AND 12 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("letters", "5 * n_marks > word_chars", "8 * n_marks <= word_chars"),
    Rule("repeated lines", "10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0 AND n_lines > 1"),
    Rule("digits", "5 * n_digits > word_chars", "20 * n_digits <= word_chars"),
    Rule("vocabulary", "10 * n_distinct_words < n_words", "10 * n_distinct_words >= 3 * n_words"),
]


def vote_code(rules: list[Rule], measures: str = "measures") -> Column:
    """The votes as one number to base three: 0 abstains, 1 is good, 2 is bad."""

    def over(condition: str) -> Column:
        return F.expr(re.sub(r"\b(n_\w+|word_chars)\b", rf"{measures}.\1", condition))

    code = F.lit(0)
    for rule in rules:
        code = code * 3 + F.when(over(rule.bad), 2).when(over(rule.good), 1).otherwise(0)
    return code


@dataclass
class VoteModel:
    """Share of good documents, and how often each rule is right when it votes: on good and on bad ones."""

    prior: float
    on_good: list[float]
    on_bad: list[float]

    def posterior(self, votes: list[int]) -> float:
        odds = log(self.prior / (1 - self.prior))
        for vote, g, b in zip(votes, self.on_good, self.on_bad):
            odds += log(g / (1 - b)) if vote > 0 else log((1 - g) / b) if vote < 0 else 0.0
        return 1 / (1 + exp(-odds)) if odds > -700 else 0.0


def votes_of(code: int, n: int) -> list[int]:
    """One of -1, 0, 1 per rule."""
    return [{0: 0, 1: 1, 2: -1}[code // 3 ** (n - 1 - r) % 3] for r in range(n)]


def fit(counts: dict[int, int], n_rules: int, rounds: int = 100) -> VoteModel:
    """Expectation-maximisation over the counts of the vote patterns (3 ** n_rules at most).

    Most documents pass most rules, bad ones too, so a rule is often right on good documents and may seldom be
    on bad ones: a bad vote says much and a good one little. The estimates are held where a vote never speaks for
    its opposite, and the prior between 0.5 and 0.95: documents are presumed good. Without counts this is the start.
    """
    model = VoteModel(0.8, [0.95] * n_rules, [0.4] * n_rules)
    patterns = [(votes_of(code, n_rules), n) for code, n in sorted(counts.items())]
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        weighed = [(votes, n, model.posterior(votes)) for votes, n in patterns]
        prior = (sum(n * q for _, n, q in weighed) + 8) / (total + 10)
        on_good, on_bad = [], []
        for r in range(n_rules):
            cast = [(votes[r], n * q, n * (1 - q)) for votes, n, q in weighed if votes[r]]
            g = (sum(q for v, q, _ in cast if v > 0) + 9.5) / (sum(q for _, q, _ in cast) + 10)
            b = (sum(p for v, _, p in cast if v < 0) + 4) / (sum(p for *_, p in cast) + 10)
            on_good.append(min(0.995, max(0.55, g)))
            on_bad.append(min(0.99, max(1.02 - on_good[-1], b)))
        model = VoteModel(min(0.95, max(0.5, prior)), on_good, on_bad)
    return model


def judged(docs: DataFrame, text: str = "text", keep_text: bool = True, rules: list[Rule] = RULES) -> DataFrame:
    """The columns plus structs ``measures`` and ``verdict`` (votes as a number, probability, kept).

    A document with fewer than 50 words, or with more than half of its words in repeated
    windows, is not kept; any other is kept if its probability of being good is a half or
    more. A document that no rule calls bad always is. Null, empty and blank texts have no
    words and are not kept. Equal rows get equal verdicts. Counts of patterns cover all rows that the
    first two conditions leave open; only they reach the driver, 3 ** rules numbers at most. Columns named like a result give way to it.
    An empty table gives an empty result.
    """
    work = Workspace(docs.sparkSession, "quality")
    columns = [c for c in docs.columns if keep_text or c != text]
    # written, texts too: measuring them a second time costs far more than reading them back
    rows = work.keep(measured(docs, text, columns).withColumn("code", vote_code(rules)))
    # those that fail the base are decided; the rules are weighed on the others
    counts = {r["code"]: r["count"] for r in rows.where("NOT measures.base_failed").groupBy("code").count().collect()}
    model = fit(counts, len(rules))
    chances = F.lit([model.posterior(votes_of(code, len(rules))) for code in range(3 ** len(rules))])
    chance = F.element_at(chances, F.col("code") + 1)
    verdict = F.struct(
        F.col("code"), chance.alias("probability"), (~F.col("measures.base_failed") & (chance >= 0.5)).alias("kept")
    ).alias("verdict")
    return unpacked(rows, columns, F.col("measures"), verdict, names=["measures", "verdict"])
