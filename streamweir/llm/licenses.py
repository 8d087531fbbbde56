"""License phrases, and blocks of text that contain a license notice nearly whole.

The notices are sets of words. Blocks of a document overlap by half, so that any passage as long
as a notice lies within one block. An exact join of sets finds every block that has enough of a
notice's words: words are ordered by how often they occur in all documents, rare ones first;
a block and a notice that have enough words in common must meet in their first few, and
not too far from the front of either.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.functions import PandasUDFType
from pyspark.sql.types import StructType

from streamweir.llm.tables import Workspace, packed, quoted, unpacked
from streamweir.llm.words import ALNUM, pieces

# Phrases and labels of the base search
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices as their licenses word them
NOTICES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
     "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
]
CONTAINMENT = 0.9

FOUND = (
    "row_id LONG, n_words LONG, n_base LONG, first_word LONG, last_word LONG, base_labels ARRAY<STRING>, "
    "blocks ARRAY<STRUCT<kind: INT, words: ARRAY<INT>>>, counts ARRAY<LONG>"
)


class _Ids(dict):
    """Word to its number in the vocabulary, -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


class Notices:
    """The notices' words as numbers, and per kind of length (a power of two) what a block needs at least."""

    def __init__(self, notices: list[tuple[str, str]], containment: float):
        words = [sorted({w for p in pieces(text, ALNUM) for w in p}) for _, text in notices]
        lengths = [sum(len(p) for p in pieces(text, ALNUM)) for _, text in notices]
        known = {w for ws in words for w in ws} | {w.encode() for p in PHRASES for w in p.split()}
        self.ids = _Ids({w: i for i, w in enumerate(sorted(known))})
        self.labels = [label for label, _ in notices]
        self.sets = [[self.ids[w] for w in ws] for ws in words]
        self.kinds = [1 << max(0, (n - 1).bit_length()) for n in lengths]
        self.needs = [ceil(containment * len(s) - 1e-9) for s in self.sets]
        self.least = {k: min(n for n, own in zip(self.needs, self.kinds) if own == k) for k in set(self.kinds)}
        self.members = {k: np.isin(np.arange(len(self.ids)), [i for s, own in zip(self.sets, self.kinds) if own == k for i in s]) for k in set(self.kinds)}


def _blocks(ids: np.ndarray, notices: Notices) -> list[tuple[int, list[int]]]:
    """(kind, word numbers) of the blocks that have as many of the vocabulary's words as some notice needs."""
    out = []
    at = np.flatnonzero(ids >= 0)
    for kind, least in notices.least.items():
        mine = at[notices.members[kind][ids[at]]]
        if len(mine) < least:
            continue
        half = mine // kind
        # block i holds halves i and i + 1, so a word is in its own block and in the one before
        pairs = np.unique(np.concatenate([half, np.maximum(half - 1, 0)]) * len(notices.ids) + np.tile(ids[mine], 2))
        block, first, n = np.unique(pairs // len(notices.ids), return_index=True, return_counts=True)
        for i in np.flatnonzero(n >= least):
            out.append((kind, (pairs[first[i] : first[i] + n[i]] % len(notices.ids)).tolist()))
    return out


def _searcher(notices: Notices):
    """Texts to the fields of FOUND; the last row of each batch also has the batch's word counts."""
    phrases = [([notices.ids[w.encode()] for w in p.split()], label) for p, label in PHRASES.items()]
    size = len(notices.ids)

    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        row_id = TaskContext.get().partitionId() << 40
        for texts in batches:
            rows, counts = [], np.zeros(size, np.int64)
            for text in texts:
                parts = [np.fromiter(map(notices.ids.__getitem__, p), np.int32, len(p)) for p in pieces(text, ALNUM)]
                ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
                counts += np.bincount(ids[ids >= 0], minlength=size)
                starts, labels = [], []
                for phrase, label in phrases:
                    n = max(0, len(ids) - len(phrase) + 1)
                    places = np.flatnonzero(np.logical_and.reduce([ids[j : j + n] == w for j, w in enumerate(phrase)]))
                    if len(places):
                        starts.append(places)
                        labels.append(label)
                all = np.concatenate(starts) if starts else None
                span = (len(all), int(all.min()), int(all.max())) if starts else (0, None, None)
                rows.append((row_id, len(ids), *span, sorted(labels), _blocks(ids, notices), None))
                row_id += 1
            out = pd.DataFrame(rows, columns=["row_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks", "counts"])
            if len(out):
                out.at[len(out) - 1, "counts"] = counts
            yield out.astype({c: "Int64" for c in ("first_word", "last_word")})

    return search


def _joined(blocks: DataFrame, notices: Notices, ranks: list[int]) -> DataFrame:
    """``row_id, label, containment`` for every block and notice with enough words in common."""
    spark = blocks.sparkSession
    sets = [sorted(ranks[i] for i in s) for s in notices.sets]
    first = [
        (kind, rank, place, label, need, s)
        for label, kind, need, s in zip(notices.labels, notices.kinds, notices.needs, sets)
        for place, rank in enumerate(s[: len(s) - need + 1])
    ]
    right = spark.createDataFrame(first, "t_kind INT, t_word INT, t_place INT, label STRING, need INT, notice ARRAY<INT>")
    order = F.lit(ranks)
    least = F.create_map(*[F.lit(x) for k, n in notices.least.items() for x in (k, n)])
    ordered = blocks.select("row_id", "kind", F.array_sort(F.transform("words", lambda w: F.element_at(order, w + 1))).alias("words"))
    # a block's prefix is long enough for the notice of its kind that needs the fewest words
    prefix = F.slice("words", F.lit(1), F.greatest(F.size("words") - least[F.col("kind")] + 1, F.lit(0)))
    left = ordered.select("row_id", "kind", "words", F.posexplode(prefix).alias("place", "word"))
    met = left.join(right, (F.col("kind") == F.col("t_kind")) & (F.col("word") == F.col("t_word")))
    # the first common word decides: up to it and from it on, no more words can be common than fit
    beyond = F.least(F.size("words") - F.col("place"), F.size("notice") - F.col("t_place"))
    enough = (F.size("words") >= F.col("need")) & (beyond >= F.col("need"))
    is_first = F.array_min(F.array_intersect("words", "notice")) == F.col("word")
    common = F.size(F.array_intersect("words", "notice"))
    return met.where(enough).where(is_first & (common >= F.col("need"))).select("row_id", "label", (common / F.size("notice")).alias("containment"))


def licensed(
    docs: DataFrame, text: str = "text", keep_text: bool = True,
    notices: list[tuple[str, str]] = NOTICES, containment: float = CONTAINMENT,
) -> DataFrame:
    """The columns plus a struct ``license``: n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of letters and digits, A-Z lower-cased. ``n_base`` counts the places of the
    phrases, ``first_word`` and ``last_word`` are the smallest and largest of them (null if none). Labels
    are those of phrases and of notices of whose distinct words a block has at least the share
    ``containment``; both sorted. The score is the largest share that was found, 1 for a phrase, 0 for
    nothing. Null and empty texts have no words. Equal rows get equal results. A column named license
    gives way to it. The notices are a parameter and small; nothing else is handed to tasks. An empty
    table gives no rows.
    """
    work, known = Workspace(docs.sparkSession, "licenses"), Notices(notices, containment)
    columns = [c for c in docs.columns if keep_text or c != text]
    search = F.pandas_udf(_searcher(known), StructType.fromDDL(FOUND), PandasUDFType.SCALAR_ITER)
    found = work.keep(packed(docs, columns, found=search(quoted(text))))

    counts = {r["word"]: r["n"] for r in found.where("found.counts IS NOT NULL").select(
        F.posexplode("found.counts").alias("word", "n")).groupBy("word").agg(F.sum("n").alias("n")).collect()}
    ranks = [0] * len(known.ids)  # by frequency in all documents, rarest first
    for rank, word in enumerate(sorted(range(len(ranks)), key=lambda w: (counts.get(w, 0), w))):
        ranks[word] = rank

    blocks = found.select("found.row_id", F.explode("found.blocks").alias("b")).select("row_id", "b.kind", "b.words")
    met = _joined(blocks, known, ranks).groupBy("row_id").agg(
        F.collect_set("label").alias("labels"), F.max("containment").alias("containment")
    ).withColumnRenamed("row_id", "of_row")
    x, none = F.col("found"), F.array().cast("array<string>")
    score = F.greatest(F.coalesce("containment", F.lit(0.0)), F.when(x["n_base"] > 0, 1.0).otherwise(0.0))
    license = F.struct(
        x["n_words"].alias("n_words"), x["n_base"].alias("n_base"), x["first_word"].alias("first_word"), x["last_word"].alias("last_word"),
        F.array_join(x["base_labels"], ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(x["base_labels"], F.coalesce("labels", none))), ",").alias("labels"), score.alias("score"),
    ).alias("license")
    joined = found.join(met, F.col("found.row_id") == F.col("of_row"), "left")
    return unpacked(joined, columns, license, names=["license"])
