"""Conversations as training text, with the parts that count towards the loss.

Turns are collected per conversation and sorted, neighbours of one role are merged into one block,
and blocks are joined between markers. Control strings inside texts are escaped, so that the
formatted text can be read back to the very turns. Spark expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from streamweir.llm.tables import quoted

# Everything of the template starts with OPEN; in texts that character is written as ESCAPE + "o", and
# ESCAPE as ESCAPE twice. So OPEN never comes from a text, and neither does a marker of another template
# that a tokenizer might take for control: their first characters are escaped as well.
ESCAPE = "\\"
CONTROL = {"␂": "o", "<": "l", "[": "b"}
OPEN = "␂"
ROLE, TEXT, PART, END = f"{OPEN}role:", f"{OPEN}text:", f"{OPEN}part:", f"{OPEN}end:"


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + ESCAPE))
    for character, letter in CONTROL.items():
        out = F.replace(out, F.lit(character), F.lit(ESCAPE + letter))
    return out


def unescaped(text: Column) -> Column:
    """Escaped escapes are set aside first, so that the letter after one is not taken for its own."""
    parts = F.transform(F.split(text, r"\\\\"), _plain)
    return F.array_join(parts, ESCAPE)


def _plain(part: Column) -> Column:
    for character, letter in CONTROL.items():
        part = F.replace(part, F.lit(ESCAPE + letter), F.lit(character))
    return part


def blocks(turns: Column) -> Column:
    """Sorted turns (role, text) to blocks (role, texts): neighbours of one role become one block."""
    starts = F.filter(
        F.transform(turns, lambda t, i: F.when((i == 0) | ~t["role"].eqNullSafe(F.get(turns, i - 1)["role"]), i).otherwise(F.lit(-1))),
        lambda i: i >= 0,
    )
    return _let(starts, lambda bound: F.transform(bound, lambda at, n: F.struct(
        turns[at]["role"].alias("role"),
        F.transform(F.slice(turns, at + 1, F.coalesce(F.get(bound, n + 1), F.size(turns)) - at), lambda t: t["text"]).alias("texts"),
    )))


def _chunks(items: Column) -> Column:
    """The items in about as many chunks as a chunk has items; one empty chunk of none.

    What costs the square of the length of an array, or a walk from the start of a text for each item, is done per
    chunk and once for the chunks.
    """
    n = F.greatest(F.size(items), F.lit(1))
    width = F.ceil(F.sqrt(n)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1, width), lambda at: F.slice(items, at + 1, width))


def _spans(pieces: Column) -> Column:
    """Start and length of the texts under the loss in all pieces together."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def span(s: Column, p: Column) -> Column:
        start, length = s["at"] + F.length(p["lead"]), F.length(p["text"])
        spans = F.when(p["loss"], F.concat(s["spans"], F.array(F.struct(start.alias("start"), length.alias("length"))))).otherwise(s["spans"])
        return F.struct((start + length + F.length(p["tail"])).alias("at"), spans.alias("spans"))

    def placed(chunks: Column) -> Column:
        begin = F.aggregate(chunks, F.array(F.lit(0)), lambda o, c: F.concat(o, F.array(F.element_at(o, -1) + c["at"])))
        return _let(begin, lambda before: F.flatten(F.transform(chunks, lambda c, i: F.transform(
            c["spans"], lambda s: F.struct((s["start"] + F.get(before, i)).alias("start"), s["length"].alias("length")),
        ))))

    return _let(F.transform(_chunks(pieces), lambda c: F.aggregate(c, state, span)), placed)


def formatted(
    conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """``conv_id, formatted, loss``: one text per conversation, and where its loss is.

    ``loss`` has a struct (start, length) in code points for every text of ``loss_role``, in order; markers are
    outside. Turns are sorted by their number, nulls first; equal numbers by role and text. Null roles and
    texts count as empty. Rows with a null id are one conversation, whose id is null. Equal rows stay
    as many as they were. One conversation is one text and hence one row. Other columns are left out. An
    empty table gives no rows.
    """
    own = F.struct(quoted(turn).alias("turn"), *[F.coalesce(quoted(c), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    rows = conversations.select(quoted(id).alias("conv_id"), own.alias("own"))
    sorted = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("own")).alias("turns"))
    merged = sorted.select("conv_id", _let(F.col("turns"), blocks).alias("blocks"))
    # what stands in front of every text, and the text, as pieces: the mask adds up their lengths
    lead = lambda b, i: F.when(i == 0, F.concat(F.lit(ROLE), escaped(b["role"]), F.lit(TEXT))).otherwise(F.lit(PART))
    pieces = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda t, i: F.struct(
        lead(b, i).alias("lead"), escaped(t).alias("text"),
        F.when(i == F.size(b["texts"]) - 1, END).otherwise("").alias("tail"), (b["role"] == loss_role).alias("loss"),
    ))))
    cut = merged.select("conv_id", pieces.alias("pieces"))
    whole = F.array_join(F.transform("pieces", lambda p: F.concat(p["lead"], p["text"], p["tail"])), "")
    return cut.select("conv_id", whole.alias("formatted"), _spans(F.col("pieces")).alias("loss"))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def turns_of(formatted: Column) -> Column:
    """The formatted text back to its turns (role, text), merged ones apart."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = F.replace(F.substring_index(block, TEXT, 1), F.lit(ROLE), F.lit(""))
        texts = F.split(F.substring_index(block, TEXT, -1), PART)
        return F.transform(texts, lambda t: F.struct(unescaped(role).alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""

    def of_chunk(spans: Column) -> Column:
        start, end = F.get(spans, 0)["start"], F.get(spans, F.size(spans) - 1)
        part = F.substring(formatted, start + 1, end["start"] + end["length"] - start)
        return _let(F.struct(start.alias("start"), part.alias("text")), lambda p: F.array_join(
            F.transform(spans, lambda s: unescaped(F.substring(p["text"], s["start"] - p["start"] + 1, s["length"]))), "",
        ))

    return F.array_join(F.transform(_chunks(loss), of_chunk), "")
