"""Against trying all pairs, and the cases that the docstrings name."""

import random
import re
from collections import defaultdict

import duckdb
import pytest
import xxhash

from streamweir.llm.queries import QUERIES
from streamweir.llm.simhash import fingerprint, one_of_each, simhash_components


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, k=3, bits=2):
    prints = {i: brute_fingerprint(t, k) for i, t in rows}
    distinct = sorted(set(prints.values()))
    up = {f: f for f in distinct}

    def top(f):
        while up[f] != f:
            f = up[f]
        return f

    for x, a in enumerate(distinct):
        for b in distinct[:x]:
            if (a ^ b).bit_count() <= bits:
                up[top(a)] = top(b)
    least = defaultdict(list)
    for i, f in prints.items():
        least[top(f)].append(i)
    return {(i, f"{f:016x}", min(least[top(f)])) for i, f in prints.items()}


def test_query_equals_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    got = {tuple(r) for r in QUERIES["op10_simhash_near_dedup"](spark, sf).collect()}
    assert got == brute_components(rows)


def test_nulls_blanks_long_texts_and_repeats(spark, documents):
    long = " ".join(f"w{i % 977}x{i}" for i in range(300_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One"), (6, "one two"), (7, long), (8, long + " end"), (9, "é È x y z")]
    got = {tuple(r) for r in simhash_components(documents(rows).select("doc_id", "text")).collect()}
    assert got == brute_components(rows)
    assert len(long) > 3 << 20


def test_a_chain_of_links_is_one_component(spark):
    from streamweir.llm.simhash import components_of_fingerprints
    from streamweir.llm.tables import Workspace

    prints = [sum(1 << b for b in range(2 * n)) for n in range(20)] + [7 << 61, (7 << 61) | (1 << 40)]
    rows = [(100 - n, f - (1 << 64) if f >> 63 else f) for n, f in enumerate(prints)]
    df = spark.createDataFrame(rows, "doc_id LONG, fp LONG")
    got = {r.fp: r.component_id for r in components_of_fingerprints(df, Workspace(spark, "test")).collect()}
    assert {got[f] for _, f in rows[:20]} == {81}
    assert {got[f] for _, f in rows[20:]} == {79}


def test_equal_rows_null_ids_extra_columns_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b c d", 1), (7, "a b c d", 2), (7, "a b c d", 2), (None, "q r s", 3)], "doc_id LONG, text STRING, node INT")
    got = sorted((tuple(r) for r in simhash_components(df).select("doc_id", "node", "component_id").collect()), key=str)
    assert got == sorted([(None, 1, 7), (7, 2, 7), (7, 2, 7), (None, 3, None)], key=str)
    assert simhash_components(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["", "a", "a b", "a b c", "A b C d", "x " * 50])
def test_fingerprint(text):
    assert fingerprint(text) == brute_fingerprint(text)


def families(n, seed):
    """Texts of 60 to 300 words, each with copies of which none to six words differ."""
    pick, texts = random.Random(seed), []
    for i in range(n):
        ws = [f"w{pick.randrange(4000)}" for _ in range(pick.randint(60, 300))]
        texts.append(" ".join(ws))
        for _ in range(pick.randint(0, 5)):
            copy = list(ws)
            for _ in range(pick.choice((0, 0, 1, 2, 6))):
                copy[pick.randrange(len(copy))] = "edited"
            texts.append(" ".join(copy).title() if pick.random() < 0.2 else " ".join(copy))
    return texts


@pytest.mark.parametrize("k, bits", [(3, 2), (2, 4), (5, 0)])
def test_one_of_each_equals_all_pairs(documents, k, bits):
    texts = families(60, k) + ["", " ", None, "a b", "A  B", "a b c", "w1 " * 200_000, "W1 " * 200_000]
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    want = {i for i, _, least in brute_components(rows, k, bits) if i == least}
    got = one_of_each(documents(rows), k=k, bits=bits)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {(r.doc_id, r.text) for r in got.collect()} == {(i, texts[i]) for i in want}
    assert got.count() == len(want) < len(texts) - 40


def test_one_of_each_has_no_odd_bits(documents):
    with pytest.raises(ValueError):
        one_of_each(documents([(1, "a")]), bits=3)


def test_one_of_each_of_odd_rows(spark):
    """Null and equal ids, equal rows, columns named like the operator's own, no rows."""
    a, b = "a b c d e f g", "q r s t u v w"
    rows = [
        (None, a, 1, "x"), (7, a, 2, None), (7, a, 2, None), (None, b, 3, "y"), (None, b, 3, "y"),
        (7, "other words of id seven", 4, "z"), (8, None, 5, "n"), (9, "", None, "m"), (None, " \n", 6, None),
    ]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, name INT, component_id STRING")
    got = one_of_each(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[1], rows[3], rows[5], rows[6]], key=str)
    assert one_of_each(df.limit(0)).count() == 0
    clashing = df.toDF("doc_id", "text", "turn", "fingerprint")
    assert sorted(map(tuple, one_of_each(clashing).collect()), key=str) == sorted([rows[1], rows[3], rows[5], rows[6]], key=str)


def test_one_of_each_of_a_hot_group(spark):
    """A third of the rows equal in every column, a third equal texts: each leaves one row."""
    same = "one text that is there again and again and again"
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS doc_id",
        f"CASE WHEN id % 3 < 2 THEN '{same}' ELSE concat_ws(' ', transform(sequence(1, 60), x -> sha2(cast(id * 100 + x AS STRING), 256))) END AS text",
    )
    got = one_of_each(df.repartition(7))
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == [-1, *range(2, 3000, 3)]
