"""Operators on documents against brute force, at the smallest scale and in planted cases."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from streamweir.llm import decontaminate, licenses, lm, mixing, quality, sharding, tokens
from streamweir.llm.queries import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


def made(n, seed=1):
    pick = random.Random(seed)
    return [" ".join("".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 7))) for _ in range(pick.randint(60, 90))) for _ in range(n)]


# --- quality ---


def test_measures(spark, given):
    rows = QUERIES["op9_quality_rules"](spark, SF).collect()
    assert {(r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in rows} == {(d, brute.measures(t)) for d, t in given}
    assert not any(r.kept and r.base_failed for r in rows)


@pytest.mark.parametrize("text", ["a b c a b c", "a a a a", "a b c d a b c", "x\nx\n\nx \n x", "a b a b a b a b c", "é\x0bf\x0cg # $", " a  b\tc\r\nd "])
def test_measures_of_small_texts(spark, documents, text):
    m = quality.measured(documents([(1, text)])).select("measures.*").first()
    assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed) == brute.measures(text)


def test_good_texts_stay_and_junk_goes(spark, documents):
    good, pick = made(200), random.Random(2)
    junk = ["".join(f"{w}$#% " for w in t.split()) + "&& 12345 " * 40 for t in made(40, 3)] + ["ab " * 60] * 5 + ["few words"] * 5
    rows = quality.judged(documents(list(enumerate(good + junk)))).select("doc_id", "verdict.kept", "verdict.probability").collect()
    assert {r.doc_id for r in rows if r.kept} == set(range(200))
    assert pick and all(0 <= r.probability <= 1 for r in rows)


def test_accuracies_are_recovered():
    pick, on_good, on_bad, counts = random.Random(4), [0.95, 0.9, 0.85, 0.9], [0.6, 0.8, 0.5, 0.7], Counter()
    for _ in range(100_000):
        good, code = pick.random() < 0.8, 0
        for g, b in zip(on_good, on_bad):
            right = pick.random() < (g if good else b)
            code = code * 3 + (0 if pick.random() < 0.2 else 1 if good == right else 2)
        counts[code] += 1
    model = quality.fit(dict(counts), 4)
    assert model.prior == pytest.approx(0.8, abs=0.05)
    assert model.on_good == pytest.approx(on_good, abs=0.05)
    assert model.on_bad == pytest.approx(on_bad, abs=0.1)
    assert quality.fit({}, 4).posterior([1, 0, 1, 0]) > 0.8


# --- sharding ---


def sizes_of(rows):
    out = defaultdict(int)
    for r in rows:
        out[r.shard] += r.size
    return out


def check_shards(rows):
    for shard in range(8):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_shards_of_documents(spark, given):
    rows = QUERIES["op4_sharding"](spark, "/root/testdata/sf0.1").collect()
    check_shards(rows)
    sizes = sizes_of(rows)
    assert max(sizes.values()) < 1.02 * min(sizes.values())
    rows = QUERIES["op4_sharding"](spark, SF).collect()
    check_shards(rows)
    text = dict(given)
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {(d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in text.items()}
    shards = defaultdict(set)
    for r in rows:
        shards[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_a_third_of_all_rows_with_one_text(spark):
    rows = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("text "), "id")).alias("text"), F.lit(1).alias("slot"),
    )
    got = sharding.sharded(rows.withColumn("size", F.octet_length("text").cast("long") + 1), F.col("size")).collect()
    check_shards(got)
    sizes = sizes_of(got)
    assert len(sizes) == 8 and max(sizes.values()) < 1.02 * min(sizes.values())


def test_groups_under_the_limit_stay_together(spark):
    """A third of all rows has one short text, and small groups of long texts are in ranges that are cut again."""
    text = F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 500 == 1, F.concat(F.lit("group "), F.floor(F.col("id") / 5000), F.repeat(F.lit("x"), 3000)))
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), text.otherwise(F.concat(F.repeat(F.lit("y"), 300), "id")).alias("text"))
    rows = rows.withColumn("size", F.octet_length("text").cast("long") + 1)
    for ranges, sample in ((1024, 8192), (8, 64)):
        got = sharding.sharded(rows, F.col("size"), ranges=ranges, sample=sample).collect()
        check_shards(got)
        shards, of_text = defaultdict(set), Counter()
        for r in got:
            shards[r.text].add(r.shard)
            of_text[r.text] += r.size
        limit = 0.05 * sum(of_text.values()) / 8
        assert len(of_text) > 19_000 and max(of_text.values()) < limit and all(len(s) == 1 for s in shards.values())
        sizes = sizes_of(got)
        assert len(sizes) == 8 and max(sizes.values()) < (1.06 if ranges > 8 else 2.5) * min(sizes.values())


def test_equal_rows_and_one_row(spark, documents):
    rows = documents([(1, "x")] * 40).withColumn("size", F.lit(2).cast("long"))
    check_shards(sharding.sharded(rows, F.col("size")).collect())
    one = sharding.sharded(rows.limit(1), F.col("size")).collect()
    assert len(one) == 1 and one[0].slot == 0


# --- mixing ---


def test_targets_are_met_and_budgets_nest(spark, documents):
    rows = [(i, "w " * (1 + i % 7)) for i in range(4000)]
    docs = documents(rows).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") < 100, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("doc_id") % 5)))
    got = mixing.mixed(docs).select("source", "doc_id", "mix.*").collect()
    target, taken, size = {}, Counter(), {}
    for r in got:
        target[r.source], size[r.source] = r.target, r.source_size
        taken[r.source] += r.taken
        assert r.taken in (r.size * r.rounds, 0) and r.taken <= 3 * r.size
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    assert all(abs(taken[s] - target[s]) <= 7 and target[s] <= 3 * size[s] + 1e-6 for s in target)
    assert got and sorted(map(str, got)) == sorted(map(str, mixing.mixed(docs.repartition(5)).select("source", "doc_id", "mix.*").collect()))
    drawn = mixing.drawn(docs)
    assert drawn.columns == docs.columns
    assert drawn.groupBy("doc_id").count().agg(F.sum("count")).first()[0] == sum(r.rounds for r in got)


# --- decontamination ---


def test_leaks_equal_brute_force(spark, documents):
    base, items = made(60, 5), [t.split()[:n] for t, n in zip(made(8, 6), (20, 20, 31, 45, 45, 50, 55, 3))]
    pick, rows = random.Random(7), []
    for i, text in enumerate(base):
        ws = text.split()
        if i % 3 == 0:
            item = list(items[i % len(items)])
            for _ in range(i % 4):  # a changed word is up to five shingles
                item[pick.randrange(len(item)) if i % 2 else 0] = "changed"
            ws[20:20] = [w.upper() + "," for w in item]
        rows.append((i, " ".join(ws)))
    bench = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(items)], "item_id LONG, text STRING")
    expected = set()
    for i, text in rows:
        ws = brute.alnum(text)
        for j, item in enumerate(items):
            want, n = Counter(brute.grams(item, 5)), len(item)
            for at in range(len(ws) - n + 1):
                own = Counter(brute.grams(ws[at : at + n], 5))
                if sum((own & want).values()) >= 0.8 * sum((own | want).values()):
                    expected.add((i, j))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents(rows), bench).collect()}
    assert got == expected and len(expected) > 10
    clean = {r.doc_id for r in decontaminate.cleaned(documents(rows), bench).collect()}
    assert clean == {i for i, _ in rows} - {i for i, _ in expected}


def test_blocks_hold_every_fingerprint_within_the_radius(spark):
    pick = random.Random(8)
    pairs = []
    for _ in range(200):
        a = pick.getrandbits(64)
        b = a
        for bit in pick.sample(range(64), pick.randint(0, 15)):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a LONG, b LONG")
    parts = [decontaminate.blocks(F.col(c), 15) for c in "ab"]
    assert df.where(F.size(F.array_intersect(*parts)) > 0).count() == 200


# --- licenses ---


def test_license_places(spark, given):
    rows = {r.doc_id: r for r in QUERIES["op3_license_scan"](spark, SF).collect()}
    for d, t in given:
        ws = brute.alnum(t)
        places = {label: [i for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()] for p, label in licenses.PHRASES.items()}
        all = sorted(x for v in places.values() for x in v)
        r = rows[d]
        base = sorted(k for k, v in places.items() if v)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(ws), len(all), all[0] if all else None, all[-1] if all else None, ",".join(base))
        assert set(base) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_notices_against_all_blocks(spark, documents):
    pick, filler, rows = random.Random(9), made(40, 10), []
    for i, text in enumerate(filler):
        ws = text.split()
        label, notice = licenses.NOTICES[i % len(licenses.NOTICES)]
        own = notice.split()
        for _ in range(i % 5):
            own.pop(pick.randrange(len(own)))
        at = pick.randrange(len(ws))
        rows.append((i, " ".join(ws[:at] + own + ws[at:]) * (1 + i % 2)))
    got = {r.doc_id: (r.labels, r.score) for r in licenses.licensed(documents(rows)).select("doc_id", "license.*").collect()}
    for i, text in rows:
        ws = brute.alnum(text)
        labels, best = set(), 0.0
        for p, label in licenses.PHRASES.items():
            if any(ws[j : j + len(p.split())] == p.split() for j in range(len(ws))):
                labels.add(label)
                best = 1.0
        for label, notice in licenses.NOTICES:
            want, n = set(brute.alnum(notice)), len(brute.alnum(notice))
            half = 1 << (n - 1).bit_length()
            for at in range(0, len(ws), half):
                share = len(want & set(ws[at : at + 2 * half])) / len(want)
                if share >= 0.9:
                    labels.add(label)
                    best = max(best, share)
        assert got[i] == (",".join(sorted(labels)), pytest.approx(best)), text


# --- tokens ---


def test_ids_equal_the_library(spark, given):
    import public_tokenizers
    from tokenizers import Tokenizer

    library, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = {r.doc_id: r for r in QUERIES["op2_token_output"](spark, SF).collect()}
    for d, t in given:
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        r = got[d]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_words_at_a_time_are_the_whole_text():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, own, pick = Tokenizer.from_file(path), tokens.WordEncoder(path, "<u2"), random.Random(11)
    parts = ["a", "B", "é", "é", "İ", "ß", " ", "  ", "\n", "\t", " ", ".", ",", "..", "'s", "'S", "1", "²", "<|endoftext|>", "<|ENDOFTEXT|>", "😀", "́", "word", "Ａ", "x" * 70]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 30))) for _ in range(3000)]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_runs_of_latin_texts_are_the_whole_text(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "PIECE", 300)  # parts and groups end often
    monkeypatch.setattr(tokens._Words, "CHUNKS", 50)  # and words are forgotten
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own, pick = Tokenizer.from_file(path), tokens.WordEncoder(path, "<u2"), random.Random(12)
    parts = [*own.LETTERS, *own.MARKS, *own.DIGITS, " ", "  ", "\n", "\n\n", "The", "WORD", "été", "ÿÞß", "***", "'s", "don't", "<|endoftext|>", "<|EndOfText|>", "×", "µ", "ª", "\t", "\x1c", "\x85", "\xa0", "́"]
    plain = parts[: parts.index("'s")]
    texts = ["".join(pick.choice(some) for _ in range(pick.choice([0, 3, 30, 300]))) for some in (plain, [*plain * 30, *parts], parts, [*"абвАБВ .,", "é"]) for _ in range(250)]
    texts += ["", " ", "\n", " \n ", "x" * 1000, " ".join(["word"] * 500), "7" * 700, "é" * 700, "<|endoftext|>", "a<|endoftext|>b c", "one\ntwo<|endoftext|>\nthree " * 9, "it's\n'tis " + "plain words " * 99]
    assert own.table
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.dtype == "<u2" and ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_run_of_letters_is_encoded_once():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    own, asked = tokens.word_encoder(path, "<u2"), []
    ids_of_runs = tokens.WordEncoder._ids_of_runs

    def spied(runs):
        asked.extend(runs)
        return ids_of_runs(own, runs)

    own._ids_of_runs = spied
    try:
        for text in ("Zqxylem zqxylem, ZQXYLEM!!", "(zqxylem)", "zqxylem."):
            tokens.word_encoder(path, "<u2").encode([text])  # what a later task of the worker gets
    finally:
        del own._ids_of_runs
    assert asked.count(b"zqxylem") == 1


def test_ids_are_read_in_either_format(spark, documents):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    corpus = tokens.written(documents([(i, "one two three " * i) for i in range(60)]).coalesce(1), lambda: tokens.word_encoder(path, "<u2"), "<u2", 2)
    keys = spark.range(60).select("id", tokens.key_hash(F.col("id"), F.lit(0)).alias("key_hash"))
    located, want = corpus.located(keys), {i: [*[637, 1237, 2097] * i, 2] for i in range(60)}
    for kind in ("<u2", "<u4"):
        got = {r.id: np.frombuffer(bytes(r.ids), kind).tolist() for r in corpus.read(located, kind, batch_bytes=100).collect()}
        assert got == want
    assert {r.id: np.frombuffer(bytes(r.ids), "<u2").tolist() for r in corpus.read(located).collect()} == want


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64))
    found = tokens.PerfectHash(tokens.build_hash(keys))(keys)
    assert sorted(found) == list(range(len(keys)))
    with pytest.raises(ValueError):
        tokens.build_hash(np.array([5, 5], np.uint64))


def test_unknown_keys_are_not_found(spark, documents):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = documents([(i, f"text {i}") for i in range(500)] + [(None, "none"), (7, "again")])
    corpus = tokens.written(docs, lambda: tokens.WordEncoder(path, "<u2"), "<u2", 2, part_keys=100)
    keys = spark.range(1500).select("id", tokens.key_hash(F.col("id"), F.lit(0)).alias("key_hash"))
    found = {r.id for r in corpus.read(corpus.located(keys)).collect()}
    assert found == set(range(500))
    second = spark.range(1).select("id", tokens.key_hash(F.lit(7).cast("long"), F.lit(1)).alias("key_hash"))
    none = spark.range(1).select("id", tokens.key_hash(F.lit(None).cast("long"), F.lit(0)).alias("key_hash"))
    assert corpus.located(second.union(none)).where("found").count() == 2


# --- language model ---


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, documents, given, order):
    texts = [t for _, t in given[:80]] + [None, "", "one", "one", "one two one two"] + [given[0][1]]
    got = sorted(lm.scored(documents(list(enumerate(texts))).repartition(3), order=order, block_chars=20_000, part_grams=3000).collect())
    for r, (score, n, backed) in zip(got, brute.backoff(texts, order), strict=True):
        assert (r.n_words, r.backed_off) == (n, backed)
        assert r.log_score == pytest.approx(score, rel=1e-9, abs=1e-9)


def test_scores_of_blank_texts(spark, documents):
    rows = lm.scored(documents([(1, None), (2, " "), (None, "")])).collect()
    assert {(r.doc_id, r.n_words, r.log_score, r.backed_off) for r in rows} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0), (None, 0, 0.0, 0)}


def test_packed_hashes():
    for values in ([], [0], [5, 1 << 63], [1, 2, 3, 1 << 47], list(range(0, 1 << 40, 1 << 30))):
        data = np.array(values, np.uint64)
        assert lm.unpack(lm.pack(data)).tolist() == values


# --- items of a benchmark, at their limits ---


def test_items_longer_than_the_text(spark, documents):
    items = [t.split()[:n] for t, n in zip(made(8, 19), (20, 31, 41, 41, 45, 50, 55, 59))] + [["one", "two", "three"]]
    texts = [" ".join(w[cut:] if cut % 2 else w[: len(w) - cut]) for w in items for cut in range(13)] + [None]
    bench = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(items)], "item_id LONG, text STRING")
    expected = {}
    for i, text in enumerate(texts):
        ws = brute.alnum(text)
        for j, item in enumerate(items):
            want = Counter(brute.grams(item, 5))
            for at in range(max(1, len(ws) - len(item) + 1)):
                window = ws[at : at + len(item)]
                own = Counter(brute.grams(window, 5))
                if sum((own & want).values()) >= 0.8 * sum((own | want).values()):
                    expected[i, j] = (len(window), sum((own & want).values()) / sum((own | want).values()))
    got = decontaminate.leaks(documents(list(enumerate(texts))), bench, radius=30).collect()
    assert {(r.doc_id, r.item_id): (r.n_words, round(r.similarity, 9)) for r in got} == {k: (n, round(s, 9)) for k, (n, s) in expected.items()}
    assert sum(n < len(items[j]) for (_, j), (n, _) in expected.items()) > 20


def test_windows_at_just_the_similarity(spark, documents):
    names = " ".join(made(400, 20)).split()
    items = [names[40 * i : 40 * i + 40] for i in range(500)]
    # 32 of 36 shingles in common are 0.8
    rows = [(i, " ".join([*w[:36], *(f"other{i}x{j}" for j in range(4)), "and", "more"])) for i, w in enumerate(items)]
    bench = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(items)], "item_id LONG, text STRING")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(documents(rows), bench).collect()}
    assert got == {(i, i): 0.8 for i in range(500)}
    assert decontaminate.leaks(documents(rows), bench, radius=15).count() < 500
