"""Every stage against brute force over its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from streamweir.llm.simhash import fingerprint
from streamweir.llm.tables import Workspace
from tests.llm import brute
from tests.llm.test_simhash import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    work, docs = Workspace(spark, "stages"), spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(work.keep(stage(spark, out[-1], SF)))
    return out


def rows(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near dedup", "decontamination", "source mix", "sharding"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    assert stages[-1].columns == [*stages[0].columns, "shard", "slot"]


def test_quality_rules(stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert after.items() <= before.items()
    assert not any(brute.measures(t)[-1] for t in after.values())
    gone = [t for d, t in before.items() if d not in after and not brute.measures(t)[-1]]
    # what the base lets through goes for its symbols only
    assert all(10 * brute.measures(t)[2] > brute.measures(t)[0] for t in gone)


def test_near_dedup(stages):
    before, after = rows(stages[1]), rows(stages[2])
    groups = brute_components(before.items())
    assert after == {d: before[d] for d, _, least in groups if d == least}
    assert len(after) < len(before)


def test_decontamination(spark, stages):
    before, after = rows(stages[2]), rows(stages[3])
    items = [brute.alnum(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [Counter(brute.grams(w, 5)) for w in items]
    known = {g for w in want for g in w}

    def leaks(text):
        ws = brute.alnum(text)
        if not known & set(brute.grams(ws, 5)):
            return False
        for item, shingles in zip(items, want):
            for at in range(len(ws) - len(item) + 1):
                own = Counter(brute.grams(ws[at : at + len(item)], 5))
                if sum((own & shingles).values()) >= 0.8 * sum((own | shingles).values()):
                    return True
        return False

    assert after == {d: t for d, t in before.items() if not leaks(t)}
    assert len(after) < len(before)


def test_source_mix(stages):
    size, taken, docs = Counter(), Counter(), {}
    for r in stages[3].collect():
        docs[r.doc_id] = r
        size[r.source] += len(brute.words(r.text))
    for r in stages[4].collect():
        assert r == docs[r.doc_id]
        taken[r.source] += len(brute.words(r.text))
    most = max(Counter(r.doc_id for r in stages[4].collect()).values())
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(size))}
    full, target = set(), {}
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in full)
        target = {s: 3 * size[s] if s in full else left * weight[s] / sum(weight[x] for x in size if x not in full) for s in size}
        more = {s for s in size if target[s] > 3 * size[s]}
        if not more:
            break
        full |= more
    longest = Counter()
    for r in docs.values():
        longest[r.source] = max(longest[r.source], len(brute.words(r.text)))
    assert most <= 3 and all(abs(taken[s] - target[s]) <= longest[s] for s in size)


def test_sharding(stages):
    before, after = stages[4].collect(), stages[5].collect()
    assert Counter((r.doc_id, r.text) for r in before) == Counter((r.doc_id, r.text) for r in after)
    sizes = Counter()
    for shard in range(8):
        own = [r for r in after if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        sizes[shard] = sum(len(r.text.encode()) + 1 for r in own)
    largest = max(len(r.text.encode()) + 1 for r in after)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 3 * largest


def test_no_documents(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = Workspace(spark, "none").keep(stage(spark, docs, SF))
        assert docs.count() == 0, name


def test_odd_documents(spark):
    """Nulls in every column, repeated rows and blank texts pass through every stage on their own."""
    text = " ".join(f"word{i}" for i in range(70)) + ".\nAnother line of it."
    rows = [(None, text, None, None, None), (None, text, None, None, None), (1, None, "en", None, 1), (2, "", None, "s", 2), (2, "", None, "s", 2), (3, " \n", "en", "s", 3), (4, text + " more", "en", "t", 4), (5, text.upper(), "en", "t", None)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    got = {name: sorted((r.doc_id if r.doc_id is not None else -1) for r in stage(spark, docs, SF).collect()) for name, stage in corpus_pipeline.STAGES}
    assert got["quality rules"] == [-1, -1, 4, 5]
    # blank texts are one group and those of equal words another; one more word in 74 changes more than two bits
    assert fingerprint(text) == fingerprint(text.upper())
    assert (fingerprint(text) ^ fingerprint(text + " more")).bit_count() > 2
    assert got["near dedup"] == [1, 4, 5]
    assert got["decontamination"] == got["sharding"] == [-1, -1, 1, 2, 2, 3, 4, 5]
    assert set(got["source mix"]) <= {-1, 1, 2, 3, 4, 5}
