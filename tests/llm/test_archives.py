"""Archives, runs and conversations."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from streamweir.llm import chat, warc
from streamweir.llm.tables import Workspace


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    pick = random.Random(k)
    runs = [sorted((pick.randrange(20), pick.randrange(3)) for _ in range(pick.randrange(12))) for _ in range(k)]
    assert list(warc.loser_tree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_histories_are_in_order_and_lead_to_the_records(spark):
    rows = [(i, f"http://{'hot' if i % 3 == 0 else 's' + str(i % 7)}.example.org/{i % 2}", f"<p>{i % 50}</p>" * (i % 40)) for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING").repartition(6)
    work = Workspace(spark, "warc-test")
    index = work.keep(warc.merged(warc.archived(pages, work, stamp=F.lit(1_700_000_000) - F.col("page_id")), range_rows=500))
    got = index.orderBy("at_range", "at_place").select("url_key", "stamp", "page_id").collect()
    assert [tuple(r) for r in got] == sorted((warc.url_key(u), 1_700_000_000 - i, i) for i, u, _ in rows)
    assert index.groupBy("at_range").count().agg(F.max("count")).first()[0] < 1500
    back = {r.page_id: r for r in warc.read_back(index, work).collect()}
    for i, url, html in rows:
        assert back[i].url == url and (back[i].record_type == "revisit" or back[i].payload.decode() == html)
        if back[i].record_type == "revisit":
            assert rows[back[i].refers_to][2] == html and len(html) >= 100


def test_url_keys():
    assert warc.url_key("HTTP://www.Example.org:80/A?B=c#d") == "org,example)/a?b=c"
    assert warc.url_key(None) == warc.url_key("") == ""


def test_turns_come_back(spark):
    pick, parts = random.Random(3), ["\\", "o", "l", "b", "<", "[", "␂", "␂role:", "␂part:", "␂end:", "␂text:", "</s>", "[INST]", "a", " ", "\n", "😀", "\\\\o"]
    turns = [(c, t, pick.choice(["user", "assistant", "␂x", "a\\o"]), "".join(pick.choice(parts) for _ in range(pick.randint(0, 12)))) for c in range(60) for t in range(pick.randint(1, 9))]
    df = spark.createDataFrame(turns, "conv_id LONG, turn LONG, role STRING, text STRING").repartition(4)
    got = chat.formatted(df).select(
        "conv_id", "formatted", chat.turns_of(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("loss"),
    ).collect()
    for r in got:
        own = [(x[2], x[3]) for x in sorted(turns) if x[0] == r.conv_id]
        assert [tuple(t) for t in r.turns] == own
        assert r.loss == "".join(t for role, t in own if role == "assistant")
        assert "</s>" not in r.formatted and "[INST]" not in r.formatted


def test_neighbours_of_one_role_are_one_block(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id LONG, turn LONG, role STRING, text STRING")
    assert chat.formatted(df).first().formatted == "␂role:user␂text:a␂part:b␂end:␂role:assistant␂text:c␂end:"


def test_the_given_pages(spark):
    sf = "/root/testdata/sf0.001"
    work = Workspace(spark, "warc-pages")
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    records = warc.read_back(warc.merged(warc.archived(pages, work)), work).where("record_type = 'response'")
    expected = dict(duckdb.sql(f"SELECT page_id, html FROM '{sf}/pages.parquet'").fetchall())
    for r in records.collect():
        assert r.payload.decode() == expected[r.page_id]


def test_a_conversation_of_a_hundred_thousand_turns(spark):
    """Formatted and read back in time that grows with the turns."""
    n = 100_000
    role = F.when(F.col("id") % 3 == 0, "user").otherwise("assistant")
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.concat(F.lit("␂é \\ ["), "id").alias("text"))
    stored = Workspace(spark, "chat").keep(chat.formatted(turns))
    row = stored.select(
        chat.turns_of(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("loss"), F.size("loss").alias("n"),
    ).first()
    said = [("assistant" if i % 3 else "user", f"␂é \\ [{i}") for i in range(n)]
    assert [tuple(t) for t in row.turns] == said
    assert row.n == sum(r == "assistant" for r, _ in said) and row.loss == "".join(t for r, t in said if r == "assistant")
