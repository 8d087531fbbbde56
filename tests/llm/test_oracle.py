"""Every query of the package that has SQL against it, at the smallest scale, and on tables with nulls and nothing."""

import pytest

from streamweir.llm.oracle import SQL
from streamweir.llm.queries import QUERIES
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), SQL[name], con) == []


@pytest.fixture
def odd(spark, folder):
    """Tables with a null in every column, repeated rows, blank texts and extra columns named like results."""

    def write(name, rows, ddl):
        df = spark.createDataFrame(rows, ddl)
        df.write.parquet(f"{folder}/{name}.parquet")

    text = "One two, three. " * 30
    documents = [(1, text, "en", "b", 5), (2, text, "en", "b", 5), (2, text, "en", "b", 5), (None, "x y z", None, None, None), (3, None, "en", "a", 0), (4, "", "en", "", 0), (5, " \n\n ", "fr", "ä", 3), (6, "Ünïcode 😀 text\nagain\nagain", "fr", "Z", 20)]
    write("documents", [(*d, 1, "x") for d in documents], "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, shard INT, row STRING")
    pages = [(1, "http://www.a.org/X?b=1", "p" * 100), (2, None, "p" * 100), (3, "https://b.c/ü y", "p" * 99), (4, "::bad[", "p" * 99), (5, "http://a.org", None), (6, "", "é" * 50)]
    write("pages", [(*p, "x") for p in pages], "page_id LONG, url STRING, html STRING, file STRING")
    turns = [(1, 0, "user", "<|x|> \\o [INST]␂role:"), (1, 1, "user", None), (1, 2, "assistant", "a\\"), (1, 3, "assistant", "\\\\b␂"), (2, 0, None, "x"), (2, None, "assistant", ""), (None, 1, "assistant", "n"), (3, 1, "user", "t"), (3, 1, "user", "t")]
    write("conversations", [(*t, 1) for t in turns], "conv_id LONG, turn LONG, role STRING, text STRING, loss INT")
    return folder


@pytest.mark.parametrize("name", list(SQL))
def test_odd_tables(spark, odd, name):
    assert differences(QUERIES[name](spark, odd), SQL[name], folders(odd)) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "pipeline"])
def test_empty_tables(spark, folder, name):
    for table in ("documents", "pages", "conversations", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(f"{folder}/{table}.parquet")
    rows = QUERIES[name](spark, folder)
    assert rows.count() == (1 if name == "op1_chat_formatting" else 0)


def folders(path):
    import duckdb
    from pathlib import Path

    con = duckdb.connect()
    for table in Path(path).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}/*.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL and n != "pipeline"])
def test_odd_tables_do_not_crash(spark, odd, name):
    if name == "op5_decontamination":
        spark.createDataFrame([(1, None), (2, ""), (3, "x y z"), (None, "One two three " * 8)], "item_id LONG, text STRING").write.parquet(f"{odd}/benchmark.parquet")
    rows = QUERIES[name](spark, odd).collect()
    assert len(rows) == 8 or name == "op5_decontamination" and {(r.doc_id, r.item_id) for r in rows} >= {(None, 3), (1, None), (2, None)}
