"""Character references: the queries and their SQL read all of them alike, with and without a semicolon."""

import html

import duckdb
import pytest

from bulletin.plans.catalog import QUERIES
from bulletin.plans.oracles import ORACLES, unescaped

TEXTS = [
    "a &amp", "und&ampp", "&lt&gt;", "&notit; &notin;", "x&nbsp;y", "&#38; &#x26", "&#0;", "&#128;&#x81;", "&#xD800;", "&#x110000;",
    "&#99999999999;", "&#x0000000041;b", "&#11;", "&#65534;", "&& &; &#; &#x;", "&CounterClockwiseContourIntegral;", "&quot&amp;lt;", "&unknown;", "",
]


def test_sql_decodes_as_html_does():
    con = duckdb.connect()
    got = [con.execute(f"SELECT {unescaped('x')} FROM (SELECT $1 AS x) t", [t]).fetchone()[0] for t in TEXTS]
    assert got == [html.unescape(t) for t in TEXTS]


@pytest.mark.parametrize("name", ["html_to_text", "strip_tags"])
def test_query_and_sql_agree(spark, tmp_path, name):
    pages = [(i, "https://e.com/", f"<h1>{t}</h1><p>b {t}<b>c</b></p>") for i, t in enumerate(TEXTS)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = {tuple(r) for r in QUERIES[name](spark, str(tmp_path)).select("page_id", "text").collect()}
    assert got == set(con.execute(ORACLES[name]).fetchall())
