"""Queries against their SQL counterparts on the smallest driver tables.

A cross-section by default; BULLETIN_ALL=1 runs every pair.
"""

import math
import os
from pathlib import Path

import duckdb
import pytest

from bulletin.plans.catalog import QUERIES
from bulletin.plans.oracles import ORACLES

SF_DIR = os.environ.get("BULLETIN_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = [
    "read_digest_items", "normalize_articles", "explode_links", "temporal_relevance", "publish_recency", "copy_decision",
    "apply_scores", "image_annotations", "dedupe_articles", "merge_by_title", "decision_summary", "example_digest",
    "rank_in_section", "topk_per_section", "newest_first", "union_feeds", "score_guardrails", "parse_datetime_text",
    "compress_body", "fit_field", "canonical_url", "selection_responses", "render_digest", "classify_lines", "full_issue",
]

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(rows):
    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    key = lambda r: tuple((v is None, str(v)) for v in r)
    return sorted((tuple(value(v) for v in r) for r in rows), key=key)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES and (os.environ.get("BULLETIN_ALL") or n in SAMPLE)])
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    got, want = plain(df.select(*columns).collect()), plain(result.fetchall())
    assert got and got == want


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
