"""Plans: work inside a row needs no exchange, and filters reach the scan."""

import pytest
from pathlib import Path

from bulletin.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["keyword_rules", "publish_prefilter", "html_to_text", "tables_to_rows", "extract_images", "distinct_signals", "latest_signal", "clean_markdown", "summary_requests"],
)
def test_no_exchange(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, SF_DIR))


def test_mark_images_in_the_row(spark):
    from bulletin.operators import pages

    rows = spark.createDataFrame([(1, '<img src="a.png"><img alt="x"><img data-src="//e.com/b">')], "page_id int, html string")
    marked = pages.mark_images(rows, site="https://e.com")
    assert marked.first().html == "<p>[[IMG_OCR_1]]</p><p>[[IMG_OCR_2]]</p>"
    assert "Exchange" not in plan(marked)
