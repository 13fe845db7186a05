"""Steps whose tasks must not grow with one group, and work that is done once per row."""

from bulletin.operators import model, pages


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_selection_requests_deal_no_text_by_section(spark):
    rows = [(s, i, f"t{i}", "2026-04-01", "x" * 3) for s, n in (("甲", 4), ("乙", 5), ("丙", 9), ("物理系学术报告", 9)) for i in range(n)]
    df = spark.createDataFrame(rows, "section string, ordinal long, title string, date string, content string")
    requests = model.selection_requests(df, chunk_items=3)
    assert "LeftSemi" not in plan(requests)
    found = {(r.section, r.chunk): r["items"] for r in requests.collect()}
    assert found == {("乙", 0): 3, ("乙", 1): 2, ("丙", 0): 3, ("丙", 1): 3, ("丙", 2): 3}


def test_decode_pages_holds_no_batch_of_pages(spark):
    texts = ["中文页面" * 50, "déjà vu", "plain"]
    rows = [(i, t.encode("gb18030" if i == 0 else "utf-8"), "text/html") for i, t in enumerate(texts)] + [(3, None, None), (4, b"\xff\xfe\xfa", "charset=nope")]
    df = pages.decode_pages(spark.createDataFrame(rows, "page_id int, raw binary, content_type string"))
    assert "BatchEvalPython" in plan(df) and "ArrowEvalPython" not in plan(df)
    found = {r.page_id: r.html for r in df.collect()}
    assert found[0] == texts[0] and found[2] == texts[2] and found[3] is None and found[4]


def test_event_listing_reads_one_row_group_in_many_tasks(spark, tmp_path):
    from bulletin.plans.catalog import QUERIES

    rows = [(i, f"C{i}", i % 5) for i in range(400)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    listed = QUERIES["event_listing"](spark, str(tmp_path))
    # The poster's address is searched once, however often resolving names it.
    assert plan(listed).count(r"<img\b") == 1
    assert listed.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert listed.count() == 800


def test_issue_scores_are_narrow_and_those_of_each_run(spark):
    from bulletin.functions.text import raw_clean
    from bulletin.operators import issues
    from bulletin.plans import issue
    from pyspark.sql import functions as F
    from test_issues import CLOCKS, notices

    together = issues.issue_scores(notices(spark), issues.issue_table(spark, CLOCKS), raw_clean(F.col("content")))
    assert "content" not in together.columns
    rows = together.collect()
    for clock in CLOCKS:
        alone = {(r.notice_id, r.score) for r in issue.scored_notices(notices(spark), clock).collect()}
        assert {(r.notice_id, r.score) for r in rows if r.issue_date == clock.run_date} == alone
