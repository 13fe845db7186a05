import random

import pytest
from pyspark.sql import functions as F

from bulletin.functions.dates import RunClock
from bulletin.operators import decisions, dedup, joins, model, order, pages, ranking, reports, sections
from bulletin.sources import digest, feeds

CLOCK = RunClock.of("2026-04-20")


def test_positions_match_plain_ranks(spark):
    """Exact under skew, ties, negative and sparse keys, with many tiny ranges."""
    rng = random.Random(7)
    rows = [
        (i, "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None]), rng.choice([5, 5, 5, 80]), rng.choice([i, -i, i * 1000, 10**9]))
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "id int, g string, s int, o long").repartition(5)
    got = order.positions(df, ["g"], ["s", "o", "id"], "p", exact=["s"])
    want = {}
    for g in {r[1] for r in rows}:
        members = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[3], r[0]))
        want.update({r[0]: n for n, r in enumerate(members, start=1)})
    assert {r.id: r.p for r in got.select("id", "p").collect()} == want
    single = order.positions(df, ["g"], ["id"], "p").select("g", "id", "p").collect()
    assert sorted(r.p for r in single if r.g == "hot") == list(range(1, sum(r[1] == "hot" for r in rows) + 1))


def test_positions_empty(spark):
    df = spark.createDataFrame([], "g string, o long")
    assert order.positions(df, ["g"], ["o"], "p").count() == 0


def test_topk_limits(spark):
    rows = [(i, s, f"t{i}" if i % 5 else "占位卡片", i % 3, i) for s in ("x", "其他公众号信息") for i in range(20)]
    df = spark.createDataFrame(rows, "notice_id int, section string, title string, score int, ordinal int")
    out = ranking.topk_per_section(df).orderBy("section", "rank").collect()
    assert [(r.section, r.ordinal) for r in out] == [("x", n) for n in (2, 8, 11, 14)] + [("其他公众号信息", n) for n in (2, 8, 11, 14, 17)]
    again = ranking.topk_per_section(df.repartition(7)).orderBy("section", "rank").collect()
    assert out == again


def test_dedupe_articles(spark):
    rows = [
        (1, "10", "1", "u1"), (2, "10", "1", "u2"), (3, "", "1", "https://e.com/?a=1&sn=2"), (4, None, None, "https://e.com/?sn=3&a=1#x"),
        (5, "10", "", ""), (6, "10", "", None),
    ]
    df = spark.createDataFrame(rows, "ordinal int, mid string, idx string, url string")
    assert sorted(r.ordinal for r in dedup.dedupe_articles(df.repartition(3)).collect()) == [1, 3]


def test_merge_by_title_keeps_last_listing(spark):
    rows = [("A", "d1", "L1", 1), ("B", "d2", "L2", 2), ("A", "d3", "L3", 3), ("A", "d4", "L4", 4)]
    df = spark.createDataFrame(rows, "title string, date string, location string, ordinal int").withColumns(
        {"price": F.lit("p"), "absolute_src": F.lit("s")}
    )
    out = {r.title: (r.n_dates, r.location, r.ordinal) for r in dedup.merge_by_title(df).collect()}
    assert out == {"A": (3, "L4", 4), "B": (1, "L2", 2)}
    dates = [(r.title, r.date) for r in dedup.title_dates(df).orderBy("title", "place").collect()]
    assert dates == [("A", "d4"), ("A", "d3"), ("A", "d1"), ("B", "d2")]
    log = {r.ordinal: r.reason for r in dedup.duplicate_titles(df).collect()}
    assert log == {1: "duplicate_title", 2: "crawler_selected", 3: "duplicate_title", 4: "crawler_selected"}


def test_a_title_with_thousands_of_dates_is_one_event(spark):
    df = spark.range(2500).selectExpr("'A' title", "concat('d', id) date", "'L' location", "id ordinal", "'p' price", "'s' absolute_src")
    assert [tuple(r) for r in dedup.merge_by_title(df).select("title", "n_dates", "ordinal").collect()] == [("A", 2500, 2499)]
    assert dedup.title_dates(df).count() == 2500


@pytest.mark.parametrize("values", ["id", "if(id = 0, 9000000000000000, id)", "if(id % 10 = 0, id, 7)", "1775000000 + id % 40 * 86400", "if(id % 9 = 0, null, 1775000000 + id % 40)"])
def test_positions_of_uneven_keys(spark, values):
    df = spark.range(5000).selectExpr("'g' section", f"{values} publish_ts", "id ordinal", f"coalesce({values}, -1) key")
    rows = [(r.key, r.ordinal) for r in df.collect()]
    numbered = order.positions(df, ["section"], ["key", "ordinal"], "n")
    assert {(r.key, r.ordinal): r.n for r in numbered.collect()} == {k: i for i, k in enumerate(sorted(rows), 1)}
    times = sorted(((-(r.publish_ts or 0), r.ordinal) for r in df.collect()))
    assert {r.ordinal: r.position for r in ranking.newest_first(df).collect()} == {o: i for i, (_, o) in enumerate(times, 1)}


def test_ranges_stay_even(spark):
    df = spark.range(20_000).selectExpr("'g' section", "if(id = 7, 9000000000000000, id) key")
    bounds = df.agg(F.percentile_approx("key", [i / order.RANGES for i in range(1, order.RANGES)], 4 * order.RANGES).alias("b"))
    held = df.crossJoin(F.broadcast(bounds)).groupBy(order._range_of(F.col("key"), F.col("b"))).count()
    assert held.agg(F.max("count")).first()[0] < 4 * 20_000 / order.RANGES


def test_dedupe_urls_flags_later_listings(spark):
    df = spark.createDataFrame([(1, "u", 1), (2, "u", 2), (3, None, 3), (4, None, 4), (5, "v", 5)], "notice_id int, url string, ordinal int")
    out = {r.notice_id: r.reason for r in dedup.dedupe_urls(df).collect()}
    assert out == {1: "list_item", 2: "duplicate_url", 3: "list_item", 4: "list_item", 5: "list_item"}


def test_decision_summary(spark):
    log = spark.createDataFrame(
        [("a", "kept", "r"), ("a", "dropped", "r"), ("", "kept", None), (None, "", "q")], "section string, status string, reason string"
    )
    out = {(r.level, r.section, r.status, r.reason): r.records for r in decisions.decision_summary(log).collect()}
    assert out[("total", None, None, None)] == 4 and out[("status", None, "kept", None)] == 2
    assert out[("section_status", "unknown", "unknown", None)] == 1 and out[("section_reason", "a", None, "r")] == 2
    assert out[("section_reason", "unknown", None, "unknown")] == 1


def test_read_digest_items(spark):
    text = "头\r\n## 散\n正文\n# 甲 \n前言\n## 一\n\nx\n### 小\ny  \n#无\n# \n##  二\n## \n尾\n# 乙\n# 丙\n## 三"
    out = digest.read_digest_items(spark.createDataFrame([("d", text), ("e", ""), ("f", "# 仅\n## 条")], "doc_path string, text string"))
    rows = [(r.doc_path, r.section, r.section_ord, r.item_ord, r.title, r.content) for r in out.orderBy("doc_path", "section_ord", "item_ord").collect()]
    assert rows == [
        ("d", "未分类", 0, 1, "散", "正文"), ("d", "甲", 1, 1, "一", "x\n### 小\ny  \n#无\n#"), ("d", "甲", 1, 2, "二", "## \n尾"),
        ("d", "丙", 3, 1, "三", ""), ("f", "仅", 1, 1, "条", ""),
    ]


def test_load_preferences(spark):
    text = (
        "# 教 务\n## a\n重要性评分: 80/100\n物理系本科生偏好评分：50（备注）\n## b\n物理系本科生偏好评分：95/100\n理由：直接\n"
        "## c\n重要性评分: 300/100\n排序依据: 机\n## d\n无"
    )
    out = digest.load_preferences(spark.createDataFrame([("p", text)], "doc_path string, text string")).orderBy("item_ord")
    assert [(r.section, r.title, r.score, r.reason) for r in out.collect()] == [
        ("教务", "a", 50, "备注"), ("教务", "b", 95, "直接"), ("教务", "c", 100, "机"),
    ]


def test_normalize_articles(spark):
    raw = [
        '{"list":[{"title":"t","url":"/s","create_time":5,"aid":"12_3"},{"title":"x","url":""}]}',
        '{"n":1,"records":[{"name":"n","link":"//a.b/c","update_time":"2026-04-12 08:30","mid":7,"itemidx":"2","aid":"1_1"}]}',
        '{"other":[{"content_url":"https://e.com","desc":"d","cover":"/c.png"}]}', '[{"url":"u"}]', '{"a":{}}', "broken",
    ]
    df = spark.createDataFrame([(i, "k", r) for i, r in enumerate(raw)], "feed_id int, account_keyword string, raw string")
    out = feeds.normalize_articles(df, site="https://s.com").orderBy("feed_id").collect()
    assert [(r.feed_id, r.title, r.url, r.publish_ts, r.mid, r.idx) for r in out] == [
        (0, "t", "https://s.com/s", 5, "12", "3"), (1, "n", "https://a.b/c", 1775982600, "7", "2"),
        (2, "N/A", "https://e.com", None, None, None), (3, "N/A", "u", None, None, None),
    ]
    assert out[2].digest == "d" and out[2].cover == "https://s.com/c.png"


def test_top1_account_needs_the_first_candidate(spark):
    raw = [("a", 1, '{"list":[{"id":" 9 "},{"fakeid":"8"}]}'), ("b", 2, '{"list":[{"x":1},{"fakeid":"8"}]}'), ("c", 3, '{"list":[]}')]
    replies = spark.createDataFrame(raw, "keyword string, keyword_ord int, raw string")
    assert [(r.keyword, r.fakeid) for r in feeds.top1_account(feeds.account_candidates(replies)).collect()] == [("a", "9")]


def test_decode_pages(spark):
    rows = [
        (1, "学术报告".encode(), ""), (2, "学术报告讲座".encode("gb18030"), "text/html; charset=gbk"), (3, b"plain", None),
        (4, "été".encode("latin-1"), "charset=no-such"),
    ]
    df = spark.createDataFrame(rows, "page_id int, raw binary, content_type string")
    out = {r.page_id: r.html for r in pages.decode_pages(df).collect()}
    assert out[2] == "学术报告讲座" and out[3] == "plain" and out[4] is not None


def test_tables_and_text(spark):
    html = "<h1>题</h1><p>段&amp;落</p><table><tr><th>a|b</th><th>c</th></tr><tr><td><b>1</b></td></tr></table><img src='x'>尾"
    df = spark.createDataFrame([(1, html), (2, "<p>无表</p>")], "page_id int, html string")
    markdown = pages.tables_to_rows(df).collect()
    assert len(markdown) == 1 and markdown[0].markdown == "| a\\|b | c |\n| --- | --- |\n| 1 |  |"
    text = {r.page_id: r.text for r in pages.html_to_text(df).collect()}
    assert text[2] == "无表" and "| a\\|b | c |\n\n| --- | --- |" in text[1] and text[1].startswith("# 题\n\n段&落") and text[1].endswith("尾")


def test_images(spark):
    html = "<img alt=x><img data-src='//a/1.png' src='y'>t<IMG src=/2.png>"
    df = spark.createDataFrame([(1, html), (2, "none")], "page_id int, html string")
    assert [(r.idx, r.image_url) for r in pages.extract_images(df, site="https://s").orderBy("idx").collect()] == [(1, "https://a/1.png"), (2, "https://s/2.png")]
    marked = {r.page_id: r.html for r in pages.mark_images(df, site="https://s").collect()}
    assert marked == {1: "<p>[[IMG_OCR_1]]</p>t<p>[[IMG_OCR_2]]</p>", 2: "none"}


def test_image_annotations(spark):
    notices = spark.createDataFrame([(1, "a[[IMG_OCR_1]]b[[IMG_OCR_2]]\n\n\n\n[[IMG_OCR_3]]c[[IMG_OCR_9]]"), (2, "x")], "notice_id int, content string")
    images = spark.createDataFrame(
        [(1, 1, "u1", "t", "TABLE"), (1, 2, "u2", " 字 ", "OTHER"), (1, 3, "u3", "", "OTHER")], "notice_id int, idx int, url string, ocr_text string, type string"
    )
    out = {r.notice_id: r.content for r in joins.image_annotations(notices, images).collect()}
    assert out == {1: "a![图片1](u1)b[图片文字 2] 字\n\nc", 2: "x"}


def test_markdown_image_texts(spark):
    notices = spark.createDataFrame([(1, '一![x](a.png "t")二![](<b c.png>)'), (2, "无图")], "notice_id int, content string")
    texts = spark.createDataFrame([("a.png", "认出"), ("b c.png", "")], "path string, text string")
    out = {r.notice_id: r.content for r in joins.markdown_image_texts(notices, texts).collect()}
    assert out == {1: "一\n\n[图片文字]\n认出\n\n二![](<b c.png>)", 2: "无图"}
    kept = {r.notice_id: r.content for r in joins.markdown_image_texts(notices, texts, keep_image=True).collect()}
    assert kept[1].startswith('一![x](a.png "t")\n\n[图片文字]\n认出\n二')


def test_event_listing_missing_fields(spark):
    html = '<div class="timemain_a"><b class="size_40">5</b> 2026-04 <b class="size_bg">19:30</b><h3 class="yahei"><a>题</a></h3><img src="/p.png"></div><div class="timemain_a"></div>'
    df = spark.createDataFrame([(1, "https://e.com/l", html)], "page_id int, url string, html string")
    out = [(r.date, r.title, r.location, r.price, r.absolute_src) for r in pages.event_listing(df).orderBy("ordinal").collect()]
    assert out == [("2026-04-5 19:30", "题", "N/A", "N/A", "https://e.com/p.png"), ("N/A", "N/A", "N/A", "N/A", None)]


def test_ocr_text(values):
    got = values(
        pages.ocr_text,
        [
            '{"ParsedResults":[{"ParsedText":" a "},{"ParsedText":""},{"ParsedText":"b"}]}', '{"IsErroredOnProcessing":true,"ParsedResults":[{"ParsedText":"a"}]}',
            '{"ParsedResults":"x"}', "broken", None,
        ],
    )
    assert got == ["a\nb", "", "", "", ""]


def test_model_tables(spark):
    replies = spark.createDataFrame(
        [
            ("s", '好 {"items":[{"index":1,"score":"80.5","reason":""},{"index":2,"score":300,"reason":"高"},{"index":"x","score":1},{"index":3,"score":"no"},{"index":1,"score":70,"reason":"后"}]}'),
            ("t", "{broken"), ("u", None),
        ],
        "section string, raw string",
    )
    out = sorted((r.section, r.item_index, r.score, r.reason) for r in model.score_responses(replies).collect())
    assert out == [("s", 1, 70, "后"), ("s", 2, 100, "高")]
    items = spark.createDataFrame([("s", 1, 5, "r"), ("s", 3, 6, "r"), ("t", 1, 7, "r")], "section string, item_index int, score int, reason string")
    applied = sorted((r.section, r.item_index, r.score, r.reason) for r in joins.apply_scores(items, model.score_responses(replies)).collect())
    assert applied == [("s", 1, 70, "后"), ("s", 3, 6, "r"), ("t", 1, 7, "r")]


def test_selection_responses(spark):
    items = spark.createDataFrame([(s, i) for s in "ab" for i in range(1, 7)], "section string, item_index int")
    replies = spark.createDataFrame([("a", '{"keep_indices":[6,2,2,"1",99,"x",0,3,5]}'), ("b", "no json")], "section string, raw string")
    out = sorted((r.section, r.pick, r.item_index) for r in model.selection_responses(items, replies).collect())
    assert out == [("a", 1, 6), ("a", 2, 2), ("a", 3, 1), ("a", 4, 3), ("b", 1, 1), ("b", 2, 2), ("b", 3, 3), ("b", 4, 4)]


def test_model_call_retries_then_gives_up(spark):
    def flaky(prompts):
        if any(p.startswith("boom") for p in prompts):
            raise RuntimeError("provider down")
        return [None if p == "silent" else p.upper() for p in prompts]

    df = spark.createDataFrame([(1, "yes"), (2, "silent"), (3, "no")], "notice_id int, prompt string").coalesce(1)
    assert {r.notice_id: r.raw for r in model.model_call(df, flaky, "notice_id").collect()} == {1: "YES", 2: None, 3: "NO"}
    failing = spark.createDataFrame([(1, "boom")], "notice_id int, prompt string")
    lost = model.model_call(failing, flaky, "notice_id").first()
    assert lost.raw is None and lost.error == "RuntimeError: provider down"


def test_gated_clean(spark):
    notices = spark.createDataFrame([(1, "x", "甲", "正文**粗**"), (2, "x", "乙", "正文"), (3, "物理系学术报告", "丙", "正文")], "notice_id int, section string, title string, content string")
    replies = spark.createDataFrame([(1, "更长的正文粗"), (2, "短"), (3, "更长的正文粗")], "notice_id int, raw string")
    out = {r.notice_id: (r.accepted, r.content) for r in model.gated_clean(notices, replies).collect()}
    assert out == {1: (True, "更长的正文粗"), 2: (False, "正文"), 3: (False, "正文")}


def test_report_body(spark):
    text = "报告人：王\n报告时间：2026年4月2日 10:00\n报告地点：W101\n摘要：内容"
    df = spark.createDataFrame([("题", text, "https://e.com", '{"title":"新题","speaker":"","summary":"模"}'), ("题", "正文", "u", None)], "title string, content string, url string, raw string")
    rows = reports.build_report(df).collect()
    assert rows[0].report_title == "新题" and rows[0].body == (
        "发布日期: 2026-04-02\n\n报告时间: 2026年4月2日 10:00\n\n报告地点: W101\n\n报告人: 王\n\n链接: https://e.com\n\n\n\n内容摘要：内容"
    )
    assert rows[1].body == "链接: u\n\n\n\n正文"


def test_sections(spark):
    items = spark.createDataFrame([("教务通知", "t", "c")], "section string, title string, content string")
    done = sections.complete_sections(items, sections.section_table(spark)).collect()
    assert len(done) == 8 and sum(r.placeholder for r in done) == 7
    errors = spark.createDataFrame([("crawl_info", "慢", 0), ("crawl_myhome", " 断 ", 1), ("x", "y", 2)], "stage string, error string, stage_ord int")
    stages = spark.createDataFrame([("crawl_info", "教务通知"), ("crawl_myhome", "家园网信息")], "stage string, section string")
    assert [(r.section, r.content) for r in sections.stage_errors(items, errors, stages).collect()] == [("家园网信息", "本次抓取未成功。\n\n原因: 断")]
    assert sections.fallback_issue(items, errors).count() == 0
    note = sections.fallback_issue(items.where("false"), errors.where("false")).orderBy("section_ord").first()
    assert note.content == sections.rules.FALLBACK_PREFACE + "- 无详细错误信息"


def test_example_digest_is_cut_exactly(spark):
    rows = [("s", f"标题{i}", i % 101, "理" if i % 2 else "", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "section string, title string, score int, reason string, ordinal int")
    lines = [f"- {t} => {s}/100" + (f"；{r}" if r else "") for _, t, s, r, _ in rows]
    want = ("当前版块人工评分样例：\n" + "\n".join(lines))[:3200]
    assert joins.example_digest(df.repartition(6)).first().examples == want


def test_previous_issue(spark):
    now = spark.createDataFrame([(1, "A [x]，b"), (2, "new")], "notice_id int, title string")
    old = spark.createDataFrame([("ax b",)], "title string")
    assert [r.notice_id for r in joins.previous_issue_anti(now, old).collect()] == [2]
    assert joins.previous_issue_anti(now).count() == 2


def test_report_job(spark):
    broken = "报告人：王".encode().decode("latin-1")
    rows = [("学术报告", f"导航\n学术报告 一\n{broken}\n报告时间：2026年4月2日  \n上一篇\n无", "u"), ("招聘信息", "报告", "v"), ("讲座", "讲座 公告", "w")]
    out = reports.report_job(spark.createDataFrame(rows, "title string, content string, url string")).collect()
    assert len(out) == 1 and out[0].speaker == "王" and out[0].event_time == "2026年4月2日" and "上一篇" not in out[0].body


def test_article_details(spark):
    articles = spark.createDataFrame([(1, "u"), (2, "missing")], "ordinal int, url string")
    html = '<em id="publish_time"> 2026-04-01 </em><div id="js_content"><p>一&amp;二</p><img src=x><p>三</p></div>var author = "编";'
    out = {r.ordinal: (r.content, r.publish_text, r.author) for r in pages.article_details(articles, spark.createDataFrame([("u", html)], "url string, html string")).collect()}
    assert out == {1: ("一&二\n三", "2026-04-01", "编"), 2: ("", "", "")}


def test_a_repeated_image_takes_its_last_annotation(spark):
    notices = spark.createDataFrame([(1, "[[IMG_OCR_1]] [[IMG_OCR_2]] [[IMG_OCR_99999999999]]")], "notice_id int, content string")
    notes = [(1, 1, "u", "旧", "OTHER", 1), (1, 1, "u", "新", "OTHER", 2), (1, None, "u", "无", "OTHER", 3), (1, 2, "u2", "", "TABLE", 4)]
    images = spark.createDataFrame(notes, "notice_id int, idx int, url string, ocr_text string, type string, ordinal int")
    want = "[图片文字 1] 新 ![图片2](u2)"
    assert joins.image_annotations(notices, images).first().content == want
    assert joins.image_annotations(notices, images.drop("ordinal")).first().content == max(want, want.replace("新", "旧"))


def test_positions_with_every_kind_of_key(spark):
    from bulletin.operators.order import positions

    rows = [(g, k, i) for g in (1, 2) for i, k in enumerate([None, 5, 5, -(2**62), 2**62, 7, *range(300)])]
    df = spark.createDataFrame(rows, "g int, k bigint, i int").repartition(5)
    got = [tuple(r) for r in positions(df, ["g"], ["k", "i"], "at").collect()]
    for g in (1, 2):
        ordered = sorted((r for r in got if r[0] == g), key=lambda r: r[3])
        assert [r[3] for r in ordered] == list(range(1, 307))
        assert [(r[1], r[2]) for r in ordered] == sorted(((k, i) for h, k, i in rows if h == g), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
