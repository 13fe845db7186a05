from pyspark.sql import functions as F

from bulletin.functions.dates import RunClock
from bulletin.operators import dedup
from bulletin.operators.sections import section_table
from bulletin.plans import issue, render
from bulletin.sources import digest, sinks

CLOCK = RunClock.of("2026-04-20")

DIGEST = """# 教务通知

## 退课提醒
日期: 2026-04-17

链接: https://example.com/course

请相关同学在本周内完成退课流程。
![配图](https://example.com/test.jpg)

## 过期
日期: 2026-04-01
"""


def test_refilter_renders_the_smoke_digest(spark):
    docs = spark.createDataFrame([("d", DIGEST)], "doc_path string, text string")
    items = digest.read_digest_items(docs).withColumns({"notice_id": F.col("item_ord"), "ordinal": F.col("item_ord")})
    out = render.join_issue(issue.refilter_issue(items, section_table(spark, ["教务通知", "图书馆信息"]), CLOCK)).first()
    assert out["items"] == 1 and out.text.startswith("# 教务通知\n\n这周教务安排") and "## 退课提醒" in out.text
    assert "过期" not in out.text and "# 图书馆信息\n\n本周暂无相关信息" in out.text and "要点透视" not in out.text


def test_ranked_blocks(spark):
    ranks = spark.createDataFrame([(1, "a", 1, 80, "r", 1), (2, "a", 2, 5, "", 2)], "notice_id int, section string, rank int, score int, reason string, ordinal int")
    bodies = spark.createDataFrame([(1, "t", "c"), (2, "u", ""), (3, "v", "w")], "notice_id int, title string, content string")
    blocks = render.render_ranked(ranks, bodies, section_table(spark, ["a", "b"])).orderBy("section_ord", "block").collect()
    assert [b.text for b in blocks] == [
        "# a", "## t\n\n重要性评分: 80/100\n\n排序依据: r\n\nc", "## u\n\n重要性评分: 5/100",
        "# b\n\n## 占位卡片\n\n本版块 raw 模式未抓取到一周内发布的条目。",
    ]


def test_article_block(spark):
    row = [("", "", "", None, " ", "人", "要", "", "文\n")]
    df = spark.createDataFrame(row, "title string, account string, url string, publish_ts long, publish_text string, author string, digest string, summary string, content string")
    assert render.render_articles(df).first().text == "## N/A\n\n日期: N/A\n\n链接: N/A\n\n发布时间:  \n\n作者: 人\n\n摘要: 要\n\n内容:\n\n文"


def test_event_blocks(spark):
    rows = [("t", "d1", "l", "p\nq", "s", 1), ("u", "d1", "l", "p", "x", 2), ("u", "d2", "l", "p", "", 3)]
    df = spark.createDataFrame(rows, "title string, date string, location string, price string, absolute_src string, ordinal int")
    blocks = render.event_blocks(dedup.merge_by_title(df), dedup.title_dates(df)).orderBy("ordinal", "part", "place").collect()
    texts = {t: "\n\n".join(b.text for b in blocks if b.title == t) for t in "tu"}
    assert texts == {
        "t": "## t\n\n日期: d1\n\n地点: l\n\n票价:\np\n\nq\n\n![](s)", "u": "## u\n\n日期:\n\nd2\n\nd1\n\n地点: l\n\n票价:\np",
    }


def test_no_section_is_lost(spark):
    rows = [(1, "教务通知", "甲", "发布时间：2026-04-18\n正文", 1), (2, "未分类", "乙", "发布时间：2026-04-18\n正文", 2), (3, "其他公众号信息", "丙", "发布时间：2026-04-18\n**正文** [链接](https://e.com)", 3), (4, "校外", "旧", "发布时间：2026-01-01", 4)]
    notices = spark.createDataFrame(rows, "notice_id int, section string, title string, content string, ordinal int")
    listed = section_table(spark, ["图书馆信息", "教务通知"])
    parts = issue.full_issue(notices, listed, CLOCK).orderBy("section_ord").collect()
    assert [p.section for p in parts] == ["图书馆信息", "教务通知", "未分类", "其他公众号信息", "校外"]
    assert parts[0].text == "# 图书馆信息\n\n本周暂无相关信息，大家先安心上课。" and parts[4]["items"] == 0
    assert "正文 链接" in parts[3].text and "**" not in parts[3].text
    ranked = issue.ranked_issue(notices, listed, CLOCK).orderBy("section_ord", "block").collect()
    assert [b.section for b in ranked if b.block == 0] == ["图书馆信息", "教务通知", "未分类", "其他公众号信息", "校外"]


def feed(spark, rows):
    schema = "notice_id int, ordinal int, title string, url string, digest string, publish_ts long, publish_text string, mid string, idx string, account string, author string, content string"
    return spark.createDataFrame(rows, schema)


def test_account_feed_is_clean_and_newest_first(spark):
    row = lambda i, ts, text: (i, i, f"校园新闻{i}", f"https://e.com/{i}", "", ts, "", "", "", "号", "", text)
    articles = feed(spark, [row(1, 1776300000, "**正文** [链接](https://e.com)"), row(2, 1776500000, "乙"), row(3, None, "丙 2026年5月1日"), row(4, 1700000000, "旧")])
    blocks = issue.account_feed(articles, CLOCK).orderBy("section_ord", "age", "ordinal").collect()
    assert [b.ordinal for b in blocks] == [2, 1, 3]
    assert blocks[1].text.endswith("内容:\n\n正文 链接")
    pages = spark.createDataFrame([("https://e.com/2", '<div id="js_content"><p>页面文字</p></div>')], "url string, html string")
    blocks = issue.account_feed(articles, CLOCK, pages=pages).collect()
    assert any("页面文字" in b.text for b in blocks)
    notes = spark.createDataFrame([(4, ["报名截止：2026年5月1日"])], "notice_id int, notes array<string>")
    assert issue.account_feed(articles, CLOCK, notes=notes).count() == 3
    empty = issue.account_feed(articles.where("notice_id = 4"), CLOCK).collect()
    assert [(b.section, b.text) for b in empty] == [("其他公众号信息", "## 占位卡片\n\n本期没有符合条件的最新公众号信息。")]


LINES = [
    ("", "skip", ""), ("[English](x)", "skip", ""), ("* [导航](y)", "skip", ""), ("**品牌**", "skip", ""), ("![海报](https://e.com/p.png)", "image", "https://e.com/p.png"),
    ("# 甲", "section", "甲"), ("## 乙", "item", "乙"), ("### 丙", "subhead", "丙"), ("要点透视：快", "lede", "快"), ("日期: 4月1日", "meta", "4月1日"),
    ("https://e.com", "link", "https://e.com"), ("- 点", "bullet", "点"), ("• 点", "bullet", "点"), ("**粗**", "note", "粗"), ("*注*", "note", "注"), ("**半", "note", "半"),
    ("其他: 值", "para", "其他: 值"), ("这个标签实在是太长了超过十二: 值", "para", "这个标签实在是太长了超过十二: 值"),
]


def test_line_kinds(spark):
    docs = spark.createDataFrame([(1, "\n".join(line for line, _, _ in LINES))], "doc_id int, text string")
    out = render.classify_lines(docs, brand_lines=("**品牌**",)).orderBy("line_no").collect()
    assert [(r.kind, r.value) for r in out] == [(kind, value) for _, kind, value in LINES]
    inline = {r.line_no: r.kind for r in render.classify_lines(docs, inline=True).collect()}
    assert inline[11] == "para" and inline[13] == "para" and inline[16] == "para" and inline[15] == "note"


def test_cards_open_and_close(spark):
    text = "前\n# 一\n## a\nx\n## b\n# 二\ny\n## c\n日期: 4月1日"
    html = render.render_cards(spark.createDataFrame([(1, text), (2, "段 <b>")], "doc_id int, text string")).orderBy("doc_id").collect()
    first = html[0].html
    tags = [t for t in first.split("\n") if t in ("<section class='section'>", "</section>", "<article class='card'>", "</article>")]
    assert tags == [
        "<section class='section'>", "<article class='card'>", "</article>", "<article class='card'>", "</article>", "</section>",
        "<section class='section'>", "<article class='card'>", "</article>", "</section>",
    ]
    assert "<span class='meta-value is-highlight'><span class='time-highlight'>4月1日</span></span>" in first
    assert html[1].html == "<p>段 &lt;b&gt;</p>"


def test_document_sink_keeps_order(spark, tmp_path):
    blocks = spark.range(200).select((F.col("id") % 5).alias("section_ord"), F.col("id").alias("block"), F.concat(F.lit("b"), F.col("id").cast("string")).alias("text"))
    sinks.write_document(blocks, str(tmp_path / "out"), ["section_ord", "block"])
    written = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))).split("\n\n")
    want = [f"b{i}" for s in range(5) for i in range(200) if i % 5 == s]
    assert [w for w in written if w] == want


def test_decision_log_is_partitioned_and_rerunnable(spark, tmp_path):
    log = spark.createDataFrame([("s", "t", "kept", "r", "g", "", "", "")], "section string, title string, status string, reason string, stage string, date string, url string, source string")
    for day in ("2026-04-20", "2026-04-21", "2026-04-20"):
        sinks.write_decisions(log, str(tmp_path / "log"), day)
    assert spark.read.json(str(tmp_path / "log")).count() == 2


def test_item_block(spark):
    df = spark.createDataFrame([("题", "# 题\n\n**正** 文\n## 小")], "title string, content string")
    assert df.select(render.item_block()).first()[0] == "## 题\n\n正 文\n### 小"


def test_ranked_issue_end_to_end(spark):
    rows = [(i, "教务通知", f"选课 {i}" if i % 2 else f"音乐会 {i}", "发布时间：2026-04-18\n**正文**", i) for i in range(6)] + [(9, "教务通知", "旧", "发布时间：2026-04-01", 9)]
    notices = spark.createDataFrame(rows, "notice_id int, section string, title string, content string, ordinal int")
    blocks = issue.ranked_issue(notices, section_table(spark, ["教务通知", "图书馆信息"]), CLOCK).orderBy("section_ord", "block").collect()
    assert [b.text.split("\n")[0] for b in blocks] == ["# 教务通知", "## 选课 1", "## 选课 3", "## 选课 5", "## 音乐会 0", "## 音乐会 2", "## 音乐会 4", "# 图书馆信息"]
    assert blocks[1].text.endswith("正文") and "重要性评分: 80/100" in blocks[1].text
