"""The whole run: one record per notice, replies, earlier titles, feeds that fail."""

from collections import Counter

from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.dates import RunClock
from bulletin.operators import feeds, scoring
from bulletin.operators.sections import fallback_issue, section_table
from bulletin.plans import issue, run

CLOCK = RunClock.of("2026-04-20")
NOTICES = "notice_id int, section string, title string, content string, ordinal int"
NEWS = "发布时间：2026-04-18\n"


def notices(spark):
    rows = [(i, "教务通知", f"选课 {i}", f"{NEWS}退课安排 {i}", i) for i in range(8)]
    rows += [(10, "教务通知", "旧闻", "发布时间：2026-03-01\n过期", 10), (11, "教务通知", rules.PLACEHOLDER_TITLE, NEWS, 11), (12, "教务通知", "上期有过", NEWS, 12)]
    rows += [(20 + i, "物理系学术报告", f"报告 {i}", f"{NEWS}报告时间：2026年4月{d}日 10:00", 20 + i) for i, d in enumerate((10, 21, 22))]
    rows += [(30 + i, "其他公众号信息", f"文 {i}", NEWS + "正文", 30 + i) for i in range(7)]
    rows += [(40, "图书馆信息", "截止", f"{NEWS}报名截止：2026-04-01", 40), (50, None, "无栏目", NEWS, 50), (51, "新栏目", None, None, 51)]
    return spark.createDataFrame(rows, NOTICES)


def whole(spark, **more):
    return run.issue_run(notices(spark), section_table(spark), CLOCK, **more)


def test_without_replies_it_prints_what_the_plain_run_prints(spark):
    got = {tuple(r) for r in whole(spark).sections.collect()}
    assert got == {tuple(r) for r in issue.full_issue(notices(spark), section_table(spark), CLOCK).collect()}


def test_every_notice_leaves_one_record(spark):
    earlier = spark.createDataFrame([("[ 上期有过 ]：",), ("",)], "title string")
    errors = spark.createDataFrame([("crawl_lib", "连接超时", 1), ("crawl_info", "", 2)], "stage string, error string, stage_ord int")
    told = whole(spark, earlier=earlier, errors=errors, time="t").log.collect()
    of_notices = [r for r in told if "id" in r.details]
    assert Counter(int(r.details["id"]) for r in of_notices) == Counter(r.notice_id for r in notices(spark).collect())
    ends = {int(r.details["id"]): (r.status, r.reason, r.stage) for r in of_notices}
    assert ends[10] == ("dropped", "publish_older_than_cutoff", "ranked_raw_publish_filter")
    assert ends[11] == ("dropped", "placeholder", "ranked_selection") and ends[12] == ("dropped", "in_previous_issue", "previous_issue")
    assert sorted(s for i, (s, _, _) in ends.items() if i < 8) == ["dropped"] * 4 + ["kept"] * 4 and ends[7][1] == "below_section_best"
    assert ends[20][1] == "event_expired" and ends[40] == ("dropped", "deadline_expired", "temporal_filter") and ends[22][0] == "kept"
    assert sum(s == "kept" for i, (s, _, _) in ends.items() if 30 <= i < 40) == 5
    rest = {(r.section, r.status, r.reason, r.source) for r in told if "id" not in r.details}
    assert ("unknown", "error", "连接超时", "crawl_lib") in rest and ("图书馆信息", "empty", "no_item_printed", "") in rest
    assert not any(r.status == "error" and r.source == "crawl_info" for r in told) and {r.time for r in told} == {"t"}


def test_replies_decide_scores_choice_texts_and_summaries(spark):
    scores = spark.createDataFrame([("教务通知", '{"items":[{"index":8,"score":99,"reason":"要紧"},{"index":1,"score":1}]}')], "section string, raw string")
    chosen = spark.createDataFrame([("教务通知", "broken")], "section string, raw string")
    cleaned = spark.createDataFrame([(7, "整理后的退课安排 报告 时间 地点 讲座 摘要 学分 选课 学生 通知 课程"), (2, "")], "notice_id int, raw string")
    told = spark.createDataFrame([(7, "一句话\n摘要")], "notice_id int, raw string")
    text = {r.section: r.text for r in whole(spark, replies=run.Replies(scores, chosen, cleaned, told)).sections.collect()}["教务通知"]
    assert "选课 7" in text and "整理后的退课安排" in text and f"{rules.SUMMARY_LABEL}：一句话" in text
    assert "选课 0" not in text and text.count("\n## ") == 4


def test_a_run_without_notices_explains_itself(spark):
    errors = spark.createDataFrame([("crawl_info", "连接超时", 1)], "stage string, error string, stage_ord int")
    empty = notices(spark).limit(0)
    got = run.issue_run(empty, section_table(spark), CLOCK, errors=errors, brand="周报")
    texts = got.sections.orderBy("section_ord").collect()
    assert texts[0].section == "周报" and "- crawl_info: 连接超时" in texts[0].text
    assert [r.section for r in texts] == [r.section for r in fallback_issue(empty, errors, "周报").orderBy("section_ord").collect()]
    assert [r.reason for r in got.log.where("status = 'error'").collect()] == ["连接超时"]


def test_caps_and_floors_are_one_clamp(spark):
    titles = ["", "数据库课堂", "学术报告", "退课通知", "论文写作", "宿舍熄灯", "书法讲座 传统文化", "社会实践 报名", "研究生 招聘", "展览 2026-01-01"]
    rows = [(i, s, t, f"{b} 2026年1月2日", v) for i, (s, t, b, v) in enumerate((s, t, b, v) for s in ("图书馆信息", "物理系学术报告", "教务通知", None) for t in titles for b in ("", "开放时间 培训 SRT 闭馆") for v in (0, 33, 100))]
    table = spark.createDataFrame(rows, "notice_id int, section string, title string, content string, score int").withColumn("reason", F.lit("模型"))
    want = {r.notice_id: (r.score, r.reason) for r in scoring.score_guardrails(table, CLOCK).collect()}
    bounds = scoring.with_score_bounds(table.drop("score", "reason"), CLOCK).drop("score", "reason").join(table.select("notice_id", "score", "reason"), "notice_id")
    assert {r.notice_id: (r.score, r.reason) for r in scoring.bounded(bounds).collect()} == want
    assert len({s for s, _ in want.values()}) > 5


def test_a_feed_that_fails_takes_no_other_with_it(spark):
    table = notices(spark)

    def broken():
        raise RuntimeError("登录失败")

    torn = lambda: table.withColumn("title", F.when(F.col("ordinal") == 12, F.raise_error(F.lit("第12行"))).otherwise(F.col("title")))
    got = feeds.collect_feeds(spark, [("a", lambda: table), ("b", broken), ("c", torn), ("d", lambda: spark.read.parquet("/no/such/feed")), ("e", lambda: table.select("notice_id", "title"))])
    assert Counter(r.feed for r in got.items.collect()) == Counter({"a": table.count(), "e": table.count()})
    errors = {r.stage: (r.stage_ord, r.error) for r in got.errors.collect()}
    assert set(errors) == {"b", "c", "d"} and errors["b"] == (2, "登录失败") and errors["c"][0] == 3 and "第12行" in errors["c"][1] and "\tat " not in errors["c"][1]


def test_when_every_feed_fails_there_are_no_items(spark):
    def broken():
        raise ValueError

    got = feeds.collect_feeds(spark, [("a", broken)])
    assert got.items.count() == 0 and [r.error for r in got.errors.collect()] == ["ValueError"]
    cards = feeds.placeholders(got.items, got.errors.withColumn("stage", F.lit("crawl_info")), spark.createDataFrame(rules.STAGE_SECTIONS, "stage string, section string"), section_table(spark))
    kinds = Counter(r.kind for r in cards.collect())
    assert kinds == Counter({"error": 1, "empty": len(rules.REQUIRED_SECTIONS) - 1})
