import pytest

from bulletin.functions.dates import RunClock
from bulletin.operators import filters, scoring

CLOCK = RunClock.of("2026-04-20")
LIB = "图书馆信息"

GUARDS = [
    ("其他", "新人文讲座", "", 70, 20, "cap_general_culture_lecture"),
    ("其他", "工作坊", "", 70, 35, "cap_general_activity"),
    ("其他", "x", "倒计时", 70, 25, "cap_publicity"),
    ("其他", "x", "研究生", 70, 10, "cap_non_undergrad"),
    ("其他", "x", "研究生与本科生", 70, 70, ""),
    ("物理系学术报告", "x", "研究生", 5, 80, "cap_non_undergrad,floor_physics_report"),
    ("其他", "Colloquium 1", "", 5, 80, "floor_physics_report"),
    ("其他", "SRT 报名", "", 5, 55, "floor_actionable_training"),
    ("其他", "SRT 报名 风采展", "", 5, 5, ""),
    ("其他", "SRT", "字" * 600 + "报名", 5, 5, ""),
    ("其他", "x", "熄灯", 5, 45, "floor_life_impact"),
    ("其他", "闭馆", "", 5, 5, ""),
    (LIB, "闭馆", "", 5, 90, "floor_lib_service_impact"),
    (LIB, "专利讲座 闭馆", "", 5, 15, "floor_lib_service_impact,cap_lib_weak_topic"),
    (LIB, "endnote", "", 90, 20, "cap_lib_research_tool"),
    (LIB, "keyword", "", 90, 30, "cap_lib_research_tool"),
    (LIB, "x", "4月1日", 90, 12, "cap_expired_activity"),
    (LIB, "x", "4月1日 4月30日", 90, 90, ""),
    (LIB, "latex", "4月1日", 90, 20, "cap_lib_research_tool,cap_expired_activity"),
]


def test_guardrails(spark):
    rows = [(i, s, t, c, score, "基") for i, (s, t, c, score, _, _) in enumerate(GUARDS)]
    df = spark.createDataFrame(rows, "i int, section string, title string, content string, score int, reason string")
    out = scoring.score_guardrails(df, CLOCK).orderBy("i").collect()
    assert [(r.score, ",".join(r.tags)) for r in out] == [g[4:] for g in GUARDS]
    assert out[0].reason == "基；score_guardrail=cap_general_culture_lecture" and out[4].reason == "基"


def test_guardrail_reason_without_base(spark):
    df = spark.createDataFrame([("其他", "工作坊", "", 1, "")], "section string, title string, content string, score int, reason string")
    assert scoring.score_guardrails(df, CLOCK).first().reason == "score_guardrail=cap_general_activity"


@pytest.mark.parametrize(
    "title, content, score",
    [("x", "", 35), ("选课", "", 80), ("选课 退课", "课程", 80), ("学术报告", "量子 SRT 报名", 100), ("博士后", "", 0), ("", "aI", 47), ("音乐会", "", 17)],
)
def test_rule_score(spark, title, content, score):
    df = spark.createDataFrame([(title, content)], "title string, content string")
    assert df.select(scoring.rule_score(df.title, df.content)).first()[0] == score


def test_account_section(spark):
    rows = [
        ("校学生会", "x", "", "献血", "学生会信息"), ("青年科协", "x", "", "", "青年科协信息"), ("a", "创业", "", "", "青年科协信息"),
        ("a", "x", "支教", "社团", "学生公益信息"), ("a", "x", "", "招新", "学生社团信息"), ("a", "x", "", "学生会", "其他公众号信息"),
    ]
    df = spark.createDataFrame(rows, "a string, t string, d string, c string, want string")
    out = df.select(scoring.account_section(df.a, df.t, df.d, df.c).alias("got"), "want").collect()
    assert all(r.got == r.want for r in out)


def test_keyword_rule_no_wins(spark):
    rows = [("选课", "", True), ("教师", "选课", False), ("x", "y", None), ("srt", "", None), ("选课", "公示", False)]
    df = spark.createDataFrame(rows, "t string, s string, want boolean")
    out = df.select(filters.keyword_rule(df.t, df.s).alias("got"), "want").collect()
    assert all(r.got is r.want for r in out)


def test_copy_decision_cascade(spark):
    rows = [("选课", True), ("教师", True), ("x", True), ("x", False), ("x", None)]
    df = spark.createDataFrame([(i, *r, "") for i, r in enumerate(rows)], "i int, title string, model_keep boolean, snippet string")
    out = filters.copy_decision(df, default_keep=False).orderBy("i").collect()
    assert [(r.keep, r.reason) for r in out] == [
        (True, "keyword_rule"), (False, "keyword_rule"), (True, "llm_yes"), (False, "llm_no"), (False, "undecided_default"),
    ]
    off = filters.copy_decision(df, model_on=False).collect()
    assert all(r.keep and r.reason == "llm_disabled" for r in off)


def test_report_words(spark):
    rows = [("学术报告", True), ("招聘信息 报告", False), ("LECTURE", True), ("通知", False), ("", False)]
    df = spark.createDataFrame(rows, "t string, want boolean")
    assert all(r.got == r.want for r in df.select(filters.looks_like_report(df.t).alias("got"), "want").collect())
    assert filters.keyword_list([" a ", ""], ["b", "a"]) == ["a", "b"] and filters.keyword_list([], ["b"]) == ["b"]
