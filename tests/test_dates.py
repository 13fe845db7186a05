import datetime as dt

from pyspark.sql import functions as F

from bulletin.functions import dates as D
from bulletin.operators import temporal
from bulletin.operators.decisions import decisions

CLOCK = D.RunClock.of("20260420")
AT = dt.datetime


def test_clock_forms_and_cutoff():
    assert CLOCK == D.RunClock.of("2026-04-20")
    assert CLOCK.now == AT(2026, 4, 20) and CLOCK.cutoff == AT(2026, 4, 13)
    assert D.RunClock.of("2026-04-20", "2026-04-01 08:00").cutoff == AT(2026, 4, 1, 8)


def test_parse_datetime_text(values):
    got = values(
        lambda c: D.parse_datetime_text(c, CLOCK),
        [
            "2026年4月25日 13:30", "2026年4月25日13:30", "2026-4-5 周六 13:30", "2026.04.05 25:75", "4月25日13:30",
            "2026年2月30日 又 4月1日", "1998-01-02", "", None, "４月２５日",
        ],
    )
    assert got == [
        AT(2026, 4, 25, 13, 30), AT(2026, 4, 25), AT(2026, 4, 5), AT(2026, 4, 5, 23, 59), AT(2026, 4, 25, 13, 30),
        None, None, None, None, AT(2026, 4, 25),
    ]


def test_parse_datetime_eod(values):
    got = values(D.parse_datetime_eod, ["2026年4月25日13:30", "2026/4/25", "4月25日", "2026-02-30"])
    assert got == [AT(2026, 4, 25, 13, 30), AT(2026, 4, 25, 23, 59), None, None]


def test_inline_date_is_text(values):
    assert values(D.inline_date, ["x 2026年4月5日", "2026.4.31", "4月5日", None]) == ["2026-04-05", "2026-04-31", "", ""]


def test_day_predicates_read_short_dates_inside_full_ones(values):
    texts = ["2025年12月3日", "2025-12-03", "4月19日", "4月20日", "无"]
    assert values(lambda c: D.has_current_or_future_date(c, CLOCK), texts) == [True, False, False, True, False]
    assert values(lambda c: D.all_dates_past(c, CLOCK), texts) == [False, True, True, False, False]


def test_parse_epoch(values):
    got = values(D.parse_epoch, ["1700000000", "0", "-5", " 2026-04-12 08:30 ", "2026-04-12", "2026-04-12 08:30:15", "x", None])
    assert got == [1700000000, None, None, 1775982600, 1775952000, 1775982615, None, None]


def test_publish_date_text(values):
    got = values(D.publish_date_text, ["发布时间： 4月1日 上午\n2026-01-01", "见 2026-04-02 与 4月3日", "于4月3日", "无"])
    assert got == ["4月1日 上午", "2026-04-02", "4月3日", ""]


CASES = [
    ("报名截止：2026-04-20", "", True, "deadline_active", AT(2026, 4, 20, 23, 59)),
    ("截止 2026-04-19 10:00\n活动时间 2026-05-01", "", False, "deadline_expired", AT(2026, 4, 19, 10)),
    ("活动时间：2026-04-19 12:00", "", True, "event_active", AT(2026, 4, 19, 12)),
    ("活动时间：2026-04-19 11:59", "", False, "event_expired", AT(2026, 4, 19, 11, 59)),
    ("讲座时间 2026年4月19日13:30", "", False, "event_expired", AT(2026, 4, 19)),
    ("发布时间 2026-04-12", "", False, "publish_older_than_cutoff", AT(2026, 4, 12)),
    ("无日期", "2026-04-13", True, "publish_recent", AT(2026, 4, 13)),
    ("见 2026-01-01", "", True, "no_parseable_date_keep", None),
    ("报名时间 2026年2月30日", "", True, "no_parseable_date_keep", None),
    ("Due 4月21日", "", True, "deadline_active", AT(2026, 4, 21, 23, 59)),
]


def test_temporal_relevance(spark):
    rows = [(i, text, back) for i, (text, back, *_) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "notice_id int, content string, back string").withColumn("title", F.lit(""))
    out = temporal.temporal_relevance(df, CLOCK, fallback=F.col("back")).orderBy("notice_id").collect()
    assert [(r.keep, r.reason, r.basis) for r in out] == [c[2:] for c in CASES]


def test_signals_keep_first_context_and_order(spark):
    text = "通知 4月1日，4月2日\n\n截止 4月3日\n又 4月1日"
    df = spark.createDataFrame([(1, text)], "notice_id int, t string")
    rows = temporal.signal_rows(temporal.with_signals(df, CLOCK, text=F.col("t")))
    assert [(r.line_no, r.pos, r.kind, r.raw) for r in rows.collect()] == [
        (1, 1, "mentioned", "4月1日"), (1, 2, "mentioned", "4月2日"), (3, 1, "deadline", "4月3日"), (4, 1, "mentioned", "4月1日"),
    ]
    distinct = {(r.kind, r.raw): r.context for r in temporal.distinct_signals(temporal.with_signals(df, CLOCK, text=F.col("t"))).collect()}
    assert distinct[("mentioned", "4月1日")].startswith("通知") and len(distinct) == 3


def test_every_notice_has_one_decision(spark):
    rows = [(i, f"t{i}", f"发布时间：2026-04-{i + 1:02d}") for i in range(28)]
    df = spark.createDataFrame(rows, "notice_id int, title string, content string")
    log = decisions(temporal.publish_recency(df, CLOCK)).collect()
    assert len(log) == 28 and {r.status for r in log} == {"kept", "dropped"}
    assert all(r.section == "unknown" for r in log)


def test_format_publish_in_a_zone(spark):
    df = spark.createDataFrame([(1775982600, ""), (0, " 页 "), (None, " ")], "e long, t string")
    got = [r[0] for r in df.select(D.format_publish(df.e, df.t, "Asia/Shanghai")).collect()]
    assert got == ["2026-04-12 16:30", "页", "N/A"]
    assert df.select(D.format_publish(df.e, df.t)).first()[0] == "2026-04-12 08:30"
