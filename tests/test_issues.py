"""Several issues in one run against runs of their own."""

import datetime as dt

import pytest

from bulletin.functions.dates import IssueClock, RunClock
from bulletin.operators import issues as I
from bulletin.operators import temporal
from bulletin.operators.sections import section_table
from bulletin.plans import issue

NOTICES = "notice_id int, section string, title string, content string, ordinal int"
CLOCKS = [RunClock.of("2027-12-27"), RunClock.of("2028-03-06"), RunClock.of("2026-04-20", "2026-04-01 08:00"), RunClock.of("2026-04-27")]
LINES = [
    "发布时间：2026-04-18 09:00", "发布时间：4月26日", "发布时间：2026年3月1日\n活动时间：5月1日", "没有日期", "发布时间：2月29日", "发布时间：2026年4月1日",
    "发布时间：2025-01-01\n截止：2028-03-10", "发布时间：2027年12月25日\n报名截止：12月26日", "发布时间：2026-02-30", "发布时间：2026年4月2日\n会议 4月20日 10:00",
]


def notices(spark):
    rows = [(i * 10 + j, ["教务通知", "图书馆信息", "物理系学术报告", "新栏目"][(i + j) % 4], f"标题 {i} {j}", f"{line}\n正文 {j}", i * 10 + j) for i, line in enumerate(LINES) for j in range(5)]
    return spark.createDataFrame([*rows, (900, None, None, None, 900), (901, "教务通知", "空", "", 901)], NOTICES)


def test_each_issue_equals_a_run_of_its_own(spark):
    table, sections = notices(spark), section_table(spark)
    together = issue.full_issues(table, I.issue_table(spark, CLOCKS), sections).collect()
    for clock in CLOCKS:
        alone = {tuple(r) for r in issue.full_issue(table, sections, clock).collect()}
        assert {tuple(r)[1:] for r in together if r.issue_date == clock.run_date} == alone
    assert len({r.issue_date for r in together}) == len(CLOCKS)


def test_the_range_join_only_leaves_out_what_the_clock_drops(spark):
    table = notices(spark)
    live = temporal.publish_recency(I.issue_notices(table, I.issue_table(spark, CLOCKS)), IssueClock())
    for clock in CLOCKS:
        got = {(r.notice_id, r.reason, r.basis) for r in live.where(live.keep & (live.issue_date == clock.run_date)).collect()}
        alone = temporal.publish_recency(table, clock)
        assert got == {(r.notice_id, r.reason, r.basis) for r in alone.where("keep").collect()}
    assert live.count() < table.count() * len(CLOCKS)


@pytest.mark.parametrize("days", [None, 3])
def test_prefilter_by_columns(spark, days):
    table = spark.createDataFrame([(i, 1_776_000_000 + i * 40_000 if i else None) for i in range(40)], "notice_id int, publish_ts bigint")
    for zone in ("UTC", "Asia/Shanghai"):
        clock = RunClock.of("2026-04-20", zone=zone)
        alone = temporal.publish_prefilter(table, clock, days)
        staged = table.crossJoin(I.issue_table(spark, [clock]))
        assert [r.keep for r in temporal.publish_prefilter(staged, IssueClock(zone), days).collect()] == [r.keep for r in alone.collect()]


def test_run_dates_of_a_table(spark):
    runs = spark.createDataFrame([("20260420", None), (" 2026-4-20 ", dt.datetime(2026, 4, 1)), ("2026-13-01", None), ("soon", None), (None, None)], "run_date string, cutoff timestamp_ntz")
    assert [tuple(r) for r in I.issues_of(runs, cutoff="cutoff").collect()] == [(dt.date(2026, 4, 20), dt.datetime(2026, 4, 1))]
    assert [tuple(r) for r in I.issues_of(runs).collect()] == [(dt.date(2026, 4, 20), dt.datetime(2026, 4, 13))]


def test_no_issue_and_too_many(spark, monkeypatch):
    table = notices(spark)
    assert I.issue_notices(table, I.issue_table(spark, CLOCKS).limit(0)).count() == 0
    monkeypatch.setattr(I, "MAX_ISSUES", 3)
    with pytest.raises(ValueError, match="4 issues"):
        I.issue_notices(table, I.issue_table(spark, CLOCKS))


def test_issues_are_met_without_a_shuffle(spark):
    plan = I.issue_notices(notices(spark), I.issue_table(spark, CLOCKS))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    main = text.split("Subquery")[0]
    assert "Join" not in text and "Exchange" not in main
