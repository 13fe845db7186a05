"""Articles that arrive in several runs, and titles that earlier issues printed."""

import datetime as dt

from pyspark.sql import functions as F

from bulletin.functions.dates import RunClock
from bulletin.operators import dedup, issues, memory
from bulletin.plans import issue
from bulletin.streaming import ingest

CLOCK = RunClock.of("2026-04-20")
SCHEMA = "notice_id int, ordinal int, title string, url string, digest string, publish_ts bigint, publish_text string, mid string, idx string, account string, author string, content string, fetched_at timestamp"
DAY = 86_400


def at(day, hour=0):
    return int(dt.datetime(2026, 4, day, hour, tzinfo=dt.UTC).timestamp())


def article(i, published, fetched=20, mid=None, content="正文"):
    when = dt.datetime(2026, 4, fetched)
    return (i, i, f"题 {i}", f"https://e.com/{mid or i}", "", published, "", mid or str(i), "1", "账号", "", content, when)


class Feed:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)

    def arrive(self, rows, files=1):
        self.spark.createDataFrame(rows, SCHEMA).repartition(files).write.mode("append").parquet(f"{self.folder}/landing")
        return self

    def run(self, files_per_batch=1000):
        stream = ingest.landed(self.spark, f"{self.folder}/landing", self.spark.createDataFrame([], SCHEMA).schema, files_per_batch=files_per_batch)
        query = ingest.ingest(stream, f"{self.folder}/out", f"{self.folder}/progress", CLOCK)
        query.awaitTermination()
        return query

    def judged(self):
        return sorted((r.notice_id, r.keep, r.reason) for r in ingest.ingested(self.spark, f"{self.folder}/out").collect())


ROWS = [article(i, at(14 + i % 6, i), content=["正文", "活动时间：2026-04-21", "报名截止：2026-04-01"][i % 3]) for i in range(12)] + [article(20, None), article(21, 0)]


def test_two_arrivals_that_overlap_equal_one_full_run(spark, tmp_path):
    feed = Feed(spark, tmp_path).arrive(ROWS[:8])
    feed.run()
    feed.arrive(ROWS[4:], files=3).run(files_per_batch=1)
    full = issue.judged_articles(dedup.dedupe_articles(spark.createDataFrame(ROWS, SCHEMA)), CLOCK).collect()
    assert feed.judged() == sorted((r.notice_id, r.keep, r.reason) for r in full)
    items = ingest.ingested_items(spark, f"{feed.folder}/out")
    assert {(r.notice_id, r.section) for r in items.collect()} == {(r.notice_id, r.section) for r in full if r.keep}
    log = ingest.ingested_decisions(spark, f"{feed.folder}/out", "now").collect()
    assert len(log) == len(ROWS) and {r.status for r in log} == {"kept", "dropped"} and {r.source for r in log} == {"账号"}


def test_a_run_without_new_files_adds_nothing(spark, tmp_path):
    feed = Feed(spark, tmp_path).arrive(ROWS)
    feed.run()
    before = feed.judged()
    feed.run()
    assert feed.judged() == before


def test_late_copies_and_copies_in_time_are_dropped(spark, tmp_path):
    feed = Feed(spark, tmp_path).arrive([article(1, at(2), 3, "early"), article(2, at(15), 15, "mid"), article(3, at(20), 20, "last")])
    feed.run()
    # The watermark is the 13th: a late copy goes as late, a copy of the 15th by its key, a new article of the 16th stays.
    feed.arrive([article(11, at(2), 21, "early"), article(12, at(15), 21, "mid"), article(13, at(16), 21, "new"), article(14, at(1), 21, "old news")]).run()
    assert [n for n, _, _ in feed.judged()] == [1, 2, 3, 13]


def test_a_date_far_ahead_does_not_make_the_others_late(spark, tmp_path):
    feed = Feed(spark, tmp_path).arrive([article(1, at(19) + 9000 * DAY, 20)])
    feed.run()
    feed.arrive([article(2, at(18), 20)]).run()
    assert [n for n, _, _ in feed.judged()] == [1, 2]


def test_a_repeated_micro_batch_replaces_its_output(spark, tmp_path):
    batch = spark.createDataFrame(ROWS, SCHEMA).withColumn("event_time", F.col("fetched_at"))
    write = ingest._write_batch(str(tmp_path / "out"), CLOCK)
    write(batch, 0)
    write(batch, 0)
    write(batch.where("notice_id < 3"), 1)
    assert ingest.ingested(spark, str(tmp_path / "out")).count() == len(ROWS) + 3


def history_of(spark, folder):
    for day, titles in (("2026-04-13", ["甲", "[乙]：其一"]), ("2026-03-30", ["丙"]), ("2026-02-01", ["丁"])):
        memory.remember(spark.createDataFrame([("教务通知", t) for t in titles], "section string, title string"), folder, day)
    return memory.history(spark, folder)


def test_issues_remember_what_was_printed_before_them(spark, tmp_path):
    history_of(spark, str(tmp_path / "h"))
    memory.remember(spark.createDataFrame([("教务通知", "甲"), ("教务通知", "")], "section string, title string"), str(tmp_path / "h"), "2026-04-13")
    table = issues.issue_table(spark, [CLOCK, RunClock.of("2026-04-13"), RunClock.of("2026-03-30")])
    items = spark.createDataFrame([(c.run_date, t) for c in (CLOCK, RunClock.of("2026-04-13"), RunClock.of("2026-03-30")) for t in "甲乙丙丁"], "issue_date date, title string")
    titles = memory.history(spark, str(tmp_path / "h"))
    left = memory.drop_remembered(items, memory.remembered(titles, table)).collect()
    by_issue = {d: "".join(sorted(r.title for r in left if r.issue_date == d)) for d in {r.issue_date for r in left}}
    # Repeating the 13th replaced its titles; the title of February is out of reach of April.
    assert by_issue == {dt.date(2026, 4, 20): "".join(sorted("乙丁")), dt.date(2026, 4, 13): "".join(sorted("甲乙丁")), dt.date(2026, 3, 30): "".join(sorted("甲乙丙丁"))}


def test_only_the_folders_of_remembered_dates_are_read(spark, tmp_path):
    titles = history_of(spark, str(tmp_path / "h"))
    table = issues.issue_table(spark, [CLOCK])
    seen = memory.remembered(titles, table)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert {r.title_key for r in seen.collect()} == {r.title_key for r in titles.where("run_date >= '2026-03-23'").collect()}
