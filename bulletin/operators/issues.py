"""Many issues in one run: every notice meets the issues it can still appear in."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulletin.functions.basics import let
from bulletin.functions.dates import IssueClock, RunClock, all_marks_past, date_marks, days_of, issue_cutoff, parse_datetime_text, publish_date_text, run_day
from bulletin.operators.rows import explode_once
from bulletin.operators.scoring import with_dated_scores
from bulletin.operators.temporal import is_recent

ISSUE = ["issue_date"]
#: Issues of one run. They travel with the plan, a few dozen bytes each.
MAX_ISSUES = 10_000


def issue_table(spark: SparkSession, clocks: Sequence[RunClock]) -> DataFrame:
    """issues(issue_date, issue_cutoff) of fixed run clocks."""
    rows = [(c.run_date, c.cutoff) for c in clocks]
    return spark.createDataFrame(rows, "issue_date date, issue_cutoff timestamp_ntz")


def issues_of(runs: DataFrame, day: str = "run_date", cutoff: str | None = None) -> DataFrame:
    """issues(issue_date, issue_cutoff) of a table of run dates as text; unreadable ones and repetitions go."""
    at = run_day(F.col(day))
    known = runs.select(at.alias("issue_date"), issue_cutoff(at, F.col(cutoff) if cutoff else None).alias("issue_cutoff"))
    return known.where(F.col("issue_date").isNotNull()).groupBy("issue_date").agg(F.min("issue_cutoff").alias("issue_cutoff"))


def _bounds(issues: DataFrame) -> tuple[int, dt.date | None]:
    seen = issues.agg(F.count(F.lit(1)), F.max("issue_date")).first()
    if seen[0] > MAX_ISSUES:
        raise ValueError(f"{seen[0]} issues in one run; at most {MAX_ISSUES}, split the table by date")
    return seen[0], seen[1]


def issue_notices(notices: DataFrame, issues: DataFrame) -> DataFrame:
    """Every notice once per issue that may print it, with ``issue_date`` and ``issue_cutoff``."""
    pairs = explode_once(with_live_issues(notices, issues), notices.columns, F.col("_live"), "_i", "_issue")
    return pairs.select(*notices.columns, "_issue.issue_date", "_issue.issue_cutoff")


def with_live_issues(notices: DataFrame, issues: DataFrame) -> DataFrame:
    """Add ``_published`` and ``_marks``, the dates of a notice as written, and ``_live``, the issues that may print it.

    A range join in the row: the issues, few and counted first, are one array, and each
    notice keeps those that begin no later than its last relevant day. No row is shuffled,
    and a notice that is over meets no later issue, so the work grows with what is live.

    The last day is an upper bound, never a verdict: the filters judge each pair by the
    clock of its issue afterwards. A date without a year is read in the run's year, so the
    bound reads it in the first leap year from the last issue on, which no run's reading
    exceeds and in which every day of the year exists. Undated notices meet every issue.
    """
    n, last = _bounds(issues)
    dated = notices.withColumns({"_published": publish_date_text(F.col("content")), "_marks": date_marks(F.col("content"))})
    if not n:
        return dated.withColumn("_live", F.array().cast("array<struct<issue_date: date, issue_cutoff: timestamp_ntz>>"))
    leap = next(y for y in range(last.year, last.year + 9) if calendar.isleap(y))
    bound = RunClock(dt.date(leap, 1, 1))
    listed = issues.agg(F.collect_list(F.struct("issue_date", "issue_cutoff"))).scalar()
    published = parse_datetime_text(F.col("_published"), bound).cast("date")
    until = let(published, lambda at: F.when(at.isNotNull(), F.greatest(at, F.array_max(days_of(F.col("_marks"), bound)))))
    begins = lambda i: F.least(i["issue_date"], i["issue_cutoff"].cast("date"))
    staged = dated.withColumns({"_until": until, "_issues": listed})
    live = F.filter("_issues", lambda i: F.col("_until").isNull() | (begins(i) <= F.col("_until")))
    return staged.withColumn("_live", live).drop("_until", "_issues")


def issue_scores(notices: DataFrame, issues: DataFrame, body: Column) -> DataFrame:
    """Narrow rows (notice_id, section, title, ordinal, issue, score) of every notice that is recent in an issue.

    A notice is parsed, cleaned (``body``) and scored once, whatever the number of its
    issues: what an issue adds is the reading of a few dates. No text leaves the row.
    """
    at = lambda i: IssueClock(issue=i)
    recent = F.filter("_live", lambda i: is_recent(F.col("_published"), F.col("_marks"), at(i)))
    dated = with_live_issues(notices, issues).withColumn("_recent", recent)
    scored = with_dated_scores(dated.withColumn("content", F.when(F.size("_recent") > 0, body)))
    score = lambda i: F.when(all_marks_past(F.col("dates"), at(i)), F.col("over")).otherwise(F.col("open")).alias("score")
    judged = F.transform("_recent", lambda i: F.struct(i["issue_date"].alias("issue_date"), i["issue_cutoff"].alias("issue_cutoff"), score(i)))
    narrow = ["notice_id", "section", "title", "ordinal"]
    return explode_once(scored, narrow, judged, "_i", "_issue").select(*narrow, "_issue.*")


def sections_per_issue(issues: DataFrame, sections: DataFrame) -> DataFrame:
    """The section list (short, fixed) once per issue."""
    listed = sections.agg(F.collect_list(F.struct("section", "section_ord"))).scalar()
    return issues.select("issue_date", F.explode(listed).alias("_s")).select("issue_date", "_s.section", "_s.section_ord")
