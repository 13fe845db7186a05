"""Keep or drop by time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions import dates as D
from bulletin.functions.basics import let, text_or_empty
from bulletin.functions.dates import Clock
from bulletin.operators.decisions import decide
from bulletin.operators.rows import explode_once


def notice_text() -> Column:
    return F.concat(text_or_empty(F.col("title")), F.lit("\n"), text_or_empty(F.col("content")))


def with_signals(df: DataFrame, clock: Clock, text: Column | None = None, fallback: Column | None = None) -> DataFrame:
    return df.withColumn("signals", D.signals(notice_text() if text is None else text, clock, fallback))


def signal_rows(df: DataFrame, key: str = "notice_id") -> DataFrame:
    """One row per signal of a table made by ``with_signals``."""
    return explode_once(df, [key], F.col("signals"), "_i", "s").select(key, "s.*")


def distinct_signals(df: DataFrame, key: str = "notice_id") -> DataFrame:
    """One row per (kind, raw, parsed) of a row made by ``with_signals``, with the first context. Work inside the row."""
    # Equal signals are neighbours once sorted, the earliest first.
    ordered = F.array_sort(
        F.transform("signals", lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "raw", "parsed", "line_no", "pos", "context")]))
    )

    def firsts(found: Column) -> Column:
        same = lambda s, i: F.forall(
            F.slice(found, i, F.lit(1)), lambda o: (o["kind"] == s["kind"]) & o["raw"].eqNullSafe(s["raw"]) & o["parsed"].eqNullSafe(s["parsed"])
        )
        return F.filter(found, lambda s, i: (i == 0) | ~same(s, F.greatest(i, F.lit(1))))

    return explode_once(df, [key], let(ordered, firsts), "_i", "s").select(key, "s.*")


def latest_signals(df: DataFrame, key: str = "notice_id") -> DataFrame:
    """Latest parsed time per kind of every row that has a signal. Work inside the row."""
    of = lambda kind: F.array_max(
        F.transform(F.filter("signals", lambda s: s["kind"] == kind), lambda s: s["parsed"])
    ).alias(kind)
    return df.where(F.size("signals") > 0).select(key, of("deadline"), of("event"), of("publish"))


def temporal_relevance(
    df: DataFrame, clock: Clock, text: Column | None = None, fallback: Column | None = None
) -> DataFrame:
    """Deadline beats event beats publish date; the latest of the deciding kind is the basis.

    Everything is one expression inside the row: no shuffle, and a filter on ``keep``
    that Catalyst pushes down still evaluates it once.
    """
    now, cutoff, grace = clock.before_now(), clock.cutoff_at, _event_limit(clock)

    def judge(latest: Column) -> Column:
        deadline, event, publish = latest["deadline"], latest["event"], latest["publish"]
        reason = (
            F.when(deadline >= now, "deadline_active").when(deadline < now, "deadline_expired")
            .when(event >= grace, "event_active").when(event < grace, "event_expired")
            .when(publish >= cutoff, "publish_recent").when(publish < cutoff, "publish_older_than_cutoff")
            .otherwise("no_parseable_date_keep")
        )
        return F.struct(reason.alias("reason"), F.coalesce(deadline, event, publish).alias("basis"))

    found = D.signals(notice_text() if text is None else text, clock, fallback)
    verdict = let(
        found,
        lambda s: let(
            F.struct(*[D.latest(s, kind).alias(kind) for kind in ("deadline", "event", "publish")]), judge
        ),
    )
    dropped = ("deadline_expired", "event_expired", "publish_older_than_cutoff")
    return _from_verdict(df, verdict, dropped, "temporal_filter")


def _from_verdict(df: DataFrame, verdict: Column, dropped: tuple[str, ...], stage: str) -> DataFrame:
    """keep, reason and basis from one struct expression."""
    staged = df.withColumn("_v", verdict)
    reason = F.col("_v.reason")
    return decide(staged.withColumn("basis", F.col("_v.basis")), ~reason.isin(*dropped), reason, stage).drop("_v")


def publish_recency(df: DataFrame, clock: Clock) -> DataFrame:
    """Recent, undated, or old with a date still to come."""
    cutoff = clock.cutoff_at

    def judge(p: Column) -> Column:
        ahead = D.has_current_or_future_date(F.col("content"), clock)
        reason = (
            F.when(p["at"].isNull(), "no_parseable_publish_date_keep")
            .when(p["at"] >= cutoff, "publish_recent")
            .when(ahead, "publish_old_but_effective")
            .otherwise("publish_older_than_cutoff")
        )
        return F.struct(reason.alias("reason"), F.coalesce(D.iso_minute(p["at"]), p["raw"]).alias("basis"))

    verdict = let(
        D.publish_date_text(F.col("content")),
        lambda raw: let(F.struct(raw.alias("raw"), D.parse_datetime_text(raw, clock).alias("at")), judge),
    )
    return _from_verdict(df, verdict, ("publish_older_than_cutoff",), "ranked_raw_publish_filter")


def is_recent(published: Column, marks: Column, clock: Clock) -> Column:
    """Whether ``publish_recency`` keeps a notice, from its publish date text and date marks."""
    ahead = F.exists(D.days_of(marks, clock), lambda d: d >= clock.today)
    return let(D.parse_datetime_text(published, clock), lambda at: at.isNull() | (at >= clock.cutoff_at) | F.coalesce(ahead, F.lit(False)))


def publish_prefilter(df: DataFrame, clock: Clock, days_limit: int | None = None, column: str = "publish_ts") -> DataFrame:
    """Epoch or timestamp against the cutoff; the comparison is on the raw column, so scans can use it."""
    if dict(df.dtypes)[column].startswith("timestamp"):
        bound = clock.before_now(dt.timedelta(days=max(int(days_limit), 0))) if days_limit else clock.cutoff_at
    else:
        bound = clock.epoch_of(days_limit)
    ts = F.col(column)
    reason = (
        F.when(ts.isNull(), "publish_time_missing_keep_for_review")
        .when(ts >= bound, "publish_recent")
        .otherwise("publish_older_than_cutoff")
    )
    return decide(df, ts.isNull() | (ts >= bound), reason, "publish_prefilter")


def _event_limit(clock: Clock) -> Column:
    return clock.before_now(dt.timedelta(hours=rules.EVENT_GRACE_HOURS))


def event_expired(content: Column, clock: Clock) -> Column:
    """The labelled event time is more than half a day past; no readable time is not."""
    return F.coalesce(D.labelled_datetime(content, rules.EVENT_LABELS) < _event_limit(clock), F.lit(False))


def expired_event(df: DataFrame, clock: Clock) -> DataFrame:
    """Flag items whose labelled event is over, keeping the time as ``event_at``."""
    staged = df.withColumn("event_at", D.labelled_datetime(F.col("content"), rules.EVENT_LABELS))
    gone = F.coalesce(F.col("event_at") < _event_limit(clock), F.lit(False))
    return decide(staged, ~gone, F.when(gone, "expired_physics_event").otherwise("event_open"), "section_filter")
