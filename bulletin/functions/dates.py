"""Dates in free text: extraction, parsing and the predicates built on them.

Times are naive, at minute precision, so everything is TIMESTAMP_NTZ. "Today" is
always the run date handed in by the caller, never the wall clock.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.basics import (
    DIGIT as D,
    FULLWIDTH_DIGITS,
    WS,
    find,
    find_all,
    has_any,
    let,
    lines,
    non_empty,
    strip,
    text_or_empty,
)

FULL_DATE = rf"20{D}{{2}}[年\-/.]{D}{{1,2}}[月\-/.]{D}{{1,2}}日?"
SHORT_DATE = rf"{D}{{1,2}}月{D}{{1,2}}日"
CLOCK = rf"{D}{{1,2}}[:：]{D}{{2}}"
ANY_DATE = rf"{FULL_DATE}|{SHORT_DATE}"
SIGNAL = rf"(?:{ANY_DATE})(?:{WS}*(?:周[一二三四五六日天])?)?(?:{WS}*{CLOCK})?"
# A full date takes a time only after white space; a short date also without.
FULL_STAMP = rf"{FULL_DATE}(?:{WS}+{CLOCK})?"
SHORT_STAMP = rf"{SHORT_DATE}(?:{WS}*{CLOCK})?"
LOOSE_FULL_STAMP = rf"{FULL_DATE}(?:{WS}*{CLOCK})?"
ISO_MINUTE = "yyyy-MM-dd'T'HH:mm"


@dataclass(frozen=True)
class RunClock:
    """The run date and what follows from it, fixed for a whole run."""

    run_date: dt.date
    cutoff_override: dt.datetime | None = None
    zone: str = "UTC"

    @classmethod
    def of(cls, run_date: str | dt.date, cutoff: str = "", zone: str = "UTC") -> RunClock:
        if isinstance(run_date, str):
            text = run_date.strip()
            shape = "%Y%m%d" if re.fullmatch(r"\d{8}", text) else "%Y-%m-%d"
            run_date = dt.datetime.strptime(text, shape).date()
        override = dt.datetime.fromisoformat(cutoff) if cutoff else None
        return cls(run_date, override, zone)

    @property
    def now(self) -> dt.datetime:
        return dt.datetime.combine(self.run_date, dt.time.min)

    @property
    def cutoff(self) -> dt.datetime:
        return self.cutoff_override or self.now - dt.timedelta(days=rules.ISSUE_DAYS)

    @property
    def year(self) -> int:
        return self.run_date.year

    def epoch(self, moment: dt.datetime) -> int:
        return int(moment.replace(tzinfo=ZoneInfo(self.zone)).timestamp())

    # What the operators read: constants here, columns in an ``IssueClock``.

    @property
    def today(self) -> Column:
        return F.lit(self.run_date)

    @property
    def year_mark(self) -> Column:
        return F.lit(f"{self.year}年")

    @property
    def cutoff_at(self) -> Column:
        return ntz(self.cutoff)

    def before_now(self, span: dt.timedelta = dt.timedelta(0)) -> Column:
        return ntz(self.now - span)

    def epoch_of(self, days_limit: int | None = None) -> Column:
        return F.lit(self.epoch(self.now - dt.timedelta(days=max(int(days_limit), 0)) if days_limit else self.cutoff))


@dataclass(frozen=True)
class IssueClock:
    """The clock of the issue that a row belongs to: columns ``issue_date`` and ``issue_cutoff``, or a struct of them."""

    zone: str = "UTC"
    issue: Column | None = None

    @property
    def today(self) -> Column:
        return F.col("issue_date") if self.issue is None else self.issue["issue_date"]

    @property
    def year_mark(self) -> Column:
        return F.concat(F.year(self.today).cast("string"), F.lit("年"))

    @property
    def cutoff_at(self) -> Column:
        return F.col("issue_cutoff") if self.issue is None else self.issue["issue_cutoff"]

    def before_now(self, span: dt.timedelta = dt.timedelta(0)) -> Column:
        return self.today.cast("timestamp_ntz") - F.lit(span)

    def epoch_of(self, days_limit: int | None = None) -> Column:
        at = self.before_now(dt.timedelta(days=max(int(days_limit), 0))) if days_limit else self.cutoff_at
        start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("SECOND", start, F.convert_timezone(F.lit(self.zone), F.lit("UTC"), at))


Clock = RunClock | IssueClock


def ntz(moment: dt.datetime) -> Column:
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def run_day(text: Column) -> Column:
    """A run date written ``yyyy-MM-dd`` or ``yyyyMMdd``; anything else is NULL."""
    bare = strip(text)
    shape = F.when(bare.rlike(r"^[0-9]{8}\z"), "yyyyMMdd").when(bare.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"), "yyyy-M-d")
    return F.when(shape.isNotNull(), F.try_to_timestamp(bare, shape)).cast("date")


def issue_cutoff(day: Column, override: Column | None = None) -> Column:
    """The time since which a notice counts as recent: the override, else a week before the run date."""
    usual = day.cast("timestamp_ntz") - F.lit(dt.timedelta(days=rules.ISSUE_DAYS))
    return usual if override is None else F.coalesce(override, usual)


def iso_minute(col: Column) -> Column:
    return F.date_format(col, ISO_MINUTE)


def _number(text: Column) -> Column:
    return F.translate(text, FULLWIDTH_DIGITS, "0123456789").cast("int")


def _stamp(matched: Column, hour: int, minute: int) -> Column:
    """Digit runs of a matched date (year, month, day[, hour, minute]) as a timestamp."""
    def build(parts: Column) -> Column:
        at = lambda i: _number(F.get(parts, F.lit(i)))
        return F.try_make_timestamp_ntz(
            at(0), at(1), at(2),
            F.least(F.coalesce(at(3), F.lit(hour)), F.lit(23)),
            F.least(F.coalesce(at(4), F.lit(minute)), F.lit(59)),
            F.lit(0),
        )

    return let(find_all(matched, f"{D}+"), build)


def parse_datetime_text(text: Column, clock: Clock) -> Column:
    """First full date, else first month-day in the run year; an impossible date is NULL.

    A full date wins even when it is impossible, and ``2026年4月25日13:30`` has no
    white space before its time, so it reads as midnight.
    """
    full = find(text, FULL_STAMP, 0)
    short = find(text, SHORT_STAMP, 0)
    return _stamp(F.coalesce(full, F.concat(clock.year_mark, short)), 0, 0)


def parse_datetime_eod(text: Column) -> Column:
    """First full date, 23:59 where it has no time."""
    return _stamp(find(text, LOOSE_FULL_STAMP, 0), 23, 59)


def first_stamp_eod(text: Column) -> Column:
    """First inline full date with its time, end of day by default."""
    matched = find(text, rf"{FULL_DATE}(?:{WS}*[0-2]?{D}[:：]{D}{{2}})?", 0)
    return parse_datetime_eod(matched)


def inline_date(text: Column) -> Column:
    """First full date as ``yyyy-MM-dd`` text (not validated), else empty."""
    parts = lambda p: F.concat_ws(
        "-", F.get(p, F.lit(0)), F.lpad(F.get(p, F.lit(1)), 2, "0"), F.lpad(F.get(p, F.lit(2)), 2, "0")
    )
    return text_or_empty(let(find_all(find(text, FULL_DATE, 0), f"{D}+"), parts))


def assemble_date(year: Column, detail: Column) -> Column:
    """Year from the listing, month and day from the first two numbers of the detail text."""
    numbers = find_all(text_or_empty(detail), f"{D}{{1,2}}")
    built = let(
        numbers,
        lambda n: F.when(
            F.size(n) >= 2,
            F.concat_ws("-", year, F.lpad(F.get(n, F.lit(0)), 2, "0"), F.lpad(F.get(n, F.lit(1)), 2, "0")),
        ),
    )
    return F.when(non_empty(year).isNotNull(), F.coalesce(built, detail)).otherwise(detail)


def publish_date_text(content: Column) -> Column:
    """Labelled publish date (rest of its line), else the first full, else the first short date."""
    labelled = rf"(?:发布时间|发布日期|日期)[:：]{WS}*([^\n]+)"
    return text_or_empty(
        strip(F.coalesce(find(content, labelled), find(content, FULL_DATE, 0), find(content, SHORT_DATE, 0)))
    )


def labelled_datetime(text: Column, labels: list[str]) -> Column:
    """First label whose line parses."""
    return F.coalesce(
        *[parse_datetime_eod(find(text, rf"{label}[：:]{WS}*([^\n]+)")) for label in labels]
    )


def date_marks(text: Column) -> Column:
    """All full dates, then all month-days, as written: what ``days_of`` reads by a clock."""
    # The short pattern runs over the same text, so 2025年12月3日 also yields 12-03
    # of the run year.
    return F.concat(
        find_all(text_or_empty(text), LOOSE_FULL_STAMP),
        find_all(text_or_empty(text), SHORT_STAMP),
    )


def days_of(marks: Column, clock: Clock) -> Column:
    parsed = F.transform(marks, lambda raw: parse_datetime_text(raw, clock).cast("date"))
    return F.filter(parsed, lambda day: day.isNotNull())


def detected_days(text: Column, clock: Clock) -> Column:
    """Days of all full dates, and of all month-days in the run year."""
    return days_of(date_marks(text), clock)


def all_marks_past(marks: Column, clock: Clock) -> Column:
    return let(days_of(marks, clock), lambda days: (F.size(days) > 0) & F.forall(days, lambda d: d < clock.today))


def all_dates_past(text: Column, clock: Clock) -> Column:
    """At least one date is detected and all lie before the run date."""
    return all_marks_past(date_marks(text), clock)


def has_current_or_future_date(text: Column, clock: Clock) -> Column:
    return F.exists(detected_days(text, clock), lambda d: d >= clock.today)


def older_than_cutoff(date_text: Column, clock: Clock) -> Column:
    return F.coalesce(parse_datetime_text(date_text, clock) < clock.cutoff_at, F.lit(False))


def next_week_window(day: Column, clock: Clock) -> Column:
    """Strictly inside the seven days that follow next Monday."""
    ahead = F.pmod(-F.weekday(clock.today), F.lit(7))
    since = F.datediff(clock.today, day)
    return (since > -(ahead + 7)) & (since < -ahead)


def parse_epoch(value: Column, zone: str = "UTC") -> Column:
    """Digits or one of three date shapes -> epoch seconds; not positive or unreadable -> NULL."""
    shapes = {
        "yyyy-M-d H:m:s": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\z",
        "yyyy-M-d H:m": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}\z",
        "yyyy-M-d": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z",
    }

    def read(text: Column) -> Column:
        digits = text.try_cast("bigint")
        out = F.when(text.rlike(r"^[0-9]+\z"), F.when(digits > 0, digits))
        for fmt, shape in shapes.items():
            moment = F.try_to_timestamp(text, F.lit(fmt))
            out = out.when(text.rlike(shape), F.unix_timestamp(F.to_utc_timestamp(moment, zone)))
        return out

    return let(strip(value), read)


def local_time(epoch: Column, zone: str = "UTC") -> Column:
    """Epoch seconds as naive wall time of ``zone``, whatever the session's zone is."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), epoch)
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def format_publish(epoch: Column, publish_text: Column, zone: str = "UTC") -> Column:
    """Epoch as ``yyyy-MM-dd HH:mm``, else the page's own text, else ``N/A``."""
    moment = local_time(F.nullif(epoch, F.lit(0)), zone)
    return F.coalesce(F.date_format(moment, "yyyy-MM-dd HH:mm"), non_empty(strip(publish_text)), F.lit("N/A"))


def line_kind(line: Column) -> Column:
    return let(
        F.lower(line),
        lambda low: F.when(has_any(low, rules.DEADLINE_WORDS), "deadline")
        .when(has_any(low, rules.PUBLISH_WORDS), "publish")
        .when(has_any(low, rules.EVENT_WORDS), "event")
        .otherwise("mentioned"),
    )


def _signal_time(raw: Column, kind: Column, clock: Clock) -> Column:
    """Deadlines and events without a written time end at 23:59."""
    return let(
        parse_datetime_text(raw, clock),
        lambda parsed: F.when(
            kind.isin("deadline", "event") & ~raw.rlike(CLOCK),
            F.try_to_timestamp(F.date_format(parsed, "yyyy-MM-dd 23:59"), F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz"),
        ).otherwise(parsed),
    )


def signals(text: Column, clock: Clock, fallback: Column | None = None) -> Column:
    """Every date of a text as array<struct<line_no, pos, kind, raw, parsed, context>>.

    Built inside the row: no shuffle, and lines without a date cost one regex test.
    ``fallback`` adds a publish signal after the others.
    """
    numbered = F.transform(lines(text), lambda line, i: F.struct((i + 1).alias("line_no"), line.alias("line")))
    dated = F.filter(numbered, lambda n: n["line"].rlike(ANY_DATE))

    def of_line(n: Column) -> Column:
        return let(
            F.struct(n["line_no"].alias("line_no"), strip(n["line"]).alias("line"), line_kind(n["line"]).alias("kind")),
            lambda k: F.transform(
                F.transform(find_all(k["line"], SIGNAL), lambda raw: strip(raw)),
                lambda raw, i: F.struct(
                    k["line_no"].alias("line_no"),
                    (i + 1).alias("pos"),
                    k["kind"].alias("kind"),
                    raw.alias("raw"),
                    _signal_time(raw, k["kind"], clock).alias("parsed"),
                    F.substring(k["line"], 1, rules.CONTEXT_CHARS).alias("context"),
                ),
            ),
        )

    found = F.flatten(F.transform(dated, of_line))
    if fallback is None:
        return found

    def extra(back: Column) -> Column:
        signal = F.struct(
            F.lit(2**31 - 1).alias("line_no"),
            F.lit(1).alias("pos"),
            F.lit("publish").alias("kind"),
            back.alias("raw"),
            parse_datetime_text(back, clock).alias("parsed"),
            F.lit("fallback_publish_date").alias("context"),
        )
        return F.filter(F.array(signal), lambda s: text_or_empty(s["raw"]) != "")

    return F.concat(found, let(fallback, extra))


def latest(signal_array: Column, kind: str) -> Column:
    """Latest parsed time of one kind."""
    return F.array_max(F.transform(F.filter(signal_array, lambda s: s["kind"] == kind), lambda s: s["parsed"]))

