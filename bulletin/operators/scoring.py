"""Rule scores and the ordered guardrails over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.basics import clamp_score, fold, has_any, has_words, let, strip, text_or_empty
from bulletin.functions.dates import Clock, all_dates_past, date_marks


def with_folded(df: DataFrame) -> DataFrame:
    """Add the case-folded title, text and head that every rule reads, computed once per row."""
    title, content = text_or_empty(F.col("title")), text_or_empty(F.col("content"))
    return df.withColumns(
        {
            "_title": fold(title),
            "_text": fold(F.concat(title, F.lit("\n"), content)),
            "_head": fold(F.concat(title, F.lit("\n"), F.substring(content, 1, rules.HEAD_CHARS))),
        }
    )


def _without_folded(df: DataFrame) -> DataFrame:
    return df.drop("_title", "_text", "_head")


def points(folded_text: Column) -> Column:
    """Sum of the points of every rule that hits, once each."""
    total = F.lit(rules.BASE_SCORE)
    for gain, words in rules.SCORE_RULES:
        total = total + F.when(has_words(folded_text, words), gain).otherwise(0)
    return let(total, clamp_score)


def rule_score(title: Column, content: Column) -> Column:
    return let(fold(F.concat(text_or_empty(title), F.lit("\n"), text_or_empty(content))), points)


def _expired_bound(folded_title: Column, folded_text: Column) -> Column:
    return (
        F.when(has_words(folded_title, rules.LIB_WRITING), 20)
        .when(has_words(folded_title, rules.LIB_TOOL), 15)
        .when(has_words(folded_text, rules.LIB_WEAK), 10)
        .otherwise(rules.EXPIRED_CAP_DEFAULT)
    )


def expired_cap(df: DataFrame) -> DataFrame:
    """How far an expired library item may still score, by topic."""
    return _without_folded(with_folded(df).withColumn("cap", _expired_bound(F.col("_title"), F.col("_text"))))


def guardrail_rules(clock: Clock | None) -> list[tuple[str, Column, str, Column]]:
    """(tag, condition, "cap" or "floor", bound) in the order they apply, over folded columns.

    The last depends on the run date; without a clock, it holds for every library item.
    """
    section, title, text, head = (F.col(c) for c in ("section", "_title", "_text", "_head"))
    publicity = has_words(text, rules.PUBLICITY)
    library = section.eqNullSafe(F.lit(rules.LIBRARY_SECTION))
    report = section.eqNullSafe(F.lit(rules.REPORT_SECTION)) | has_words(title, rules.REPORT_TITLE)
    outsiders = has_words(text, rules.NON_UNDERGRAD) & ~has_words(text, rules.UNDERGRAD)
    training = (
        has_words(text, rules.TRAINING)
        & has_words(head, rules.TRAINING_STAGE)
        & ~publicity
        & ~has_words(title, rules.SHOWCASE)
    )
    # Folding moves no digit or date mark, so dates can be read from the folded text.
    past = library if clock is None else library & all_dates_past(text, clock)
    return [
        ("cap_general_culture_lecture", has_words(text, rules.CULTURE), "cap", F.lit(20)),
        ("cap_general_activity", has_words(text, rules.ACTIVITY), "cap", F.lit(35)),
        ("cap_publicity", publicity, "cap", F.lit(25)),
        ("cap_non_undergrad", outsiders, "cap", F.lit(10)),
        ("floor_physics_report", report, "floor", F.lit(80)),
        ("floor_actionable_training", training, "floor", F.lit(55)),
        ("floor_life_impact", has_words(head, rules.LIFE), "floor", F.lit(45)),
        ("floor_lib_service_impact", library & has_words(text, rules.LIB_SERVICE), "floor", F.lit(90)),
        ("cap_lib_weak_topic", library & has_words(text, rules.LIB_WEAK), "cap", F.lit(15)),
        ("cap_lib_research_tool", library & has_words(title, rules.LIB_TOOL), "cap", F.lit(20)),
        ("cap_lib_research_tool", library & has_words(title, rules.LIB_WRITING), "cap", F.lit(30)),
        ("cap_expired_activity", past, "cap", _expired_bound(title, text)),
    ]


def score_guardrails(df: DataFrame, clock: Clock) -> DataFrame:
    """Apply caps and floors in order to ``score`` and note them in ``reason`` and ``tags``.

    Floors come after the general caps and therefore beat them; the library caps come last.
    """
    return _without_folded(_guarded(with_folded(df), clock))


def _conditions(df: DataFrame, steps: list[tuple[str, Column, str, Column]]) -> DataFrame:
    # Conditions first, as plain boolean columns; least/greatest skip the NULL of a rule that is off.
    return df.withColumn("_g", F.struct(*[cond.alias(f"c{i}") for i, (_, cond, _, _) in enumerate(steps)]))


def _moved(score: Column, steps: list[tuple[str, Column, str, Column]]) -> Column:
    for i, (_, _, kind, bound) in enumerate(steps):
        move = F.least if kind == "cap" else F.greatest
        score = move(score, F.when(F.col(f"_g.c{i}"), bound))
    return clamp_score(score)


def _hits(steps: list[tuple[str, Column, str, Column]]) -> list[Column]:
    return [F.when(F.col(f"_g.c{i}"), F.lit(tag)) for i, (tag, _, _, _) in enumerate(steps)]


def _reason(reason: Column, tags: Column) -> Column:
    """The reason with the tags of the guardrails that hit, joined by commas."""
    base = strip(text_or_empty(reason))
    with_tags = F.substring(F.concat_ws("；", F.nullif(base, F.lit("")), F.concat(F.lit("score_guardrail="), tags)), 1, rules.REASON_CHARS)
    return F.when(tags == "", base).otherwise(with_tags)


def _guarded(df: DataFrame, clock: Clock) -> DataFrame:
    steps = guardrail_rules(clock)
    tags = _hits(steps)
    return _conditions(df, steps).withColumns(
        {
            "score": _moved(F.col("score"), steps),
            "reason": _reason(F.col("reason"), F.concat_ws(",", *tags)),
            "tags": F.array_compact(F.array(*tags)),
        }
    ).drop("_g")


def with_score_bounds(df: DataFrame, clock: Clock) -> DataFrame:
    """Rule points as ``score``, and what the guardrails will make of any score: ``low``, ``high``, ``tags``.

    Caps and floors one after another are one clamp, whose ends are what becomes of 0 and of
    100. So a score that arrives later, such as a model's, needs the bounds and not the text.
    """
    steps = guardrail_rules(clock)
    staged = _conditions(with_folded(df), steps).withColumns(
        {
            "score": points(F.col("_text")), "reason": F.lit(rules.BASE_SCORE_REASON),
            "low": _moved(F.lit(0), steps), "high": _moved(F.lit(100), steps), "tags": F.array_compact(F.array(*_hits(steps))),
        }
    )
    return _without_folded(staged.drop("_g"))


def with_dated_scores(df: DataFrame) -> DataFrame:
    """Guarded rule scores for any run date: ``over`` where all dates of ``dates`` are past, ``open`` elsewhere.

    ``dates`` are the date marks of library items, the only ones that a past date caps.
    """
    steps = guardrail_rules(None)
    staged = _conditions(with_folded(df), steps).withColumn("score", points(F.col("_text")))
    library = F.col("section").eqNullSafe(F.lit(rules.LIBRARY_SECTION))
    scores = {"open": _moved(F.col("score"), steps[:-1]), "over": _moved(F.col("score"), steps), "dates": F.when(library, date_marks(F.col("_text")))}
    return _without_folded(staged.withColumns(scores).drop("_g", "score"))


def bounded(df: DataFrame) -> DataFrame:
    """Apply the bounds of ``with_score_bounds`` to ``score`` and note the tags in ``reason``."""
    return df.withColumns(
        {
            "score": F.least(F.greatest(clamp_score(F.col("score")), F.col("low")), F.col("high")),
            "reason": _reason(F.col("reason"), F.array_join("tags", ",")),
        }
    ).drop("low", "high")


def with_rule_score(df: DataFrame, clock: Clock) -> DataFrame:
    """Rule score, its reason and the guardrails."""
    scored = with_folded(df).withColumns(
        {"score": points(F.col("_text")), "reason": F.lit(rules.BASE_SCORE_REASON)}
    )
    return _without_folded(_guarded(scored, clock))


def account_section(account: Column, title: Column, digest: Column, content: Column) -> Column:
    """Section of an account article; the first rule that fits wins."""
    account, title = strip(text_or_empty(account)), strip(text_or_empty(title))
    union, science, club, welfare, other = (F.lit(s) for s in rules.ACCOUNT_SECTIONS)
    return let(
        F.lower(F.concat_ws("\n", account, title, strip(text_or_empty(digest)), strip(text_or_empty(content)))),
        lambda text: F.when(has_any(account, rules.UNION_WORDS) | has_any(title, rules.UNION_WORDS), union)
        .when(has_any(account, rules.SCIENCE_ACCOUNTS) | has_any(text, rules.SCIENCE_WORDS), science)
        .when(has_any(text, rules.WELFARE_WORDS), welfare)
        .when(has_any(text, rules.CLUB_WORDS), club)
        .otherwise(other),
    )
