"""Keep or drop by words, labels and URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.basics import has_any, has_any_ci, non_empty, strip, text_or_empty
from bulletin.operators.decisions import decide, drop_when


def keyword_rule(
    title: Column, snippet: Column,
    yes: Sequence[str] = tuple(rules.FORCE_YES_WORDS), no: Sequence[str] = tuple(rules.FORCE_NO_WORDS),
) -> Column:
    """False when a NO word occurs, else True for a YES word, else NULL. Case-sensitive."""
    text = F.concat_ws(" ", text_or_empty(title), text_or_empty(snippet))
    return F.when(has_any(text, no), F.lit(False)).when(has_any(text, yes), F.lit(True))


def copy_decision(df: DataFrame, model_on: bool = True, default_keep: bool = True, stage: str = "decider") -> DataFrame:
    """Rule, then the model's answer (``model_keep``), then the default.

    With the model off nothing is decided by rule either: every row takes the default.
    """
    default = F.lit(default_keep)
    if not model_on:
        return decide(df, default, F.lit("llm_disabled"), stage)
    rule = keyword_rule(F.col("title"), F.col("snippet"))
    answer = F.col("model_keep")
    reason = (
        F.when(rule.isNotNull(), "keyword_rule")
        .when(answer, "llm_yes")
        .when(~answer, "llm_no")
        .otherwise("undecided_default")
    )
    return decide(df, F.coalesce(rule, answer, default), reason, stage)


def mark_items(df: DataFrame, filter_on: bool = False, fallback_keep: bool = True) -> DataFrame:
    """Feed cascade; ``reason`` is the decision source."""
    if not filter_on:
        return decide(df, F.lit(True), F.lit("after_temporal_filter"), "mark_items")
    rule = keyword_rule(F.col("title"), F.col("snippet"))
    answer = F.col("model_keep")
    source = (
        F.when(rule.isNotNull(), "keyword_rule")
        .when(answer.isNotNull(), "llm")
        .otherwise("fallback_keep" if fallback_keep else "fallback_drop")
    )
    return decide(df, F.coalesce(rule, answer, F.lit(fallback_keep)), source, "mark_items")


def title_blacklist(
    df: DataFrame, words: Sequence[str] = tuple(rules.TITLE_BLACKLIST), exact: bool = False, raw_mode: bool = False
) -> DataFrame:
    title = text_or_empty(F.col("title"))
    listed = title.isin(list(words)) if exact else has_any(title, words)
    return drop_when(df, F.lit(False) if raw_mode or not words else listed, "site_blacklist", "crawler_detail")


def keyword_list(configured: Sequence[str] | None, defaults: Sequence[str]) -> list[str]:
    """Configured words, then the defaults that are not among them."""
    own = [w.strip() for w in configured or [] if w and w.strip()]
    return own + [w for w in defaults if w not in own] if own else list(defaults)


def looks_like_report(title: Column, words: Sequence[str] | None = None) -> Column:
    words = keyword_list(rules.REPORT_WORDS if words is None else words, rules.REPORT_WORDS_DEFAULT)
    return ~has_any_ci(text_or_empty(title), rules.REPORT_EXCLUDE_WORDS) & has_any_ci(text_or_empty(title), words)


def looks_like_non_report(title: Column, body: Column) -> Column:
    """The second look covers the title and the head of the body."""
    text = F.concat_ws("\n", non_empty(title), non_empty(F.substring(body, 1, rules.HEAD_CHARS)))
    return has_any_ci(text, rules.REPORT_EXCLUDE_WORDS + rules.NON_REPORT_PAGE_WORDS)


def report_classifier(df: DataFrame) -> DataFrame:
    report = looks_like_report(F.col("title"))
    other = looks_like_non_report(F.col("title"), F.col("content"))
    reason = F.when(~report, "not_report_like").when(other, "non_report_page").otherwise("list_item")
    return decide(df, report & ~other, reason, "crawler_reports")


def report_keep(df: DataFrame, places: Sequence[str] = tuple(rules.REPORT_PLACES)) -> DataFrame:
    """A negative decision is overruled by a known place or a report-like opening."""
    content = text_or_empty(F.col("content"))
    keep = F.col("decision") | has_any_ci(content, places) | looks_like_report(F.substring(content, 1, 200))
    return drop_when(df, ~keep, "copy_decision_false", "crawler_reports_detail")


def any_keyword(df: DataFrame, words: Sequence[str] = tuple(rules.TEACHING_WORDS)) -> DataFrame:
    return drop_when(df, ~has_any_ci(strip(text_or_empty(F.col("title"))), words), "title_filter", "crawler_detail")


def label_equals(df: DataFrame, label: str = rules.OPENING_LABEL) -> DataFrame:
    return drop_when(df, ~F.col("label").eqNullSafe(F.lit(label)), "other_label", "crawler_notice")


def url_guard(df: DataFrame, host: str) -> DataFrame:
    """Missing address or another site. The host is looked for anywhere in the address."""
    url = text_or_empty(strip(F.col("url")))
    reason = F.when(url == "", "missing_url").when(~F.contains(url, F.lit(host)), "foreign_host").otherwise("list_item")
    return decide(df, reason == "list_item", reason, "crawler_list")


def drop_placeholder(df: DataFrame) -> DataFrame:
    title = strip(text_or_empty(F.col("title")))
    body = strip(text_or_empty(F.col("content")))
    reason = (
        F.when(title == "", "empty_title")
        .when(title == rules.PLACEHOLDER_TITLE, "placeholder")
        .when(body == "", "empty_body")
        .otherwise("selectable")
    )
    return decide(df, reason == "selectable", reason, "selection")
