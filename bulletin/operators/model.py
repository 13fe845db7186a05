"""Model answers as tables: requests -> responses -> apply.

Building requests and applying responses is plain DataFrame work. The call itself
is the user's function, run per Arrow batch; no provider is built in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.basics import clamp_score, collapse, non_empty, strip, text_or_empty
from bulletin.functions.text import clean_markdown, clip_units, json_block, normalize_headings, normalize_space, quality_score
from bulletin.operators.order import top_k
from bulletin.operators.ranking import item_index, section_limit
from bulletin.operators.rows import explode_once
from bulletin.operators.scoring import score_guardrails

CHUNK_ITEMS = 40
#: Sections whose final cut is a rule and never a reply.
OWN_RULE_SECTIONS = (rules.REPORT_SECTION, rules.OTHER_SECTION)


def ranking_requests(df: DataFrame, chunk_items: int = CHUNK_ITEMS, measure: DataFrame | None = None) -> DataFrame:
    """One prompt per section and chunk of items; the item index runs through the section."""
    body = F.substring(text_or_empty(F.col("content")), 1, rules.RANKING_BODY_CHARS)
    return _section_requests(df, F.concat(F.lit(". 标题: "), text_or_empty(F.col("title")), F.lit("\n正文摘录:\n"), body), chunk_items, measure)


def selection_requests(df: DataFrame, chunk_items: int = CHUNK_ITEMS, excerpt_chars: int = 500, measure: DataFrame | None = None) -> DataFrame:
    """Candidates of the sections that have more items than their limit; reports and accounts have rules of their own."""
    open_ = df.where(~F.col("section").isin(*OWN_RULE_SECTIONS))
    body = F.substring(normalize_space(F.col("content")), 1, excerpt_chars)
    candidate = F.concat(
        F.lit(". 标题: "), text_or_empty(F.col("title")), F.lit("\n发布日期: "), text_or_empty(F.col("date")), F.lit("\n正文摘录: "), body
    )
    return _section_requests(open_, candidate, chunk_items, measure, more_than=rules.SECTION_LIMIT)


def summary_requests(df: DataFrame, excerpt_chars: int = 2500) -> DataFrame:
    """One prompt per item: its title, source and the head of its text."""
    return df.select(
        "notice_id",
        F.concat(
            F.lit("标题: "), text_or_empty(F.col("title")), F.lit("\n来源: "), text_or_empty(F.col("section")),
            F.lit("\n正文:\n"), F.substring(text_or_empty(F.col("content")), 1, excerpt_chars),
        ).alias("prompt"),
    )


def clean_requests(df: DataFrame, source: str = "crawler", excerpt_chars: int = 3000) -> DataFrame:
    """One prompt per item that has any text after the rules have cleaned it."""
    cleaned = df.select("notice_id", clean_markdown(F.col("content")).alias("_text")).where(F.col("_text") != "")
    return cleaned.select("notice_id", F.concat(F.lit(f"Source: {source}\n\nMarkdown:\n"), F.substring("_text", 1, excerpt_chars)).alias("prompt"))


def report_requests(df: DataFrame, excerpt_chars: int = 3000) -> DataFrame:
    """One prompt per report page: title, date, address and the head of its text."""
    return df.select(
        "notice_id",
        F.concat(
            F.lit("页面标题："), text_or_empty(F.col("title")), F.lit("\n发布日期："), text_or_empty(F.col("publish_date")), F.lit("\n链接："),
            text_or_empty(F.col("url")), F.lit("\n原文如下：\n"), F.substring(text_or_empty(F.col("content")), 1, excerpt_chars),
        ).alias("prompt"),
    )


def _section_requests(df: DataFrame, candidate: Column, chunk_items: int, measure: DataFrame | None, more_than: int = 0) -> DataFrame:
    """Prompts of numbered candidates, ``chunk_items`` to a prompt, of sections with more than ``more_than`` items; an unlimited chunk is one prompt per section."""
    # Only the candidate's text travels through the numbering, not the whole body. The
    # numbering also counts the sections: a join by section would deal whole texts to one task each.
    indexed = item_index(df.select("section", "ordinal", candidate.alias("_body")), measure, total="_items").where(F.col("_items") > more_than)
    candidate = F.concat(F.col("item_index").cast("string"), F.col("_body"))
    chunked = indexed.select(
        "section", "item_index", F.floor((F.col("item_index") - 1) / chunk_items).cast("bigint").alias("chunk"),
        candidate.alias("candidate"),
    )
    return chunked.groupBy("section", "chunk").agg(
        F.expr("listagg(candidate, '\n\n') WITHIN GROUP (ORDER BY item_index)").alias("candidates"),
        F.count(F.lit(1)).alias("items"),
    ).select(
        "section", "chunk", "items",
        F.concat(F.lit("版块: "), F.col("section"), F.lit("\n\n"), F.col("candidates")).alias("prompt"),
    )


def whole_number(col: Column) -> Column:
    return F.when(col.rlike(r"^\s*[+-]?[0-9]+(?:\.0*)?\s*$"), col.try_cast("double").try_cast("int"))


def score_responses(responses: DataFrame) -> DataFrame:
    """Usable (section, item_index, score, reason) rows of the replies; bad entries are skipped."""
    schema = "struct<items: array<struct<index:string, score:string, reason:string>>>"
    entries = explode_once(responses, ["section"], F.from_json(json_block(F.col("raw")), schema)["items"], "pos", "e")
    parsed = entries.select(
        "section", "pos",
        whole_number(F.col("e.index")).alias("item_index"),
        F.col("e.score").try_cast("double").try_cast("int").alias("score"),
        F.substring(F.coalesce(non_empty(F.col("e.reason")), F.lit("llm_score")), 1, rules.MODEL_REASON_CHARS).alias("reason"),
    ).where(F.col("item_index").isNotNull() & F.col("score").isNotNull())
    last = top_k(parsed, ["section", "item_index"], [F.col("pos").desc()], 1)
    return last.withColumn("score", clamp_score(F.col("score"))).drop("pos")


def scored_items(items: DataFrame, responses: DataFrame, clock) -> DataFrame:
    """Rule scores overlaid with the replies; guardrails hold for both."""
    from bulletin.operators.joins import apply_scores

    return score_guardrails(apply_scores(items, score_responses(responses)), clock)


def decision_context(site: Column, title: Column, date: Column, snippet: Column, rule_lines: str) -> Column:
    return F.concat_ws(
        "\n",
        F.concat(F.lit("站点: "), text_or_empty(site)),
        F.concat(F.lit("标题: "), text_or_empty(title)),
        F.concat(F.lit("已知日期: "), non_empty(date)),
        F.concat(F.lit("正文与摘要: "), non_empty(snippet)),
        non_empty(F.lit(rule_lines)),
    )


def decision_requests(df: DataFrame, rule_lines: str = "") -> DataFrame:
    """Prompts for the rows no keyword rule decides; only those ever reach the model."""
    from bulletin.operators.filters import keyword_rule

    open_rows = df.where(keyword_rule(F.col("title"), F.col("snippet")).isNull())
    return open_rows.select(
        "notice_id",
        decision_context(F.col("section"), F.col("title"), F.col("date"), F.col("snippet"), rule_lines).alias("prompt"),
    )


def parse_decision(raw: Column) -> Column:
    head = F.upper(strip(raw))
    return F.when(F.startswith(head, F.lit("YES")), F.lit(True)).when(F.startswith(head, F.lit("NO")), F.lit(False))


def decision_responses(responses: DataFrame) -> DataFrame:
    answer = parse_decision(F.col("raw"))
    reason = (
        F.when(text_or_empty(F.col("raw")) == "", "llm_empty")
        .when(answer, "llm_yes")
        .when(~answer, "llm_no")
        .otherwise("llm_unparseable")
    )
    status = F.when(answer, "kept").when(~answer, "dropped").otherwise("undecided")
    return responses.withColumns({"model_keep": answer, "status": status, "reason": reason})


def selection_responses(items: DataFrame, responses: DataFrame, limit: int = rules.SECTION_LIMIT) -> DataFrame:
    """Items a reply keeps, in reply order; a section without a usable reply keeps its first ones.

    Sections of at most ``limit`` items pass whole, and those with rules of their own keep
    their first items, whatever the replies say. ``items`` carries ``item_index``; indices
    out of range find no item and fall away.
    """
    sizes = items.groupBy("section").agg(F.max("item_index").alias("_n"))
    exempt = F.col("section").isin(*OWN_RULE_SECTIONS)
    sized = items.join(sizes, "section")
    small = (F.col("_n") <= limit) & ~exempt
    first_few = exempt & (F.col("item_index") <= section_limit(F.col("section")))
    ruled = sized.where(small | first_few).withColumns(
        {"pick": F.col("item_index").cast("int"), "reason": F.when(small, "within_limit").otherwise("section_rule")}
    ).drop("_n")
    items = sized.where(~exempt & (F.col("_n") > limit)).drop("_n")
    schema = "struct<keep_indices: array<string>>"
    replies = F.from_json(json_block(F.col("raw")), schema)["keep_indices"]
    picks = explode_once(responses, ["section"], replies, "pos", "i").select("section", "pos", whole_number(F.col("i")).cast("bigint").alias("item_index"))
    picks = picks.where(F.col("item_index").isNotNull()).groupBy("section", "item_index").agg(F.min("pos").alias("pos"))
    picked = top_k(items.join(picks, ["section", "item_index"]), ["section"], [F.col("pos")], limit, rank="pick")
    answered = picked.select("section").distinct()
    first = items.where(F.col("item_index") <= limit).join(answered, "section", "left_anti")
    chosen = picked.drop("pos").withColumn("reason", F.lit("llm_section_selection")).unionByName(
        first.withColumns({"pick": F.col("item_index").cast("int"), "reason": F.lit("fallback_max_items_per_section")})
    )
    return chosen.unionByName(ruled)


def feed_summary_response(raw: Column, fallback: Column) -> Column:
    """Reply on one line, 100 characters; an empty reply takes the fallback."""
    return F.coalesce(non_empty(F.substring(collapse(raw), 1, rules.FEED_SUMMARY_CHARS)), fallback)


def digest_summary_response(raw: Column, fallback: Column) -> Column:
    return clip_units(normalize_space(F.coalesce(non_empty(raw), fallback)), rules.SUMMARY_UNITS)


def summary_responses(df: DataFrame) -> DataFrame:
    """Both summaries from ``raw`` with ``content`` as the source of the fallback."""
    from bulletin.functions.text import item_summary

    line = F.substring(collapse(F.col("content")), 1, rules.FEED_SUMMARY_CHARS)
    return df.withColumns(
        {
            "feed_summary": feed_summary_response(F.col("raw"), line),
            "digest_summary": digest_summary_response(F.col("raw"), item_summary(F.col("content"))),
        }
    )


def gated_clean(items: DataFrame, responses: DataFrame) -> DataFrame:
    """Take a cleaned candidate only where its quality is no worse; reports keep their text."""
    joined = items.join(responses.select("notice_id", "raw"), "notice_id", "left")
    staged = joined.withColumns(
        {"_own": clean_markdown(F.col("content")), "_candidate": clean_markdown(F.col("raw"))}
    )
    take = (
        (F.col("section") != rules.REPORT_SECTION)
        & non_empty(F.col("raw")).isNotNull()
        & (F.col("_own") != "")
        & (quality_score(F.col("_candidate")) >= quality_score(F.col("_own")))
    )
    staged = staged.withColumn("accepted", F.coalesce(take, F.lit(False)))
    text = F.when(F.col("accepted"), F.col("_candidate")).otherwise(F.col("_own"))
    return staged.withColumn(
        "content", clean_markdown(normalize_headings(text, F.col("title")))
    ).drop("_own", "_candidate", "raw")


def model_call(requests: DataFrame, call: Callable[[list[str]], list[str | None]], key: str, attempts: int = 2) -> DataFrame:
    """Run the user's batch function over ``prompt``; failed or empty replies are retried once, then NULL.

    ``error`` keeps what the last attempt of a failed batch raised, so a provider that is
    down does not look like one that said nothing.

    Write the result as a table before using it twice: a lost executor must not repeat calls.
    """
    key_type = dict(requests.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            replies: list[str | None] = [None] * len(batch)
            errors: list[str | None] = [None] * len(batch)
            pending = list(range(len(batch)))
            for _ in range(attempts):
                if not pending:
                    break
                try:
                    answers = call([batch["prompt"].iloc[i] for i in pending])
                except Exception as problem:  # a failing provider counts as "no reply"
                    for i in pending:
                        errors[i] = f"{type(problem).__name__}: {problem}"
                    continue
                for i, answer in zip(pending, answers):
                    replies[i], errors[i] = answer or None, None
                pending = [i for i in pending if replies[i] is None]
            texts = {name: pd.Series(values, dtype="object", index=batch.index) for name, values in (("raw", replies), ("error", errors))}
            yield pd.DataFrame({key: batch[key], **texts})

    return requests.select(key, "prompt").mapInPandas(run, f"{key} {key_type}, raw string, error string")
