"""Digest documents: Markdown with ``#`` sections and ``##`` items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.basics import clamp_score, find, let, non_empty, strip, unix_lines, text_or_empty, WS, DIGIT as D, FULLWIDTH_DIGITS

# A heading needs something after its marker.
# The marker is tested first and the line start second, which is far cheaper per character.
SECTION_START = r"(?=# [^\n]*\S)(?<![^\n])"
ITEM_START = r"(?=## [^\n]*\S)(?<![^\n])"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """documents(doc_path, text), one row per file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc_path"), F.col("value").alias("text")
    )


def first_line(block: Column, marker: Column) -> Column:
    """The first line after a marker of so many characters."""
    return strip(F.substring(F.substring_index(block, "\n", 1), marker + 1, F.length(block)))


def cut_at(text: Column, start: str, opening: str) -> Column:
    """A text cut before every match of ``start``; piece 0 is what precedes the first, empty where it opens the text."""
    return let(text, lambda t: F.when(t.rlike(opening), F.concat(F.array(F.lit("")), F.split(t, start))).otherwise(F.split(t, start)))


def rest_of(block: Column) -> Column:
    """All lines but the first."""
    at = F.instr(block, F.lit("\n"))
    return F.when(at > 0, F.substring(block, at + 1, F.length(block))).otherwise("")


def read_digest_items(documents: DataFrame, doc: str = "doc_path") -> DataFrame:
    """Items of every document: section, its order, the item's order, title and body.

    Sections and items are cut with lookahead splits inside the row, so a document is
    parsed where it was read: no window, no shuffle.
    """
    # The outer explode keeps Catalyst from evaluating the split twice (see operators.rows).
    cut = lambda text, start, marker: cut_at(text, start, rf"^{marker} [^\n]*\S")
    sections = documents.select(doc, F.posexplode_outer(cut(unix_lines(F.col("text")), SECTION_START, "#")).alias("section_ord", "block"))
    headed = F.col("section_ord") > 0
    named = sections.select(
        doc,
        "section_ord",
        F.when(headed, first_line(F.col("block"), F.lit(2))).otherwise(rules.UNFILED_SECTION).alias("section"),
        F.posexplode_outer(cut(F.col("block"), ITEM_START, "##")).alias("item_ord", "item"),
    )
    return named.where(F.col("item_ord") > 0).select(
        doc, "section", "section_ord", "item_ord",
        first_line(F.col("item"), F.lit(3)).alias("title"),
        strip(rest_of(F.col("item"))).alias("content"),
    )


def load_preferences(documents: DataFrame, doc: str = "doc_path") -> DataFrame:
    """Scored samples of a preference corpus.

    The human score wins over the machine score; a reason line wins over the remark in
    brackets; items without a score are skipped.
    """
    items = read_digest_items(documents, doc).withColumn("section", F.regexp_replace("section", f"{WS}+", ""))
    return scored(items, [doc, "section", "section_ord", "item_ord", "title"])


def scored(items: DataFrame, carry: list[str]) -> DataFrame:
    """Items with a score in their ``content``, as ``score`` and ``reason``."""
    content = F.col("content")
    human = rf"{rules.HUMAN_SCORE_LABEL}[：:]{WS}*({D}{{1,3}})(?:{WS}*/{WS}*100)?(?:[（(]([^）)]*)[）)])?"
    machine = rf"{rules.SCORE_LABEL}[：:]{WS}*({D}{{1,3}})"
    score = F.coalesce(find(content, human), find(content, machine))
    reason = F.coalesce(
        non_empty(strip(find(content, rf"(?:原因|理由|{rules.BASIS_LABEL})[：:]{WS}*([^\n]+)"))),
        strip(F.when(find(content, human).isNotNull(), F.regexp_extract(content, human, 2))),
    )
    return items.where(score.isNotNull()).select(
        *carry,
        clamp_score(F.translate(score, FULLWIDTH_DIGITS, "0123456789").cast("int")).alias("score"),
        text_or_empty(reason).alias("reason"),
    )


def issue_ts_from_path(path: Column, prefix: str) -> Column:
    """Issue time written in a report's file name, else NULL."""
    name = F.regexp_extract(path, r"[^/]*\z", 0)
    stamp = find(name, rf"^{prefix}_([0-9]{{8}}_[0-9]{{4}})(?:_raw)?\.md\z")
    return F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmm")).cast("timestamp_ntz")
