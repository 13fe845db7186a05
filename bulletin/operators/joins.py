"""Joins between notices and the tables around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.basics import WS, fill_in_order, find_all, non_empty, strip
from bulletin.functions.text import squeeze_blank_lines, title_key
from bulletin.operators.order import top_k
from bulletin.operators.rows import explode_once

IMAGE_TOKEN = r"\[\[IMG_OCR_([0-9]+)\]\]"


def accounts_articles(accounts: DataFrame, articles: DataFrame) -> DataFrame:
    """Articles of the resolved accounts; order is account order, then feed order."""
    return articles.join(accounts.select("fakeid", "keyword", "account_ord"), "fakeid")


def previous_issue_anti(notices: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Drop notices whose title was in an earlier issue. Without a table of earlier titles nothing changes."""
    if previous is None:
        return notices
    seen = previous.select(title_key(F.col("title")).alias("title_key")).distinct()
    return notices.withColumn("title_key", title_key(F.col("title"))).join(seen, "title_key", "left_anti")


def apply_scores(items: DataFrame, scores: DataFrame) -> DataFrame:
    """Model scores over rule scores, by section and item index; the last response for an item wins."""
    scored = scores.select(
        "section", "item_index", F.col("score").alias("_score"), F.col("reason").alias("_reason"),
    )
    joined = items.join(scored, ["section", "item_index"], "left")
    return joined.withColumns(
        {
            "score": F.coalesce(F.col("_score"), F.col("score")),
            "reason": F.when(F.col("_score").isNotNull(), F.col("_reason")).otherwise(F.col("reason")),
        }
    ).drop("_score", "_reason")


def section_key(section):
    """Section name without white space; the library goes by its short name too."""
    bare = F.regexp_replace(section, f"{WS}+", "")
    return F.when(bare == "图书馆", rules.LIBRARY_SECTION).otherwise(bare)


def section_preferences(notices: DataFrame, digest: DataFrame) -> DataFrame:
    """Attach the sample text of a notice's section."""
    samples = digest.select(section_key(F.col("section")).alias("_key"), "examples")
    return (
        notices.withColumn("_key", section_key(F.col("section"))).join(samples, "_key", "left").drop("_key")
    )


def example_digest(preferences: DataFrame) -> DataFrame:
    """Per section, ``- title => n/100；reason`` lines in order, cut to 3200 characters.

    A line has at least ``- `` + `` => 0/100`` + a line break, so rows beyond the
    bound below cannot reach into the first 3200 characters: the cut is exact and no
    section is gathered whole.
    """
    shortest_line = len("-  => 0/100") + 1
    enough = rules.EXAMPLE_CHARS // shortest_line + 1
    head = top_k(preferences, ["section"], [F.col("ordinal")], enough)
    line = F.concat(
        F.lit("- "), F.col("title"), F.lit(" => "), F.col("score").cast("string"), F.lit("/100"),
        F.coalesce(F.concat(F.lit("；"), non_empty(F.col("reason"))), F.lit("")),
    )
    joined = head.select("section", "ordinal", line.alias("line")).groupBy("section").agg(
        F.expr("listagg(line, '\n') WITHIN GROUP (ORDER BY ordinal)").alias("lines")
    )
    return joined.select(
        "section",
        F.substring(F.concat(F.lit(rules.EXAMPLES_HEAD + "\n"), F.col("lines")), 1, rules.EXAMPLE_CHARS).alias("examples"),
    )


def image_annotations(notices: DataFrame, images: DataFrame) -> DataFrame:
    """Replace image tokens: tables and QR codes stay images, other images become their text or go.

    The annotations of a notice travel as one small array, so the text itself is joined
    once and never exploded. Where an image has several, the last by ``ordinal`` counts (the
    greatest, without that column).
    """
    place = F.col("ordinal") if "ordinal" in images.columns else F.lit(0)
    note = F.struct(F.col("idx").cast("int").alias("idx"), place.alias("at"), "url", "ocr_text", "type")
    notes = images.where(F.col("idx").isNotNull()).groupBy("notice_id").agg(F.array_sort(F.collect_list(note)).alias("_notes"))
    joined = notices.join(notes, "notice_id", "left")

    def render(token):
        note = F.try_element_at(F.filter("_notes", lambda n: n["idx"] == token.try_cast("int")), F.lit(-1))
        text = non_empty(strip(note["ocr_text"]))
        return (
            F.when(
                note["type"].isin("TABLE", "QRCODE") & non_empty(note["url"]).isNotNull(),
                F.concat(F.lit("![图片"), token, F.lit("]("), note["url"], F.lit(")")),
            )
            .when(text.isNotNull(), F.concat(F.lit("[图片文字 "), token, F.lit("] "), text))
            .otherwise("")
        )

    filled = fill_in_order(F.col("content"), IMAGE_TOKEN, F.transform(find_all(F.col("content"), IMAGE_TOKEN, 1), render))
    return joined.withColumn("content", strip(squeeze_blank_lines(filled))).drop("_notes")


def markdown_image_texts(notices: DataFrame, texts: DataFrame, keep_image: bool = False) -> DataFrame:
    """Replace ``![..](target)`` by the text recognised for that target; unknown images stay.

    Texts are joined per distinct target, then handed back per notice in image order.
    """
    image = r"!\[[^\]]*\]\(([^)]+)\)"
    found = explode_once(notices, ["notice_id"], find_all(F.col("content"), image, 0), "pos", "whole")
    inner = strip(F.regexp_extract("whole", image, 1))
    bare = F.when(inner.rlike(r"^<.*>\z"), strip(F.substring(inner, F.lit(2), F.length(inner) - 2))).otherwise(inner)
    found = found.withColumn("path", strip(F.split_part(bare, F.lit('"'), F.lit(1))))
    joined = found.join(texts.select("path", "text"), "path", "left")
    block = F.concat(F.lit("\n\n[图片文字]\n"), non_empty(F.col("text")))
    swap = F.concat(F.col("whole"), block, F.lit("\n")) if keep_image else F.concat(block, F.lit("\n\n"))
    swaps = joined.groupBy("notice_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", F.coalesce(swap, F.col("whole")).alias("swap")))),
            lambda s: s["swap"],
        ).alias("_swaps")
    )
    filled = fill_in_order(F.col("content"), image, F.col("_swaps"))
    return notices.join(swaps, "notice_id", "left").withColumn(
        "content", F.coalesce(filled, F.col("content"))
    ).drop("_swaps")
