"""Issues as Markdown and HTML.

Anything that can grow with the data is rendered as rows, one block per item with its
place; ``sources.sinks.write_document`` writes such blocks in order. Only what is
bounded by the per-section limit is joined into one text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions import text as X
from bulletin.functions.basics import lines, non_empty, strip, text_or_empty
from bulletin.functions.dates import format_publish
from bulletin.functions.html import escape
from bulletin.operators.rows import explode_once
from bulletin.operators.sections import card_lead, placed_sections, section_lead

BLANK = "\n\n"


def render_ranked(ranks: DataFrame, bodies: DataFrame, sections: DataFrame, body: Column | None = None) -> DataFrame:
    """Blocks of the ranked issue: a heading per section (block 0), then its items by rank.

    ``ranks`` are the narrow rows of ``rank_in_section``; ``bodies`` brings title and content.
    """
    counts = ranks.groupBy("section").agg(F.count(F.lit(1)).alias("_n"))
    heading = F.concat(F.lit("# "), F.col("section"))
    empty = F.lit(f"{BLANK}## {rules.PLACEHOLDER_TITLE}{BLANK}{rules.RANKED_EMPTY_BODY}")
    placed = placed_sections(ranks, sections)
    heads = placed.join(counts, "section", "left").select(
        "section", "section_ord", F.lit(0).cast("bigint").alias("block"),
        F.when(F.col("_n").isNull(), F.concat(heading, empty)).otherwise(heading).alias("text"),
    )
    text = F.concat_ws(
        BLANK,
        F.concat(F.lit("## "), F.col("title")),
        F.concat(F.lit(f"{rules.SCORE_LABEL}: "), F.col("score").cast("string"), F.lit("/100")),
        F.concat(F.lit(f"{rules.BASIS_LABEL}: "), non_empty(strip(F.col("reason")))),
        non_empty(F.col("content") if body is None else body),
    )
    items = (
        ranks.join(placed, "section")
        .join(bodies.select("notice_id", "title", "content"), "notice_id")
        .select("section", "section_ord", F.col("rank").cast("bigint").alias("block"), text.alias("text"))
    )
    return heads.unionByName(items)


def selected_block() -> Column:
    return F.concat_ws(BLANK, F.concat(F.lit("## "), F.col("title")), non_empty(F.col("content")))


def render_digest(items: DataFrame, sections: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One text per section: heading, lead, then its few selected items.

    ``items`` holds at most the section limit per section (``rank`` is their order).
    Sections of the list come first and in its order, then any others that occur. With
    ``by`` (the issue), both tables have these columns and every value has its own digest.
    """
    block = F.concat_ws(
        BLANK,
        F.concat(F.lit("## "), F.col("title")),
        F.when(F.col("show_summary"), F.concat(F.lit(f"{rules.SUMMARY_LABEL}："), F.col("summary"))),
        non_empty(F.col("content")),
    )
    texts = items.select(*by, "section", "rank", block.alias("block")).groupBy(*by, "section").agg(
        F.expr(f"listagg(block, '{BLANK}') WITHIN GROUP (ORDER BY rank)").alias("_items"),
        F.count(F.lit(1)).alias("_n"),
    )
    placed = placed_sections(items, sections, by)
    joined = placed.join(texts, [*by, "section"], "left").withColumn("items", F.coalesce(F.col("_n"), F.lit(0)))
    return joined.select(
        *by, "section", "section_ord", "items",
        F.concat_ws(
            BLANK, F.concat(F.lit("# "), F.col("section")), section_lead(F.col("section"), F.col("items")), F.col("_items")
        ).alias("text"),
    )


def join_issue(section_texts: DataFrame) -> DataFrame:
    """The whole issue: section texts in order. Sections are a short fixed list."""
    return section_texts.groupBy().agg(
        F.concat(
            F.expr(f"listagg(text, '{BLANK}') WITHIN GROUP (ORDER BY section_ord)"), F.lit("\n")
        ).alias("text"),
        F.sum("items").alias("items"),
    )


def article_block(include_content: bool = True, zone: str = "UTC") -> Column:
    """Labelled lines of one account article."""
    line = lambda label, c: F.concat(F.lit(label), non_empty(c))
    body = non_empty(F.regexp_replace(text_or_empty(F.col("content")), r"\n\z", ""))
    parts = [
        F.concat(F.lit("## "), F.coalesce(non_empty(F.col("title")), F.lit("N/A"))),
        line("来源公众号: ", F.col("account")),
        F.concat(F.lit("日期: "), format_publish(F.col("publish_ts"), F.col("publish_text"), zone)),
        F.concat(F.lit("链接: "), F.coalesce(non_empty(F.col("url")), F.lit("N/A"))),
        line("发布时间: ", F.col("publish_text")),
        line("作者: ", F.col("author")),
        F.coalesce(line("摘要: ", strip(F.col("summary"))), line("摘要: ", F.col("digest"))),
    ]
    if include_content:
        parts.append(F.concat(F.lit(f"内容:{BLANK}"), body))
    return F.concat_ws(BLANK, *parts)


def render_articles(articles: DataFrame, include_content: bool = True, zone: str = "UTC") -> DataFrame:
    """Blocks of the account sections; order them by (section_ord, ordinal)."""
    return articles.withColumn("text", article_block(include_content, zone))


def event_blocks(events: DataFrame, dates: DataFrame) -> DataFrame:
    """Blocks of merged hall events, in the order (ordinal, part, place): head, dates, and the rest.

    An event with one date has it in its label; the dates of all others are blocks of their own.
    """
    label = F.when(F.col("n_dates") > 1, F.concat(F.lit("## "), F.col("title"), F.lit(f"{BLANK}日期:")))
    zero = F.lit(0).cast("bigint")
    heads = events.where(F.col("n_dates") > 1).select("title", "ordinal", F.lit(0).alias("part"), zero.alias("place"), label.alias("text"))
    dated = dates.join(events.select("title", "ordinal", "n_dates"), "title")
    single = F.concat(F.lit("## "), F.col("title"), F.lit(f"{BLANK}日期: "), F.col("date"))
    listed = dated.select(
        "title", "ordinal", F.lit(1).alias("part"), F.col("place").cast("bigint").alias("place"),
        F.when(F.col("n_dates") == 1, single).otherwise(F.col("date")).alias("text"),
    )
    tails = events.select("title", "ordinal", F.lit(2).alias("part"), zero.alias("place"), _event_rest().alias("text"))
    return heads.unionByName(listed).unionByName(tails)


def _event_rest() -> Column:
    return F.concat_ws(
        BLANK,
        F.concat(F.lit("地点: "), F.col("location")),
        F.concat(F.lit("票价:\n"), F.replace("price", F.lit("\n"), F.lit(BLANK))),
        F.concat(F.lit("![]("), non_empty(F.col("absolute_src")), F.lit(")")),
    )


def item_block() -> Column:
    """One plain item with its body cleaned and its headings lowered."""
    cleaned = X.clean_markdown(X.normalize_headings(X.clean_markdown(F.col("content")), F.col("title")))
    return F.concat(F.lit("## "), F.col("title"), F.lit(BLANK), cleaned)


def _readable(line: Column) -> Column:
    cjk_first = lambda t: F.struct(
        F.regexp_count(t, F.lit(r"[\x{4e00}-\x{9fff}]")).alias("cjk"), (-F.regexp_count(t, F.lit(r"[\x{c0}-\x{ff}]"))).alias("noise")
    )
    other = X.latin1_reading(line)
    return F.when(other.isNotNull() & (cjk_first(other) > cjk_first(line)), other).otherwise(line)


def classify_lines(documents: DataFrame, doc: str = "doc_id", brand_lines: tuple[str, ...] = (), inline: bool = False) -> DataFrame:
    """Every line of every document with its kind, label and value; the first rule that fits wins."""
    raw = explode_once(documents, [doc], lines(F.col("text")), "_n", "_line")
    # In two steps, so that the repair is evaluated once per line.
    bare = raw.select(doc, (F.col("_n") + 1).alias("line_no"), strip(F.replace("_line", F.lit("﻿"), F.lit(""))).alias("line"))
    line = F.col("line")
    if not inline:
        bare = bare.withColumn("line", strip(_readable(line)))
    label, value = X.split_label(line)
    staged = bare.withColumns({"_label": label, "_value": value})
    image = r"^!\[([^\]]*)\]\(([^)]+)\)"
    bold = line.rlike(r"^\*\*[^\n]+\*\*\z") & (F.length(line) > 4)
    starred = line.rlike(r"^\*[^\n]*\*\z") & (F.length(line) > 2)
    skip = (line == "") | line.isin(*brand_lines) if brand_lines else (line == "")
    if not inline:
        skip = skip | F.startswith(line, F.lit("[English](")) | (F.startswith(line, F.lit("* [")) & F.contains(line, F.lit("](")))
    kind = (
        F.when(skip, "skip")
        .when(line.rlike(image), "image")
        .when(F.startswith(line, F.lit("# ")), "section")
        .when(F.startswith(line, F.lit("## ")), "item")
        .when(F.startswith(line, F.lit("### ")), "subhead")
        .when(F.col("_label") == rules.SUMMARY_LABEL, "lede")
        .when(F.col("_label").isin(rules.META_LABELS), "meta")
    )
    bullets = ("- ",) if inline else ("- ", "• ")
    if not inline:
        kind = kind.when(line.rlike("^https?://"), "link")
    for mark in bullets:
        kind = kind.when(F.startswith(line, F.lit(mark)), "bullet")
    kind = kind.when(starred if inline else (bold | starred | F.startswith(line, F.lit("*"))), "note").otherwise("para")
    staged = staged.withColumn("kind", kind)
    k = F.col("kind")
    after = lambda n: strip(F.substring(line, n + 1, 2**31 - 1))
    emphasised = (
        F.when(bold, strip(F.regexp_extract(line, r"^\*\*([^\n]+)\*\*\z", 1)))
        .when(starred, strip(F.regexp_extract(line, r"^\*([^\n]*)\*\z", 1)))
        .otherwise(strip(F.ltrim(line, F.lit("*"))))
    )
    shown = (
        F.when(k == "section", after(2)).when(k == "item", after(3)).when(k == "subhead", after(4))
        .when(k.isin("lede", "meta"), F.col("_value")).when(k == "bullet", after(2))
        .when(k == "note", emphasised).when(k == "image", strip(F.regexp_extract(line, image, 2)))
        .when(k == "skip", "").otherwise(line)
    )
    named = F.when(k.isin("lede", "meta"), F.col("_label")).when(k == "image", strip(F.regexp_extract(line, image, 1))).otherwise("")
    strong = (k == "note") & (bold | starred)
    return staged.select(doc, "line_no", "kind", named.alias("label"), shown.alias("value"), strong.alias("strong"))


def card_fragment() -> Column:
    """HTML of one classified line, without the tags that open and close around it."""
    k, label, value = F.col("kind"), F.col("label"), F.col("value")
    p = lambda css, inner: F.concat(F.lit(f"<p class='{css}'>"), inner, F.lit("</p>"))
    anchor = F.concat(F.lit("<a href='"), escape(value), F.lit("'>"), escape(value), F.lit("</a>"))
    meta_value = (
        F.when((label == "链接") & value.rlike("^https?://"), anchor)
        .when(label.isin(rules.TIME_LIKE_LABELS), X.highlight_times(value))
        .otherwise(escape(value))
    )
    meta_class = F.when(label.isin(rules.HIGHLIGHT_LABELS), "meta-value is-highlight").otherwise("meta-value")
    return (
        F.when(
            k == "section",
            F.concat(
                F.lit("<section class='section'>\n<div class='section-head'>\n<span class='section-kicker'>本期栏目</span>\n<h2>"),
                escape(value), F.lit("</h2>\n<p class='section-lead'>"), escape(card_lead(value)), F.lit("</p>\n</div>"),
            ),
        )
        .when(
            k == "item",
            F.concat(F.lit("<article class='card'>\n<div class='card-notch'></div>\n<h3>"), escape(value), F.lit("</h3>")),
        )
        .when(k == "subhead", F.concat(F.lit("<h4 class='subhead'>"), escape(value), F.lit("</h4>")))
        .when(
            k == "image",
            F.concat(
                F.lit("<figure class='figure'><img src='"), escape(value), F.lit("' alt='"),
                escape(F.coalesce(non_empty(label), F.lit("配图"))), F.lit("' loading='lazy' /></figure>"),
            ),
        )
        .when(
            k == "lede",
            F.concat(
                F.lit(f"<div class='lede-box'><div class='lede-tag'>{rules.SUMMARY_LABEL}</div><p>"),
                X.highlight_times(value), F.lit("</p></div>"),
            ),
        )
        .when(
            k == "meta",
            F.concat(
                F.lit("<p class='meta-row'><span class='meta-label'>"), escape(label), F.lit("</span><span class='"),
                meta_class, F.lit("'>"), meta_value, F.lit("</span></p>"),
            ),
        )
        .when(k == "link", p("link-row", anchor))
        .when(k == "bullet", p("bullet", escape(value)))
        .when(k == "note", p("note", F.when(F.col("strong"), F.concat(F.lit("<strong>"), escape(value), F.lit("</strong>"))).otherwise(escape(value))))
        .otherwise(F.concat(F.lit("<p>"), escape(value), F.lit("</p>")))
    )


def render_cards(documents: DataFrame, doc: str = "doc_id", brand_lines: tuple[str, ...] = ()) -> DataFrame:
    """HTML fragment per issue document: sections and cards opened and closed around their lines.

    A document is one input value, so its lines fit one window partition.
    """
    rows = classify_lines(documents, doc, brand_lines).where(F.col("kind") != "skip")
    w = Window.partitionBy(doc).orderBy("line_no")
    back = w.rowsBetween(Window.unboundedPreceding, -1)
    heading = F.when(F.col("kind").isin("section", "item"), F.col("kind"))
    opened = F.last(heading, ignorenulls=True).over(back)
    in_section = F.max(F.col("kind") == "section").over(back)
    staged = rows.withColumns(
        {"_card_open": F.coalesce(opened == "item", F.lit(False)), "_section_open": F.coalesce(in_section, F.lit(False))}
    )
    k = F.col("kind")
    close_card = F.when(k.isin("section", "item") & F.col("_card_open"), "</article>")
    # A card outside any section closes with the next card, or not at all before a section.
    close_card = F.when((k == "section") & ~F.col("_section_open"), F.lit(None)).otherwise(close_card)
    close_section = F.when((k == "section") & F.col("_section_open"), "</section>")
    staged = staged.withColumn("_html", F.concat_ws("\n", close_card, close_section, card_fragment()))
    joined = staged.groupBy(doc).agg(
        F.expr("listagg(_html, '\n') WITHIN GROUP (ORDER BY line_no)").alias("_body"),
        F.max_by(heading, F.when(heading.isNotNull(), F.col("line_no"))).alias("_last"),
        F.max(k == "section").alias("_any_section"),
    )
    tail = F.when(
        F.col("_any_section"),
        F.concat_ws("\n", F.when(F.col("_last") == "item", "</article>"), F.lit("</section>")),
    )
    return joined.select(doc, F.concat_ws("\n", F.col("_body"), tail).alias("html"))
