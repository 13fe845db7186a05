"""Stored pages: bytes to text, links, events, tables, images, plain text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulletin import rules
from bulletin.functions import html as H
from bulletin.functions.basics import (
    DIGIT as D,
    collapse,
    fill_in_order,
    find,
    find_all,
    let,
    non_empty,
    strip,
    text_or_empty,
)
from bulletin.functions.dates import FULL_DATE
from bulletin.functions.text import best_candidate, squeeze_blank_lines
from bulletin.functions.urls import normalize_url, resolve_resource, resolve_url
from bulletin.operators.rows import explode_once

TABLE = r"(?i)<table[\s\S]*?</table>"
ROW = r"(?i)<tr[\s\S]*?</tr>"
CELL = r"(?i)<t[hd][\s\S]*?</t[hd]>"
TABLE_TOKEN = r"\[\[TABLE_[0-9]+\]\]"

def _readings(raw: bytes, charsets: list[str]) -> list[str]:
    """What the bytes say in each charset that accepts them whole; else UTF-8 with replacements."""
    found = []
    for charset in charsets:
        try:
            found.append(raw.decode(charset))
        except (LookupError, UnicodeDecodeError):
            continue
    return found or [raw.decode("utf-8", errors="replace")]


@F.udf(T.ArrayType(T.StringType()), useArrow=False)
def _readings_of(raw: bytes | None, header: str) -> list[str] | None:
    """Page by page: an Arrow batch would hold thousands of pages and three readings of each at once."""
    return None if raw is None else _readings(bytes(raw), ["utf-8", "gb18030", *([header] if header else [])])


def decode_pages(df: DataFrame, raw: str = "raw", content_type: str = "content_type") -> DataFrame:
    """Page bytes to text: the readable reading among UTF-8, GB18030 and the declared charset.

    Spark decodes no GB18030, hence a Python function, which sees one page at a time; pure
    ASCII pages skip it.
    """
    charset = text_or_empty(find(F.col(content_type), r"(?i)charset=([\w-]+)"))
    as_text = F.col(raw).cast("string")
    ascii_only = F.is_valid_utf8(as_text) & (F.length(as_text) == F.octet_length(F.col(raw)))
    decoded = let(_readings_of(F.when(~ascii_only, F.col(raw)), charset), best_candidate)
    return df.withColumn("html", F.coalesce(decoded, as_text))


def _attribute(tag: Column, name: str) -> Column:
    return F.coalesce(
        non_empty(F.regexp_extract(tag, rf'(?i)\s{name}\s*=\s*"([^"]*)"', 1)),
        non_empty(F.regexp_extract(tag, rf"(?i)\s{name}\s*=\s*'([^']*)'", 1)),
    )


def explode_links(df: DataFrame, page: str = "page_id") -> DataFrame:
    """One row per link of a listing: absolute address, text and the date written in the link."""
    whole = r"(?i)<a\b[^>]*>[\s\S]*?</a>"
    links = explode_once(df, [page, "url"], find_all(F.col("html"), whole), "pos", "link")
    tag = F.regexp_extract("link", r"(?i)^<a\b[^>]*>", 0)
    click = r"""(?i)(?:href\s*=|open\(|url\s*=)\s*['"]([^'"]+)"""
    href = F.coalesce(
        *[_attribute(tag, name) for name in ("href", "data-href", "data-url", "data-link")],
        find(_attribute(tag, "onclick"), click),
    )
    text = H.strip_tags(F.col("link"))
    staged = links.select(page, "url", (F.col("pos") + 1).alias("pos"), strip(href).alias("href"), text.alias("text"))
    return staged.where(non_empty(F.col("href")).isNotNull()).select(
        page, "pos", "text", "href",
        resolve_url(F.col("url"), F.col("href")).alias("link_url"),
        text_or_empty(find(F.col("text"), FULL_DATE, 0)).alias("list_date"),
    )


def event_listing(df: DataFrame, page: str = "page_id") -> DataFrame:
    """Event blocks of a listing page: date, title, place, price, poster; what is missing reads N/A."""
    pieces = F.split("html", r"""(?i)<div[^>]*class=["'][^"']*timemain_a[^"']*["'][^>]*>""", -1)
    blocks = F.filter(pieces, lambda _, i: i > 0)
    rows = explode_once(df, [page, "url"], blocks, "pos", "block")

    def inner(pattern: str) -> Column:
        matched = F.when(F.col("block").rlike(pattern), F.regexp_extract("block", pattern, 1))
        return collapse(F.regexp_replace(matched, H.TAG, ""))

    day = inner(r"""(?i)<b[^>]*class=["'][^"']*size_40[^"']*["'][^>]*>([\s\S]*?)</b>""")
    month = strip(F.regexp_extract("block", r"""(?i)size_40[^>]*>[\s\S]*?</b>\s*([^<]+)""", 1))
    clock = inner(r"""(?i)<b[^>]*class=["'][^"']*size_bg[^"']*["'][^>]*>([\s\S]*?)</b>""")
    na = F.lit("N/A")
    # Searched once: resolving names the address a dozen times.
    poster = let(
        find(F.col("block"), r"""(?i)<img\b[^>]*\bsrc\s*=\s*["']([^"']+)"""),
        lambda src: F.when(src.isNotNull(), resolve_url(F.col("url"), src)),
    )
    return rows.select(
        page, (F.col("pos") + 1).alias("ordinal"),
        F.coalesce(F.concat(month, F.lit("-"), day, F.lit(" "), clock), na).alias("date"),
        F.coalesce(
            inner(r"""(?i)<h3[^>]*class=["'][^"']*yahei[^"']*["'][^>]*>[\s\S]*?<a[^>]*>([\s\S]*?)</a>"""), na
        ).alias("title"),
        F.coalesce(inner(r"""(?i)<li[^>]*class=["'][^"']*\badd\b[^"']*["'][^>]*>([\s\S]*?)</li>"""), na).alias("location"),
        F.coalesce(inner(r"""(?i)<[a-z]+[^>]*class=["'][^"']*\bmoney\b[^"']*["'][^>]*>([\s\S]*?)</"""), na).alias("price"),
        poster.alias("absolute_src"),
    )


def table_cells(df: DataFrame, page: str = "page_id") -> DataFrame:
    """Long form of every table: one row per cell, plain text."""
    tables = explode_once(df, [page], find_all(F.col("html"), TABLE), "table_no", "t")
    rows = explode_once(tables, [page, "table_no"], find_all(F.col("t"), ROW), "row_no", "r")
    cells = explode_once(rows, [page, "table_no", "row_no"], find_all(F.col("r"), CELL), "col_no", "c")
    return cells.select(
        page, *[(F.col(c) + 1).alias(c) for c in ("table_no", "row_no", "col_no")], H.strip_tags(F.col("c")).alias("cell")
    )


def _markdown_tables(html: Column) -> Column:
    """Every table with a cell as ``table_no, columns, table_rows, markdown``: header row, rule, padded body rows."""
    bar = lambda items: F.concat(F.lit("| "), F.array_join(items, " | "), F.lit(" |"))
    cell = lambda c: F.replace(H.strip_tags(c), F.lit("|"), F.lit("\\|"))
    row = lambda r: F.transform(find_all(r, CELL), cell)
    rows = lambda t: F.filter(F.transform(find_all(t, ROW), row), lambda r: F.size(r) > 0)

    def render(cells: Column, n: Column) -> Column:
        def lay(width: Column) -> Column:
            padded = F.transform(cells, lambda r: bar(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r)))))
            rule = bar(F.array_repeat(F.lit("---"), width))
            lines = let(padded, lambda p: F.concat(F.slice(p, 1, 1), F.array(rule), F.slice(p, F.lit(2), F.size(p))))
            return F.struct(
                n.alias("table_no"), width.alias("columns"), F.size(cells).alias("table_rows"), F.array_join(lines, "\n").alias("markdown")
            )

        return let(F.array_max(F.transform(cells, lambda r: F.size(r))), lay)

    # An empty table has no width and goes.
    each = lambda t, i: let(rows(t), lambda cells: F.when(F.size(cells) > 0, render(cells, i + 1)))
    return F.filter(F.transform(find_all(html, TABLE), each), lambda t: t.isNotNull())


def tables_to_rows(df: DataFrame, page: str = "page_id") -> DataFrame:
    """Every table as Markdown, one row each; pipes escaped. Work inside the page's row."""
    return df.select(page, F.explode(_markdown_tables(F.col("html"))).alias("t")).select(page, "t.*")


def html_to_text(df: DataFrame, page: str = "page_id", raw_mode: bool = True) -> DataFrame:
    """Page block to plain Markdown text with its tables kept; every line break doubled. Work inside the page's row."""
    source = H.drop_images(F.col("html")) if raw_mode else F.col("html")

    def fill(html: Column) -> Column:
        text = H.blocks_to_text(F.regexp_replace(html, TABLE, "[[TABLE_0]]"))

        def place(found: Column) -> Column:
            tables = F.map_from_entries(F.transform(_markdown_tables(html), lambda t: F.struct(t["table_no"], t["markdown"])))
            put = lambda known: F.transform(
                find_all(found, TABLE_TOKEN),
                lambda _, i: F.concat(F.lit("\n\n"), F.coalesce(F.try_element_at(known, i + 1), F.lit("")), F.lit("\n\n")),
            )
            return let(let(tables, put), lambda swaps: fill_in_order(found, TABLE_TOKEN, swaps))

        return let(text, place)

    filled = squeeze_blank_lines(let(source, fill))
    return df.select(page, F.replace(filled, F.lit("\n"), F.lit("\n\n")).alias("text"))


def _addressed_images(html: Column, site: str) -> Column:
    """Images of a page in order as (pos, image_url); those without an address have none."""
    return F.transform(find_all(html, H.IMG), lambda tag, i: F.struct(i.alias("pos"), normalize_url(H.image_source(tag), site).alias("image_url")))


def _image_token(number: Column) -> Column:
    return F.concat(F.lit("[[IMG_OCR_"), number.cast("string"), F.lit("]]"))


def extract_images(df: DataFrame, page: str = "page_id", site: str = rules.ARTICLE_SITE) -> DataFrame:
    """Images with an address, numbered in page order, with the token that stands for them. Work inside the page's row."""
    listed = F.filter(_addressed_images(F.col("html"), site), lambda x: x["image_url"].isNotNull())
    return df.select(page, F.posexplode(listed).alias("i", "image")).select(
        page, (F.col("i") + 1).alias("idx"), "image.pos", "image.image_url", _image_token(F.col("i") + 1).alias("token")
    )


def mark_images(df: DataFrame, page: str = "page_id", site: str = rules.ARTICLE_SITE) -> DataFrame:
    """Page HTML with every image replaced by its token, images without address dropped. Work inside the page's row."""

    def tokens(images: Column) -> Column:
        number = lambda i: F.size(F.filter(F.slice(images, F.lit(1), i + 1), lambda x: x["image_url"].isNotNull()))
        token = lambda x, i: F.when(x["image_url"].isNotNull(), F.concat(F.lit("<p>"), _image_token(number(i)), F.lit("</p>"))).otherwise("")
        return F.transform(images, token)

    swaps = let(_addressed_images(F.col("html"), site), tokens)
    return df.withColumn("html", fill_in_order(F.col("html"), H.IMG, swaps))


def resolve_resource_urls(df: DataFrame) -> DataFrame:
    """Every ``src="..."`` of a page made absolute against the page's address."""
    src = r'src="([^"]+)"'
    swaps = F.transform(
        find_all(F.col("html"), src, 1),
        lambda s: F.concat(F.lit('src="'), resolve_resource(F.col("url"), strip(s)), F.lit('"')),
    )
    return df.withColumn("html", fill_in_order(F.col("html"), src, swaps))


def ocr_text(payload: Column) -> Column:
    """Recognised text of an OCR reply; an errored or malformed reply is empty."""
    schema = "struct<IsErroredOnProcessing:string, ParsedResults:string>"
    reply = F.from_json(payload, schema)
    results = F.from_json(reply["ParsedResults"], "array<struct<ParsedText:string>>")
    texts = F.filter(F.transform(results, lambda r: strip(r["ParsedText"])), lambda t: t != "")
    errored = text_or_empty(F.lower(reply["IsErroredOnProcessing"]))
    return F.when(errored.isin("", "false", "0", "null", "[]", "{}"), text_or_empty(F.array_join(texts, "\n"))).otherwise("")


def link_date(text: Column) -> Column:
    return text_or_empty(let(text, lambda t: find(t, rf"20{D}{{2}}[年\-/.]{D}{{1,2}}[月\-/.]{D}{{1,2}}日?", 0)))


def article_details(articles: DataFrame, stored: DataFrame, raw_mode: bool = True) -> DataFrame:
    """Bring the stored page of every article: text, publish time and author.

    An equi-join on the address; an article whose page is not stored keeps empty fields.
    """
    fields = stored.select(
        F.col("url").alias("_url"),
        H.article_body(F.col("html")).alias("html"),
        H.page_publish_time(F.col("html")).alias("publish_text"),
        H.page_author(F.col("html")).alias("author"),
    )
    text = H.blocks_to_text(H.drop_images(F.col("html")) if raw_mode else F.col("html"))
    joined = articles.drop("content", "publish_text", "author").join(fields, F.col("url") == F.col("_url"), "left")
    return joined.withColumns(
        {"content": text, "publish_text": text_or_empty(F.col("publish_text")), "author": text_or_empty(F.col("author"))}
    ).drop("_url", "html")
