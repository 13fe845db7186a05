"""HTML expressions over stored pages."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulletin import rules
from bulletin.functions.basics import WS, collapse, find, find_all, hits, let, strip, text_or_empty

TAG = r"<[^>]+>"
IMG = r"(?i)<img\b[^>]*>"


# The HTML entity names of the standard library, by first letter: a map column is
# searched from end to end, so one flat map would be slow.
_NAMED: dict[str, dict[str, str]] = {}
for _name, _text in html5.items():
    _NAMED.setdefault(_name[0], {})[_name] = _text
# Names that also count without their semicolon, longest first.
_SHORT_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
# Windows-1252 stands in for the C1 controls in numeric references.
_C1_TEXT = {i: bytes([i]).decode("cp1252", errors="ignore") or chr(i) for i in range(0x80, 0xA0)}


def _code_point(n: Column) -> Column:
    """Text of a numeric reference; forbidden code points vanish, impossible ones become U+FFFD."""
    c1 = F.get(F.array(*[F.lit(t) for t in _C1_TEXT.values()]), (n - 0x80).cast("int"))
    forbidden = (
        n.between(1, 8) | (n == 0x0B) | n.between(0x0E, 0x1F) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF)
        | (n % 0x10000).isin(0xFFFE, 0xFFFF)
    )
    return (
        F.when(n.isNull() | (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("\ufffd"))
        .when(n.between(0x80, 0x9F), c1)
        .when(forbidden, "")
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
    )


def _reference(after: Column) -> Column:
    """What follows an ``&``, with its reference decoded or the ``&`` put back."""
    shape = r"^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"

    def decoded(s: Column) -> Column:
        names = F.from_json(F.lit(json.dumps(_NAMED, ensure_ascii=False)), "map<string,map<string,string>>")
        named = lambda name: F.try_element_at(F.try_element_at(names, F.left(name, F.lit(1))), name)
        hexed = F.conv(F.regexp_extract(s, "^#[xX]0*([0-9a-fA-F]{1,7});?$", 1), 16, 10).try_cast("bigint")
        number = F.when(s.rlike("^#[xX]"), hexed).otherwise(
            F.regexp_extract(s, "^#0*([0-9]{1,9});?$", 1).try_cast("bigint")
        )
        zero = s.rlike("^#[xX]?0+;?$")
        short = F.regexp_extract(s, f"^(?:{_SHORT_NAMES})", 0)
        by_prefix = let(
            short, lambda n: F.when(n != "", F.concat(named(n), F.substring(s, F.length(n) + 1, F.length(s))))
        )
        text = F.when(F.startswith(s, F.lit("#")), let(F.when(zero, 0).otherwise(number), _code_point)).otherwise(
            F.coalesce(F.when(F.endswith(s, F.lit(";")), named(s)), by_prefix, F.concat(F.lit("&"), s))
        )
        return F.when(s == "", F.concat(F.lit("&"), after)).otherwise(
            F.concat(text, F.substring(after, F.length(s) + 1, F.length(after)))
        )

    return let(F.regexp_extract(after, shape, 0), decoded)


def unescape(col: Column) -> Column:
    """Character references decoded, in the JVM; a text without ``&`` is passed through.

    ``col`` is named once, so chains of cleaning steps stay linear.
    """
    return let(
        F.split(col, "&", -1),
        lambda parts: F.when(F.size(parts) == 1, F.get(parts, F.lit(0))).otherwise(
            F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(_reference(p))), "")
        ),
    )


def strip_tags(col: Column) -> Column:
    return collapse(unescape(F.regexp_replace(col, TAG, "")))


def drop_images(col: Column) -> Column:
    return F.regexp_replace(col, IMG, "")


_OPENING = re.compile(r"""<([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>""")
_NAMES = re.compile(r"""(?i)\b(id|class)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


def _is_container(attributes: str) -> bool:
    for name, *values in _NAMES.findall(attributes):
        value = "".join(values)
        if name.lower() == "id" and value == rules.CONTAINER_ID:
            return True
        if name.lower() == "class" and any(c in value for c in rules.CONTAINER_CLASSES):
            return True
    return False


def _containers(page: str) -> Iterator[str]:
    """Inner HTML of the outermost article containers; the end tag is the one that balances its own name."""
    at = 0
    while opening := _OPENING.search(page, at):
        at = opening.end()
        if not _is_container(opening[2]):
            continue
        depth = 1
        for tag in re.compile(rf"(?i)<(/?){re.escape(opening[1])}(?=[\s/>])[^>]*>").finditer(page, at):
            depth += -1 if tag[1] else 1
            if not depth:
                yield page[at : tag.start()]
                at = tag.end()
                break


def _longest_container(page: str) -> str | None:
    return max(_containers(page), key=len, default=None)


@F.pandas_udf(T.StringType())
def _container_batch(pages: pd.Series) -> pd.Series:
    return pages.map(_longest_container, na_action="ignore")


def container_html(page: Column) -> Column:
    """Longest article container, nesting respected. Pages without a container name stay in the JVM."""
    named = F.lit(False)
    for name in [*rules.CONTAINER_CLASSES, rules.CONTAINER_ID]:
        named = named | F.contains(page, F.lit(name))
    return _container_batch(F.when(named, page))


def longest_block(page: Column) -> Column:
    """Longest flat candidate block; the earlier pattern wins a tie."""
    candidates = F.concat(*[find_all(page, p, 1) for p in rules.BLOCK_PATTERNS])
    scored = F.transform(candidates, lambda c, i: F.struct(F.length(c).alias("n"), (-i).alias("i"), c.alias("c")))
    return F.array_max(scored)["c"]


def body_html(page: Column) -> Column:
    inner = F.when(
        hits(page, r"<body[^>]*>[\s\S]*?</body>"), F.regexp_extract(page, r"(?i)<body[^>]*>([\s\S]*?)</body>", 1)
    )
    return F.regexp_replace(inner, r"(?i)<(script|style|nav|header|footer)[^>]*>[\s\S]*?</\1>", "")


def main_content(page: Column) -> Column:
    return F.coalesce(container_html(page), longest_block(page), body_html(page), page)


def article_body(page: Column) -> Column:
    """The block of an account article: its content div, else the body, else the page."""
    return F.coalesce(
        F.when(
            page.rlike(r"""<div[^>]+id="js_content"[^>]*>[\s\S]*?</div>"""),
            F.regexp_extract(page, r"""<div[^>]+id="js_content"[^>]*>([\s\S]*?)</div>""", 1),
        ),
        F.when(
            hits(page, r"<body[^>]*>[\s\S]*?</body>"),
            F.regexp_extract(page, r"(?i)<body[^>]*>([\s\S]*?)</body>", 1),
        ),
        page,
    )


def page_publish_time(page: Column, entities: bool = True) -> Column:
    return _page_field(page, *rules.PUBLISH_TIME_FIELD, entities)


def page_author(page: Column, entities: bool = True) -> Column:
    return _page_field(page, *rules.AUTHOR_FIELD, entities)


def _page_field(page: Column, by_id: str, by_script: str, entities: bool) -> Column:
    shown = F.when(page.rlike(by_id), F.regexp_extract(page, by_id, 1))
    if entities:
        shown = unescape(shown)
    return text_or_empty(strip(F.coalesce(shown, F.regexp_extract(page, by_script, 1))))


def sanitize_fragment(page: Column) -> Column:
    """Publishable fragment: the page's main block or body, without document-level and script markup."""
    main = find(page, rules.MAIN_BLOCK)
    body = find(page, r"(?i)<body[^>]*>([\s\S]*?)</body>")
    out = strip(F.coalesce(main, body, page))
    for pattern in rules.FRAGMENT_CUTS:
        out = F.regexp_replace(out, pattern.format(ws=WS), "")
    return strip(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def image_source(tag: Column) -> Column:
    """Raw ``data-src``, else ``src``, of one image tag."""
    tries = []
    for name in ("data-src", "src"):
        quoted = rf"""(?is){name}\s*=\s*(["'])(.*?)\1"""
        bare = rf"(?i){name}\s*=\s*([^\s>]+)"
        tries.append(F.when(tag.rlike(quoted), strip(F.regexp_extract(tag, quoted, 2))))
        tries.append(F.when(tag.rlike(bare), F.btrim(F.regexp_extract(tag, bare, 1), F.lit("\"'"))))
    return F.coalesce(*tries)


def escape(col: Column, quotes: bool = True) -> Column:
    """Text made safe inside HTML."""
    out = F.replace(text_or_empty(col), F.lit("&"), F.lit("&amp;"))
    out = F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    if quotes:
        out = F.replace(F.replace(out, F.lit('"'), F.lit("&quot;")), F.lit("'"), F.lit("&#x27;"))
    return out


def blocks_to_text(page: Column) -> Column:
    """Markup to plain lines: block tags break lines, headings become ``#`` lines, other tags go."""
    out = F.regexp_replace(text_or_empty(page), r"(?is)<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?is)<(script|style|title)[^>]*>.*?</\1>", "")
    out = F.regexp_replace(out, r"[\s]+", " ")
    for level in range(1, 7):
        out = F.regexp_replace(out, rf"(?i)<h{level}(?:\s[^>]*)?>\s*", "\n" + "#" * level + " ")
    out = F.regexp_replace(out, r"(?i)<li(?:\s[^>]*)?>\s*", "\n* ")
    out = F.regexp_replace(out, r"(?i)</?(?:" + "|".join(rules.BLOCK_TAGS) + r")(?:\s[^>]*|/)?>", "\n")
    out = unescape(F.regexp_replace(out, TAG, ""))
    out = F.regexp_replace(out, r"[ \t]*\n[ \t]*", "\n")
    return strip(F.regexp_replace(out, r"\n{2,}", "\n"))


def _first_markup(payload: str) -> str:
    """Depth-first: known keys of an object first, then its other values in their order."""
    try:
        waiting = [json.loads(payload)]
    except (ValueError, RecursionError):
        return ""
    while waiting:
        value = waiting.pop()
        if isinstance(value, str):
            text = value.strip()
            if "<" in text and ">" in text:
                return text
        elif isinstance(value, dict):
            known = [value[k] for k in rules.HTML_KEYS if k in value]
            waiting += reversed(known + [v for k, v in value.items() if k not in rules.HTML_KEYS])
        elif isinstance(value, list):
            waiting += reversed(value)
    return ""


@F.pandas_udf(T.StringType())
def _markup_batch(payloads: pd.Series) -> pd.Series:
    return payloads.map(_first_markup, na_action="ignore")


def html_string(payload: str) -> Column:
    """First string holding ``<`` and ``>`` in the JSON payload column of that name, at any depth; else empty.

    Payloads without both marks, even as escapes, stay in the JVM.
    """
    raw = F.col(payload)
    mark = lambda c, code: F.contains(raw, F.lit(c)) | F.contains(F.lower(raw), F.lit(f"\\u00{code}"))
    return text_or_empty(strip(_markup_batch(F.when(mark("<", "3c") & mark(">", "3e"), raw))))
