"""Text cleaning, measuring and shortening."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulletin import rules
from bulletin.functions.basics import (
    CJK,
    DIGIT as D,
    FULLWIDTH_DIGITS,
    WORD,
    WS,
    clamp_score,
    collapse,
    count_of,
    find,
    find_all,
    has_any,
    join_lines,
    let,
    lines,
    non_empty,
    rstrip,
    strip,
    text_or_empty,
)
from bulletin.functions.html import TAG, escape, unescape

# (marks, pattern, replacement): a step runs only on texts that hold one of its marks.
# In these patterns (?d) makes \n the only line end, as ^ and $ are meant.
_MARKUP = [
    ("<", r"(?is)<(script|style)[^>]*>.*?</\1>", " "),
    ("<", r"(?i)<br\s*/?>", "\n"),
    ("<", r"(?i)</?(?:" + "|".join(rules.BLOCK_TAGS) + r")[^>]*>", "\n"),
    ("<", TAG, " "),
]
_MARKDOWN = [
    ("[", r"!\[([^\]]*)\]\([^)]*\)", "$1"),
    ("[", r"\[([^\]]+)\]\([^)]*\)", "$1"),
    ("`", r"`{1,3}([^`]+)`{1,3}", "$1"),
    (">", rf"(?md)^{WS}{{0,3}}>{WS}?", ""),
    ("---|***|___|-*|-_|*-|*_|_-|_*", rf"(?md)^{WS}*[-*_]{{3,}}{WS}*$", ""),
    ("#", rf"(?md)^{WS}*#{{1,6}}{WS}*([^#\n]+?){WS}*$", "### $1"),
    # The mark comes before the look-behind, so most characters fail on the first test.
    ("**", r"\*\*(?<!\*\*\*)([^*\n]+)\*\*(?!\*)", "$1"),
    ("__", r"__(?<!___)([^_\n]+)__(?!_)", "$1"),
    ("*", r"\*(?<!\*\*)([^*\n]+)\*(?!\*)", "$1"),
    ("_", r"_(?<!__)([^_\n]+)_(?!_)", "$1"),
    ("\\", r"\\([*_#`>\-])", "$1"),
    ("\n |\n\t", r"\n[ \t]+", "\n"),
    (" \n|\t\n", r"[ \t]+\n", "\n"),
    ("\n\n\n", r"\n{3,}", "\n\n"),
]
_STRAY = [
    ("***", r"(?md)^[ \t]*\*{3,}[ \t]*$", ""),
    ("****", r"\*{4,}", ""),
    ("\n\n|\n |\n\t", r"\n[ \t\n]*\n", "\n\n"),
]


def _chain(col: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, replacement in steps:
        col = F.regexp_replace(col, pattern, replacement)
    return col


def _marked_chain(col: Column, steps: list[tuple[str, str, str]]) -> Column:
    def step(marks: str, pattern: str, replacement: str):
        return lambda t: F.when(has_any(t, marks.split("|")), F.regexp_replace(t, pattern, replacement)).otherwise(t)

    for marks, pattern, replacement in steps:
        col = let(col, step(marks, pattern, replacement))
    return col


def clean_markdown(col: Column) -> Column:
    """Residual HTML and Markdown marks removed, headings lowered to ``###``."""
    out = F.replace(text_or_empty(col), F.lit("\ufeff"), F.lit(""))
    out = unescape(_marked_chain(out, _MARKUP))
    out = F.replace(out, F.lit("&nbsp;"), F.lit(" "))
    return strip(_marked_chain(strip(_marked_chain(out, _MARKDOWN)), _STRAY))


def normalize_space(col: Column) -> Column:
    steps = [(r"\r\n?", "\n"), (r"\n{3,}", "\n\n"), (r"[ \t]+", " ")]
    return strip(_chain(text_or_empty(col), steps))


def strip_images(col: Column) -> Column:
    return _chain(
        text_or_empty(col), [(r"!\[[^\]]*\]\([^)]*\)", ""), (rf"\[图片文字{WS}*{D}+\][^\n]*", "")]
    )


def raw_clean(col: Column) -> Column:
    """Ranked-issue body: images out, Markdown cleaned."""
    return strip(F.regexp_replace(clean_markdown(strip_images(col)), r"\n{3,}", "\n\n"))


def drop_leading_blank(items: Column) -> Column:
    def cut(xs: Column) -> Column:
        first = F.array_position(F.transform(xs, lambda x: strip(x) != ""), F.lit(True)).cast("int")
        return let(first, lambda n: F.when(n == 0, F.slice(xs, 1, 0)).otherwise(F.slice(xs, F.greatest(n, F.lit(1)), F.size(xs))))

    return let(items, cut)


def normalize_headings(col: Column, title: Column) -> Column:
    """A leading heading equal to the title goes; every other heading becomes ``###``."""
    heading = lambda line: strip(F.regexp_replace(line, rf"^#+{WS}*", ""))
    body = drop_leading_blank(lines(col))

    def without_title(items: Column) -> Column:
        first = strip(F.get(items, F.lit(0)))
        repeats = F.coalesce(
            F.startswith(first, F.lit("#")) & (strip(title) != "") & (heading(first) == strip(title)), F.lit(False)
        )
        return F.when(repeats, drop_leading_blank(F.slice(items, 2, F.size(items)))).otherwise(items)

    def lowered(line: Column) -> Column:
        return F.when(
            line.rlike(rf"^{WS}*#") & (heading(strip(line)) != ""),
            F.concat(F.lit("### "), heading(strip(line))),
        ).otherwise(line)

    return strip(join_lines(F.transform(let(body, without_title), lowered)))


def quality_score(col: Column) -> Column:
    def measure(text: Column) -> Column:
        noise = count_of(text, f"(?iu){rules.NOISE_WORDS}")
        tags = count_of(text, r"<[a-zA-Z/][^>]*>")
        return count_of(text, CJK) * 3 + F.length(text) - noise * 20 - tags * 10

    return let(strip(text_or_empty(col)), measure)


def mojibake_score(col: Column) -> Column:
    """Comparable struct: readable characters, then fewest broken runs, then shortest."""
    text = text_or_empty(col)
    return F.struct(
        (count_of(text, CJK) + count_of(text, rules.QUALITY_WORDS) * 2).alias("readable"),
        (-count_of(text, rules.MOJIBAKE_RUN)).alias("broken"),
        (-F.length(text)).alias("shorter"),
    )


def best_candidate(candidates: Column) -> Column:
    """Candidate with the best quality; the earliest wins a tie."""
    scored = F.transform(
        candidates, lambda c, i: F.struct(mojibake_score(c).alias("q"), (-i).alias("i"), c.alias("c"))
    )
    return F.array_max(F.filter(scored, lambda s: s["c"].isNotNull()))["c"]


def latin1_reading(line: Column) -> Column:
    """The line's latin-1 bytes read as UTF-8, NULL where that is impossible."""
    return F.when(
        line.rlike(r"^[\x{00}-\x{ff}]*\z") & line.rlike(r"[\x{c2}-\x{f4}]"),
        let(F.encode(line, "ISO-8859-1"), lambda b: F.when(F.is_valid_utf8(b.cast("string")), b.cast("string"))),
    )


# The characters Windows-1252 has in place of the C1 controls.
_CP1252_TAIL = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
# A UTF-8 lead byte followed by a continuation byte, both seen as single-byte characters.
_MISREAD = rf"[\x{{c2}}-\x{{f4}}][\x{{80}}-\x{{bf}}{_CP1252_TAIL}]"


def _cp1252_line(line: str | None) -> str | None:
    try:
        return None if line is None else line.encode("cp1252").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return None


@F.pandas_udf(T.ArrayType(T.StringType()))
def _cp1252_batch(values: pd.Series) -> pd.Series:
    return values.map(lambda parts: None if parts is None else [_cp1252_line(p) for p in parts])


def repair_mojibake(col: Column) -> Column:
    """Line by line, the best of: as is, latin-1 bytes as UTF-8, cp1252 bytes as UTF-8.

    Only a line with a misread byte pair has another reading. Spark has no cp1252
    encoder, so texts with such a line, and only those, go through one Arrow batch call.
    """
    parts = lines(col)
    suspicious = F.transform(parts, lambda p: F.when(p.rlike(_MISREAD), p))
    rereads = _cp1252_batch(F.when(text_or_empty(col).rlike(_MISREAD), suspicious))
    fixed = F.zip_with(
        parts,
        F.coalesce(rereads, F.array().cast("array<string>")),
        lambda p, cp: F.when(p.rlike(_MISREAD), best_candidate(F.array(p, latin1_reading(p), cp))).otherwise(p),
    )
    return join_lines(fixed)


def trim_report_text(col: Column, title: Column) -> Column:
    """Cut to the first start marker and before the first end marker."""

    def begun(text: Column) -> Column:
        starts = F.array(
            F.instr(text, F.lit("**报告题目")),
            F.instr(text, F.lit("报告题目：")),
            F.instr(text, F.concat(F.lit("### "), text_or_empty(title))),
            F.when(text_or_empty(title) != "", F.instr(text, title)),
        )
        return let(
            F.array_min(F.filter(starts, lambda p: p > 0)),
            lambda p: F.when(p.isNull(), text).otherwise(F.substring(text, p, F.length(text))),
        )

    def ended(body: Column) -> Column:
        ends = F.array(*[F.instr(body, F.lit(m)) for m in rules.REPORT_END_MARKERS])
        return let(
            F.array_min(F.filter(ends, lambda p: p > 1)),
            lambda p: F.when(p.isNull(), body).otherwise(F.substring(body, F.lit(1), p - 1)),
        )

    whole = let(let(text_or_empty(col), begun), ended)
    return strip(F.regexp_replace(whole, r"\n{3,}", "\n\n"))


def report_text(col: Column, title: Column) -> Column:
    """Detail page text ready for field extraction: repaired, relabelled, trimmed."""
    plain = F.replace(text_or_empty(col), F.lit("\ufeff"), F.lit(""))
    fixed = repair_mojibake(join_lines(F.transform(lines(plain), rstrip)))
    return trim_report_text(F.regexp_replace(fixed, "报告 {1,2}人", "报告人"), title)


def lecture_segment(col: Column) -> Column:
    """From the first ``第N讲：`` up to the lecturer's label."""
    start = rf"第{D}+讲："
    bounded = rf"^({start}[\s\S]*?)(?:教师|主讲人)"
    return let(
        F.regexp_extract(col, rf"{start}[\s\S]*", 0),
        lambda whole: F.when(whole == "", col)
        .when(whole.rlike(bounded), strip(F.regexp_extract(whole, bounded, 1)))
        .otherwise(whole),
    )


def labelled_field(col: Column, labels: list[str]) -> Column:
    """First label with a value on its line; emphasis marks removed."""
    values = [
        non_empty(
            strip(F.replace(F.regexp_extract(col, rf"{label}{WS}*[：:]{WS}*(?:\*\*)?{WS}*([^\n]+)", 1), F.lit("**"), F.lit("")))
        )
        for label in labels
    ]
    return text_or_empty(F.coalesce(*values))


def report_summary(col: Column) -> Column:
    """Text after the abstract label, up to the next field or page-navigation label."""
    after = strip(
        F.regexp_extract(col, rf"(?iu)(?:{rules.SUMMARY_START}){WS}*[：:]?(?:\*\*)?{WS}*([\s\S]+)\z", 1)
    )
    stop = rules.SUMMARY_STOP.format(ws=WS)
    kept = strip(F.get(F.split(after, rf"(?md)\n{WS}*(?:\*\*)?(?:{stop})(?:{WS}*[：:][^\n]*)?$", 2), F.lit(0)))
    return strip(F.substring(F.regexp_replace(kept, r"\n{3,}", "\n\n"), 1, rules.REPORT_SUMMARY_CHARS))


def text_units(col: Column) -> Column:
    """One unit per CJK character and per Latin word."""
    text = text_or_empty(col)
    return count_of(text, CJK) + count_of(text, WORD)


def clip_pattern(limit: Column | int) -> Column:
    """Regex for the longest start of a text within ``limit`` units; marks and spaces are free."""
    free = r"[^\x{4e00}-\x{9fff}A-Za-z0-9_]*"
    limit = F.lit(limit) if isinstance(limit, int) else limit
    return F.concat(
        F.lit(rf"^(?:{free}(?:{CJK}|{WORD})){{0,"), limit.cast("string"), F.lit(rf"}}{free}")
    )


def clip_units(col: Column, limit: Column | int) -> Column:
    return strip(F.call_function("regexp_extract", text_or_empty(col), clip_pattern(limit), F.lit(0)))


def body_budget(summary: Column) -> Column:
    return F.greatest(
        F.lit(rules.MIN_BODY_UNITS), F.lit(rules.ITEM_UNITS - rules.BODY_RESERVE) - text_units(summary)
    )


def compress_body(content: Column, summary: Column, section: Column) -> Column:
    """Body within its unit budget; a report that carries an abstract is never cut."""

    def fit(clean: Column) -> Column:
        whole = ((section == rules.REPORT_SECTION) & clean.rlike("(?:内容摘要|报告摘要)[：:]")) | (
            text_units(summary) + text_units(clean) <= rules.ITEM_UNITS
        )
        return F.when(whole, clean).otherwise(clip_units(clean, body_budget(summary)))

    return let(normalize_space(content), fit)


def item_summary(content: Column) -> Column:
    return clip_units(normalize_space(content), rules.SUMMARY_UNITS)


def feed_summary(digest: Column, content: Column) -> Column:
    """First non-empty of digest and content, cleaned, on one line, 100 characters."""
    own = let(clean_markdown(digest), lambda d: F.when(d != "", d))
    return F.substring(collapse(F.coalesce(own, clean_markdown(content))), 1, rules.FEED_SUMMARY_CHARS)


def summary_repeats(summary: Column, content: Column) -> Column:
    squeeze = lambda c: F.regexp_replace(text_or_empty(c), f"{WS}+", "")
    return let(squeeze(summary), lambda key: (key != "") & F.startswith(squeeze(content), key))


def filter_snippet(digest: Column, content: Column, image_texts: Column) -> Column:
    part = lambda label, c: F.concat(F.lit(label), non_empty(c))
    notes = join_lines(F.filter(F.transform(image_texts, strip), lambda t: t != ""))
    return F.substring(
        F.concat_ws(
            "\n", part("摘要: ", strip(digest)), part("正文: ", strip(content)), part("图片文字: ", notes)
        ),
        1,
        rules.SNIPPET_CHARS,
    )


def decode_escapes(col: Column) -> Column:
    r"""Literal ``\uXXXX`` sequences become the characters they name."""
    escape = r"\\u([0-9a-fA-F]{4})"
    pieces = F.split(col, escape, -1)
    chars = F.transform(find_all(col, escape, 1), lambda h: F.decode(F.unhex(h), "UTF-16BE"))
    return F.when(
        F.contains(col, F.lit("\\u")),
        F.array_join(F.zip_with(pieces, chars, lambda a, b: F.concat(a, text_or_empty(b))), ""),
    ).otherwise(col)


def fit_bytes(text: Column, max_chars: int, max_bytes: int, ellipsis: str = "") -> Column:
    """Longest start within both limits, without trailing white space."""
    cut = F.when(
        F.length(text) > max_chars, F.concat(rstrip(F.substring(text, 1, max_chars)), F.lit(ellipsis))
    ).otherwise(text)
    if not max_bytes:
        return cut
    # The text is at most max_chars long here, so the scan is bounded too.
    fitting = lambda t: F.array_max(
        F.filter(F.sequence(F.lit(0), F.length(t)), lambda n: F.octet_length(F.substring(t, F.lit(1), n)) <= max_bytes)
    )
    return let(
        cut,
        lambda t: F.when(F.octet_length(t) <= max_bytes, t).otherwise(rstrip(F.substring(t, F.lit(1), fitting(t)))),
    )


def fit_field(col: Column, field: str, fallback: str = "", boilerplate: list[str] | None = None, entities: bool = True) -> Column:
    """A publishable field within its character and byte limits."""
    max_chars, max_bytes = rules.FIELD_LIMITS[field]
    text = decode_escapes(text_or_empty(col))
    if field == "source_url":
        ok = strip(text).rlike(r"^(?i:https?)://[^/?#]+")
        return F.when(ok, F.substring(strip(text), 1, max_chars)).otherwise("")
    text = collapse(text)
    if entities:
        text = strip(unescape(text))
    for pattern in boilerplate or []:
        text = strip(F.regexp_replace(text, pattern, ""))
    text = F.coalesce(non_empty(text), F.lit(fallback))
    fitted = let(text, lambda t: fit_bytes(t, max_chars, max_bytes, "..." if field == "digest" else ""))
    return F.coalesce(non_empty(fitted), F.lit(fallback))


LABEL = r"^([^:：]{1,12})[:：]"


def split_label(col: Column) -> tuple[Column, Column]:
    """(label, value) of a labelled line; an unlabelled line is all value."""
    shape = rf"{LABEL}{WS}*([^\n]+)"
    return (
        F.when(col.rlike(shape), strip(F.regexp_extract(col, shape, 1))).otherwise(""),
        F.when(col.rlike(shape), strip(F.regexp_extract(col, shape, 2))).otherwise(col),
    )


def first_heading(col: Column) -> Column:
    return text_or_empty(
        let(
            F.filter(F.transform(lines(col), strip), lambda line: F.startswith(line, F.lit("# "))),
            lambda found: strip(F.substring(F.get(found, F.lit(0)), 3, 2**31 - 1)),
        )
    )


def first_plain_line(col: Column, limit: int = 120) -> Column:
    """First line that is not blank, a heading or an image."""
    plain = F.filter(F.transform(lines(col), strip), lambda line: (line != "") & ~line.rlike("^[#!]"))
    return text_or_empty(F.substring(collapse(F.get(plain, F.lit(0))), 1, limit))


def broken_lines(col: Column) -> Column:
    """Suspicious lines as array<struct<line_no, sample>>."""
    numbered = F.transform(lines(col), lambda line, i: F.struct((i + 1).alias("line_no"), line.alias("sample")))
    return F.transform(
        F.filter(numbered, lambda n: n["sample"].rlike(rules.AUDIT_PATTERNS)),
        lambda n: F.struct(n["line_no"].alias("line_no"), F.substring(strip(n["sample"]), 1, rules.AUDIT_CHARS).alias("sample")),
    )


def title_key(col: Column) -> Column:
    """Title without white space and joining marks, lower-cased."""
    return strip(F.lower(F.regexp_replace(text_or_empty(col), rf"{WS}|[\[\](){{}}、，,：:|?/\\\-]", "")))


def highlight_times(col: Column) -> Column:
    pattern = "|".join(p.format(d=D, ws=WS) for p in rules.HIGHLIGHT_PATTERNS)
    return F.regexp_replace(escape(col), f"({pattern})", "<span class='time-highlight'>$1</span>")


def embedded_score(content: Column) -> Column:
    """Score line of a ranked item; the last wins, none is 0."""
    scored = find_all(
        content, rf"(?md)^{WS}*{rules.SCORE_LABEL}:(?:(?!\n){WS})*({D}{{1,3}})/100", 1
    )
    last = F.translate(F.try_element_at(scored, F.lit(-1)), FULLWIDTH_DIGITS, "0123456789").cast("int")
    return F.coalesce(let(last, clamp_score), F.lit(0))


def without_score_lines(content: Column) -> Column:
    kept = F.filter(
        lines(content),
        lambda line: ~strip(line).rlike(rf"^(?:{rules.SCORE_LABEL}:{WS}*{D}{{1,3}}/100|{rules.BASIS_LABEL}:)"),
    )
    return strip(F.regexp_replace(strip(join_lines(kept)), r"\n{3,}", "\n\n"))


def json_block(col: Column) -> Column:
    """Outermost braces of a reply that may wrap its JSON in prose."""
    return find(col, r"\{[\s\S]*\}", 0)


def squeeze_blank_lines(col: Column) -> Column:
    return F.regexp_replace(col, r"\n{3,}", "\n\n")

