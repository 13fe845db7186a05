"""Small expression helpers shared by every module.

Patterns here are written so that Java and RE2 read them alike: whitespace and
digits are spelled out because the engines disagree on what ``\\s`` and ``\\d``
cover beyond ASCII.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, as a regex class and as the characters themselves.
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WS_CHARS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
# ASCII and full-width digits.
DIGIT = r"[0-9\x{ff10}-\x{ff19}]"
FULLWIDTH_DIGITS = "".join(map(chr, range(0xFF10, 0xFF1A)))
CJK = r"[\x{4e00}-\x{9fff}]"
WORD = r"[A-Za-z0-9_]+"
RARE_BREAK = r"[\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
LINE_BREAK = rf"\r\n|\n|{RARE_BREAK}"


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def non_empty(col: Column) -> Column:
    """NULL for the empty string."""
    return F.nullif(col, F.lit(""))


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WS_CHARS))


def rstrip(col: Column) -> Column:
    return F.rtrim(col, F.lit(WS_CHARS))


def collapse(col: Column) -> Column:
    """Every white-space run becomes one space, ends trimmed."""
    return strip(F.regexp_replace(col, f"{WS}+", " "))


def unix_lines(col: Column) -> Column:
    """Every line end becomes ``\\n``; texts that already use it only pay one scan."""
    return let(
        text_or_empty(col),
        lambda t: F.when(t.rlike(RARE_BREAK), F.regexp_replace(t, rf"\r\n|{RARE_BREAK}", "\n")).otherwise(t),
    )


def lines(col: Column) -> Column:
    return F.split(unix_lines(col), "\n", -1)


def find(col: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, NULL when there is none (or it is empty).

    Through ``let``, because NULLIF inside a branch or a lambda would search twice.
    """
    return let(F.regexp_extract(col, pattern, group), lambda found: F.when(found != "", found))


def find_all(col: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(col, F.lit(pattern), F.lit(group))


def count_of(col: Column, pattern: str) -> Column:
    return F.regexp_count(col, F.lit(pattern))


def hits(col: Column, pattern: str) -> Column:
    """Case-insensitive search."""
    return col.rlike(f"(?iu){pattern}")


def has_any(col: Column, words: Sequence[str]) -> Column:
    """Substring test against a rule list; an empty list matches nothing."""
    return reduce(lambda acc, w: acc | col.contains(w), [w for w in words if w], F.lit(False))


def fold(col: Column) -> Column:
    """Lower case, with the letters that match i, s and k when case is ignored."""
    return F.lower(F.translate(col, "\u0130\u0131\u017f\u212a", "iisk"))


def has_any_ci(col: Column, words: Sequence[str]) -> Column:
    lowered = [w.lower() for w in words if w]
    return let(F.lower(col), lambda low: has_any(low, lowered))


def has_words(folded: Column, alternatives: str) -> Column:
    """``a|b|c`` as substring tests on folded text: several times faster than one regex."""
    return has_any(folded, alternatives.lower().split("|"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def join_lines(items: Column) -> Column:
    return F.array_join(items, "\n")


def clamp_score(col: Column) -> Column:
    """0..100; NULL stays NULL, which least and greatest alone would lose."""
    return F.when(col.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(100), col)))


def fill_in_order(content: Column, pattern: str, replacements: Column) -> Column:
    """Replace the n-th match of ``pattern`` by the n-th element of ``replacements``."""
    pieces = F.split(content, pattern, -1)
    return F.array_join(
        F.zip_with(pieces, replacements, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""
    )
