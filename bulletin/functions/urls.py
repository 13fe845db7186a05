"""URL expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.basics import find, let, strip, text_or_empty
from bulletin.functions.html import unescape

SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
QUERY = r"^[^?#]*\?([^#]*)"


def normalize_url(url: Column, site: str = rules.ARTICLE_SITE, entities: bool = True) -> Column:
    """Entities decoded, ``//`` and ``/`` made absolute; blank is NULL."""
    decoded = unescape(url) if entities else url
    return let(
        strip(F.replace(decoded, F.lit("&amp;"), F.lit("&"))),
        lambda clean: F.when(F.startswith(clean, F.lit("//")), F.concat(F.lit("https:"), clean))
        .when(F.startswith(clean, F.lit("/")), F.concat(F.lit(site), clean))
        .when(clean != "", clean),
    )


def _decode(text: Column) -> Column:
    plain = F.translate(text, "+", " ")
    return F.coalesce(F.try_url_decode(text), plain)


def _encode(text: Column) -> Column:
    # URLEncoder leaves '*' and escapes '~'; form encoding wants the opposite.
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_query(query: Column, ignore: Sequence[str] = tuple(rules.TRACKING_KEYS)) -> Column:
    """Blank values and ignored keys dropped, first value per key, sorted by key."""
    pairs = F.transform(
        F.filter(F.split(text_or_empty(query), "&"), lambda p: p.rlike("^[^=]*=.")),
        lambda p: F.struct(
            _decode(F.regexp_extract(p, "^([^=]*)=", 1)).alias("k"),
            _decode(F.regexp_extract(p, r"(?s)^[^=]*=(.*)\z", 1)).alias("v"),
        ),
    )
    wanted = F.filter(pairs, lambda p: ~p["k"].isin(list(ignore)) if ignore else F.lit(True))

    def firsts(ps: Column) -> Column:
        return let(
            F.transform(ps, lambda p: p["k"]),
            lambda keys: F.filter(ps, lambda p, i: F.array_position(keys, p["k"]) == i + 1),
        )

    return F.array_join(
        F.transform(
            F.array_sort(let(wanted, firsts)),
            lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"])),
        ),
        "&",
    )


def canonical_url(url: Column, ignore: Sequence[str] = tuple(rules.TRACKING_KEYS)) -> Column:
    """URL without tracking parameters and fragment, for use as a dedup key; empty for NULL."""
    scheme = F.lower(find(url, SCHEME))
    authority = find(url, AUTHORITY)
    query = let(canonical_query(find(url, QUERY), ignore), lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
    return text_or_empty(
        F.concat(
            F.coalesce(F.concat(scheme, F.lit(":")), F.lit("")),
            F.coalesce(F.concat(F.lit("//"), authority), F.lit("")),
            F.regexp_extract(url, PATH, 1),
            query,
        )
    )


def set_query_param(url: Column, name: str, value: str) -> Column:
    return F.when(
        F.contains(url, F.lit(f"{name}=")), F.regexp_replace(url, f"{name}=[^&]+", f"{name}={value}")
    ).otherwise(F.concat(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit(f"{name}={value}")))


def origin(url: Column) -> Column:
    return F.concat(find(url, SCHEME), F.lit("://"), text_or_empty(find(url, AUTHORITY)))


def resolve_url(base: Column, ref: Column) -> Column:
    """``ref`` against ``base``: absolute, protocol-relative, rooted, query-only, fragment-only or relative."""
    folder = F.regexp_replace(F.regexp_extract(base, PATH, 1), r"[^/]*\z", "")
    rooted_folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    joined = F.concat(rooted_folder, ref)
    return (
        F.when(text_or_empty(ref) == "", base)
        .when(ref.rlike(SCHEME), ref)
        .when(F.startswith(ref, F.lit("//")), F.concat(find(base, SCHEME), F.lit(":"), ref))
        .when(F.startswith(ref, F.lit("/")), F.concat(origin(base), drop_dots(ref)))
        .when(F.startswith(ref, F.lit("#")), F.concat(F.regexp_extract(base, "^[^#]*", 0), ref))
        .when(F.startswith(ref, F.lit("?")), F.concat(F.regexp_extract(base, "^[^?#]*", 0), ref))
        .otherwise(F.concat(origin(base), drop_dots(joined)))
    )


def drop_dots(path: Column) -> Column:
    """Remove ``.`` and ``..`` segments; anything after ``?`` or ``#`` is left alone."""
    head = F.regexp_extract(path, "^[^?#]*", 0)
    tail = F.regexp_extract(path, r"(?s)[?#].*\z", 0)
    segments = F.split(head, "/", -1)
    ends_in_dot = head.rlike(r"(?:^|/)\.{1,2}\z")
    walked = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when((s == "..") & (F.size(acc) > 1), F.slice(acc, 1, F.size(acc) - 1))
        .when(s == "..", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    plain = F.concat(F.array_join(walked, "/"), F.when(ends_in_dot, "/").otherwise(""), tail)
    return F.when(head.rlike(r"(?:^|/)\.{1,2}(?:/|\z)"), plain).otherwise(path)


def resolve_resource(base: Column, src: Column) -> Column:
    """An image or script source made absolute; localhost stands for the page's own origin."""
    local = r"^https?://localhost"
    return (
        F.when(src.rlike(local), F.concat(origin(base), F.regexp_replace(src, r"https?://localhost", "")))
        .when(F.startswith(src, F.lit("//")), F.concat(F.lower(find(base, SCHEME)), F.lit(":"), src))
        .when(~F.startswith(src, F.lit("http")), resolve_url(base, src))
        .otherwise(src)
    )
