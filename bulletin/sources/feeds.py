"""Feed payloads: lists of articles and accounts as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.basics import non_empty, strip, text_or_empty
from bulletin.functions.dates import parse_epoch
from bulletin.functions.urls import normalize_url
from bulletin.operators.order import top_k
from bulletin.operators.rows import explode_once


def first_list(payload: Column) -> Column:
    """Records of a payload as array<variant>: a known list key, else any list member, else the payload itself."""
    v = F.try_parse_json(payload)
    as_list = lambda path: F.try_variant_get(v, path, "array<variant>")
    members = F.try_variant_get(v, "$", "map<string,variant>")
    other = F.get(
        F.filter(
            F.transform(F.map_values(members), lambda m: F.try_variant_get(m, "$", "array<variant>")),
            lambda a: a.isNotNull(),
        ),
        F.lit(0),
    )
    return F.coalesce(as_list("$"), *[as_list(f"$.{k}") for k in rules.LIST_KEYS], other)


def first_value(record: Column, names: list[str]) -> Column:
    """First of several fields that is neither null nor empty, as text."""
    return F.coalesce(*[non_empty(F.try_variant_get(record, f"$.{n}", "string")) for n in names])


def normalize_articles(feeds: DataFrame, site: str = rules.ARTICLE_SITE, zone: str = "UTC", entities: bool = True) -> DataFrame:
    """Article rows of feed payloads (feed_id, raw, account_keyword); records without an address go."""
    records = explode_once(feeds, ["feed_id", "account_keyword"], first_list(F.col("raw")), "pos", "r")
    r = F.col("r")
    value = lambda field: first_value(r, rules.FIELD_ALIASES[field])
    aid = F.try_variant_get(r, "$.aid", "string")
    half = lambda n: F.when(F.contains(aid, F.lit("_")), non_empty(F.regexp_extract(aid, r"^([^_]*)_([\s\S]*)\z", n)))
    raw_time = value("time")
    whole_seconds = F.when(raw_time.rlike(r"^-?[0-9]+\.[0-9]*\z"), F.regexp_extract(raw_time, r"^-?[0-9]+", 0)).otherwise(raw_time)
    rows = records.select(
        "feed_id", "account_keyword", F.col("pos").alias("ordinal"),
        F.coalesce(value("title"), F.lit("N/A")).alias("title"),
        normalize_url(value("url"), site, entities).alias("url"),
        text_or_empty(value("digest")).alias("digest"),
        normalize_url(value("cover"), site, entities).alias("cover"),
        parse_epoch(whole_seconds, zone).alias("publish_ts"),
        aid.alias("aid"),
        F.coalesce(value("mid"), half(1)).alias("mid"),
        F.coalesce(value("idx"), half(2)).alias("idx"),
    )
    return rows.where(F.col("url").isNotNull())


def account_candidates(replies: DataFrame) -> DataFrame:
    """(keyword, pos, fakeid) candidates of account-search replies (keyword, keyword_ord, raw)."""
    rows = explode_once(replies, ["keyword", "keyword_ord"], first_list(F.col("raw")), "pos", "r")
    return rows.select(
        "keyword", "keyword_ord", "pos", strip(first_value(F.col("r"), rules.ACCOUNT_ID_KEYS)).alias("fakeid")
    )


def top1_account(candidates: DataFrame) -> DataFrame:
    """First candidate per keyword; a first candidate without an id leaves its keyword unresolved."""
    first = top_k(candidates, ["keyword"], [F.col("pos")], 1)
    return first.where(non_empty(F.col("fakeid")).isNotNull()).drop("pos")
