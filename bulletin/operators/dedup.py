"""Duplicates: by article id, by address, by title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin.functions.basics import non_empty
from bulletin.functions.urls import canonical_url
from bulletin.operators.decisions import decide
from bulletin.operators.order import first_per_key


def article_key() -> Column:
    """``mid:idx`` where both are known, else the canonical address; empty is NULL."""
    by_id = F.concat(non_empty(F.col("mid")), F.lit(":"), non_empty(F.col("idx")))
    return F.coalesce(by_id, non_empty(canonical_url(F.col("url"))))


def dedupe_articles(df: DataFrame) -> DataFrame:
    """First article per key in feed order; articles without a key are dropped."""
    keyed = df.withColumn("dedupe_key", article_key()).where(F.col("dedupe_key").isNotNull())
    return first_per_key(keyed, ["dedupe_key"], [F.col("ordinal")])


def dedupe_urls(df: DataFrame, key: str = "notice_id") -> DataFrame:
    """Flag every later listing of the same exact address.

    The first listing per address comes from a partial aggregate; the join back is an
    equi-join whose hot addresses adaptive execution can split.
    """
    first = df.where(F.col("url").isNotNull()).groupBy("url").agg(
        F.min(F.struct("ordinal", F.col(key).alias("first_key"))).alias("f")
    )
    joined = df.join(first.select(F.col("url").alias("_url"), F.col("f.first_key").alias("_first")), F.col("url") == F.col("_url"), "left")
    is_first = F.col("_first").isNull() | (F.col(key) == F.col("_first"))
    return decide(
        joined, is_first, F.when(is_first, "list_item").otherwise("duplicate_url"), "crawler_list"
    ).drop("_url", "_first")


def merge_by_title(df: DataFrame) -> DataFrame:
    """One event per title: attributes of its last listing and the number of its dates."""
    last = F.max_by(F.struct("location", "price", "absolute_src", "ordinal"), F.col("ordinal"))
    merged = df.groupBy("title").agg(last.alias("last"), F.count(F.lit(1)).alias("n_dates"))
    return merged.select("title", "last.location", "last.price", "last.absolute_src", F.col("last.ordinal").alias("ordinal"), "n_dates")


def title_dates(df: DataFrame) -> DataFrame:
    """The dates of every event, one row each; an event prints them by ``place`` ascending, last listing first.

    A title may have any number of dates, so they stay rows.
    """
    return df.select("title", "date", (-F.col("ordinal")).alias("place"))


def duplicate_titles(df: DataFrame) -> DataFrame:
    """The listings ``merge_by_title`` folds into a later one, as decisions."""
    last = df.groupBy("title").agg(F.max("ordinal").alias("_last"))
    joined = df.join(last, "title")
    survives = F.col("ordinal") == F.col("_last")
    return decide(
        joined, survives, F.when(survives, "crawler_selected").otherwise("duplicate_title"), "crawler_hall_refine"
    ).drop("_last")
