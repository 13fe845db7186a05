"""Feeds that may fail: each is collected on its own, and what broke becomes a record."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.operators.rows import settle
from bulletin.operators.sections import complete_sections, stage_errors, union_feeds

#: What a run has when every feed failed.
NOTHING = "notice_id bigint, section string, title string, content string, ordinal bigint, feed string, feed_ord int"
ERRORS = "stage string, error string, stage_ord int"


@dataclass(frozen=True)
class Collected:
    """Items of all feeds in their order, and one error row per feed that failed (stage, error, stage_ord)."""

    items: DataFrame
    errors: DataFrame


def error_text(problem: Exception) -> str:
    """The first lines of what a feed raised, without traces of the engine below it."""
    message = re.split(r"\n\s*(?:at |JVM stacktrace)", str(problem))[0].strip()
    return message[: rules.ERROR_CHARS] or type(problem).__name__


def collect_feeds(spark: SparkSession, feeds: Sequence[tuple[str, Callable[[], DataFrame]]]) -> Collected:
    """Build and settle every feed by itself, so that one that fails takes no other with it.

    A feed is lazy until its rows are written; only then is it known to be readable. Rows of
    a feed that broke half-way are not part of the result.
    """
    done: list[tuple[str, DataFrame | None]] = []
    failed: list[tuple[str, str, int]] = []
    for place, (name, build) in enumerate(feeds, start=1):
        try:
            done.append((name, settle(build())))
        except Exception as problem:  # whatever a feed raises is its own
            done.append((name, None))
            failed.append((name, error_text(problem), place))
    items = union_feeds(done) if any(feed is not None for _, feed in done) else spark.createDataFrame([], NOTHING)
    return Collected(items, spark.createDataFrame(failed, ERRORS))


def placeholders(items: DataFrame, errors: DataFrame, stages: DataFrame, required: DataFrame) -> DataFrame:
    """Cards of the sections without an item: the error of the feed that failed, else a note to wait."""
    broken = stage_errors(items, errors, stages)
    bare = items.select("section", F.lit("").alias("title"), F.lit("").alias("content"))
    waiting = complete_sections(bare, required).where("placeholder").join(broken.select("section"), "section", "left_anti")
    return broken.withColumn("kind", F.lit("error")).unionByName(waiting.select("section", "title", "content", F.lit("empty").alias("kind")))
