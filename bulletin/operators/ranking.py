"""Rank, select and flag the head of each section."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.basics import strip, text_or_empty
from bulletin.functions.dates import Clock, first_stamp_eod
from bulletin.operators.decisions import decide
from bulletin.operators.order import positions, top_k
from bulletin.operators.rows import settle
from bulletin.operators.temporal import event_expired, expired_event

SECTION = ["section"]


def rank_in_section(scored: DataFrame, carry: tuple[str, ...] = ("notice_id", "reason")) -> DataFrame:
    """Position by score, best first, feed order inside a score.

    Counting and numbering both read the scores, so the scored rows are settled once,
    without their text; join the text back by ``notice_id`` where it is printed.
    """
    narrow = settle(scored.select(*carry, "section", "ordinal", "score"))
    worst = narrow.withColumn("_worst", (-F.col("score")).cast("bigint"))
    return positions(worst, SECTION, ["_worst", "ordinal"], "rank", exact=["_worst"]).drop("_worst")


def item_index(df: DataFrame, measure: DataFrame | None = None, total: str | None = None) -> DataFrame:
    """1-based feed position inside the section; ``total`` names a column for the section's number of items."""
    return positions(df, SECTION, ["ordinal"], "item_index", measure=measure, total=total)


def newest_first(df: DataFrame, measure: DataFrame | None = None) -> DataFrame:
    """Position by publish time, newest first; no time counts as zero."""
    # Rows without a time are a class of their own, and do not set the ranges of the others.
    stamp = F.coalesce(F.col("publish_ts"), F.lit(0))
    keys = {"_late": F.signum(-stamp).cast("bigint"), "_age": -F.nullif(stamp, F.lit(0)).cast("bigint")}
    staged = df.withColumns({**keys, "_age": F.coalesce(keys["_age"], F.lit(0)), "_all": F.lit(0)})
    base = None if measure is None else measure.withColumns(keys)
    return positions(staged, ["_all"], ["_late", "_age", "ordinal"], "position", exact=["_late"], measure=base).drop("_late", "_age", "_all")


def section_limit(section: Column) -> Column:
    return F.when(section.eqNullSafe(F.lit(rules.OTHER_SECTION)), rules.ACCOUNT_LIMIT).otherwise(rules.SECTION_LIMIT)


def topk_per_section(df: DataFrame, by: Sequence[str] = SECTION) -> DataFrame:
    """Best items of each section by score: 4, or 5 for other accounts; placeholders excluded.

    The literal outer bound prunes each map partition to its own best rows before the shuffle.
    """
    title = strip(text_or_empty(F.col("title")))
    real = df.where((title != "") & (title != rules.PLACEHOLDER_TITLE))
    widest = max(rules.SECTION_LIMIT, rules.ACCOUNT_LIMIT)
    ranked = top_k(real, by, [F.col("score").desc(), F.col("ordinal")], widest, rank="rank")
    return ranked.where(F.col("rank") <= section_limit(F.col("section")))


def _flag(df: DataFrame, head: DataFrame, reason: Column, key: str = "notice_id") -> DataFrame:
    """Every row with keep/drop, given the (small) table of selected keys."""
    chosen = head.select(F.col(key).alias("_chosen"))
    joined = df.join(chosen, F.col(key) == F.col("_chosen"), "left")
    is_kept = F.col("_chosen").isNotNull()
    return decide(joined, is_kept, F.when(is_kept, "selected_for_final_markdown").otherwise(reason), "section_filter").drop("_chosen")


def latest_events_topk(df: DataFrame, clock: Clock, k: int = rules.SECTION_LIMIT) -> DataFrame:
    """Reports: expired ones out, latest date first, undated last; ``k`` per section stay."""
    judged = expired_event(df, clock).withColumnRenamed("reason", "_expiry").drop("stage")
    open_items = judged.where(F.col("keep")).withColumn("_at", first_stamp_eod(F.col("content")))
    head = top_k(
        open_items.select("notice_id", "section", "ordinal", "_at"),
        SECTION, [F.col("_at").desc_nulls_last(), F.col("ordinal")], k,
    )
    reason = F.when(F.col("_expiry") == "expired_physics_event", F.col("_expiry")).otherwise("max_items_per_section")
    return _flag(judged.drop("keep"), head, reason).drop("_expiry", "event_at")


def first_n(df: DataFrame) -> DataFrame:
    """Feed order: 5 of the other accounts, 4 elsewhere."""
    widest = max(rules.SECTION_LIMIT, rules.ACCOUNT_LIMIT)
    head = top_k(df.select("notice_id", "section", "ordinal"), SECTION, [F.col("ordinal")], widest, rank="rank")
    head = head.where(F.col("rank") <= section_limit(F.col("section")))
    reason = F.when(F.col("section").eqNullSafe(F.lit(rules.OTHER_SECTION)), "max_wechat_items").otherwise(
        "fallback_max_items_per_section"
    )
    return _flag(df, head, reason)


def section_selection(df: DataFrame, clock: Clock, by: Sequence[str] = SECTION) -> DataFrame:
    """The final cut of a digest: reports by date, everything else by feed order.

    Rows travel whole through one bounded rank, so the input is read once.
    """
    is_report = F.col("section").eqNullSafe(F.lit(rules.REPORT_SECTION))
    expired = is_report & event_expired(F.col("content"), clock)
    placed = df.where(~expired).withColumn("_at", F.when(is_report, first_stamp_eod(F.col("content"))))
    widest = max(rules.SECTION_LIMIT, rules.ACCOUNT_LIMIT)
    head = top_k(placed, by, [F.col("_at").desc_nulls_last(), F.col("ordinal")], widest, rank="rank")
    return head.where(F.col("rank") <= section_limit(F.col("section"))).drop("_at")
