"""One convention for every filter.

A filter never drops rows. It adds ``keep`` (boolean), ``reason`` and ``stage``;
``kept`` selects the survivors and ``decisions`` projects the log, so both are read
from the same plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin.functions.basics import non_empty

LOG_COLUMNS = ["section", "title", "date", "url", "source"]


def decide(df: DataFrame, keep: Column, reason: Column, stage: str) -> DataFrame:
    return df.withColumns({"keep": keep, "reason": reason, "stage": F.lit(stage)})


def drop_when(df: DataFrame, drop: Column, reason: str, stage: str, kept_reason: str = "crawler_selected") -> DataFrame:
    drop = F.coalesce(drop, F.lit(False))
    return decide(df, ~drop, F.when(drop, F.lit(reason)).otherwise(F.lit(kept_reason)), stage)


def kept(df: DataFrame) -> DataFrame:
    return df.where(F.col("keep")).drop("keep", "reason", "stage")


def through(df: DataFrame, *stages: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Every row with the decision that ended its way: of the first filter that drops it, else of the last.

    One pass gives items (``kept``) and log (``decisions``), which then agree by construction.
    A filter can leave out work on rows that are already dropped by asking ``undropped()``.
    """
    out = df.withColumn("_end", F.struct(F.lit(True).alias("keep"), F.lit("").alias("reason"), F.lit("").alias("stage")))
    for stage in stages:
        now = F.struct("keep", "reason", "stage")
        out = stage(out).withColumn("_end", F.when(undropped(), now).otherwise(F.col("_end"))).drop("keep", "reason", "stage")
    return out.select("*", "_end.keep", "_end.reason", "_end.stage").drop("_end")


def undropped() -> Column:
    """Inside ``through``: no filter has dropped the row so far."""
    return F.col("_end.keep")


def decisions(df: DataFrame, details: Column | None = None, time: str = "") -> DataFrame:
    """Decision log rows of a filter; missing descriptive columns are empty. ``time`` is the run's, as text."""
    have = set(df.columns)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")
    empty_map = F.create_map().cast("map<string,string>")
    # A model's answer brings its own status, which may also be undecided.
    status = F.col("status") if "status" in have else F.when(F.col("keep"), "kept").otherwise("dropped")
    return df.select(
        F.lit(time).alias("time"),
        F.coalesce(non_empty(text("section")), F.lit("unknown")).alias("section"),
        text("title").alias("title"),
        status.alias("status"),
        F.col("reason"),
        F.col("stage"),
        text("date").alias("date"),
        text("url").alias("url"),
        text("source").alias("source"),
        (details if details is not None else empty_map).alias("details"),
    )


def event_records(df: DataFrame, status: str, reason: Column | str, stage: str, time: str = "", details: Column | None = None) -> DataFrame:
    """Log rows that no filter makes: items ``found``, sections left ``empty``, stages that ended in an ``error``."""
    named = F.lit(reason) if isinstance(reason, str) else reason
    return decisions(df.withColumns({"status": F.lit(status), "reason": named, "stage": F.lit(stage)}), details, time)


def decision_summary(log: DataFrame) -> DataFrame:
    """Counts of all records, per status, and per section by status and by reason, in one pass."""
    known = lambda c: F.coalesce(non_empty(F.col(c)), F.lit("unknown")).alias(c)
    rows = log.select(known("section"), known("status"), known("reason"))
    grouped = rows.groupingSets(
        [[], [F.col("status")], [F.col("section"), F.col("status")], [F.col("section"), F.col("reason")]],
        F.col("section"), F.col("status"), F.col("reason"),
    ).agg(
        F.grouping("section").alias("_gs"),
        F.grouping("status").alias("_gt"),
        F.grouping("reason").alias("_gr"),
        F.count(F.lit(1)).alias("records"),
    )
    level = (
        F.when((F.col("_gs") == 1) & (F.col("_gt") == 1), "total")
        .when(F.col("_gs") == 1, "status")
        .when(F.col("_gr") == 1, "section_status")
        .otherwise("section_reason")
    )
    return grouped.select(level.alias("level"), "section", "status", "reason", "records")
