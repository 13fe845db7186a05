"""The weekly run from notices to printed sections, with its decision log from the same pass."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.dates import RunClock, inline_date
from bulletin.functions.text import item_summary, raw_clean, title_key
from bulletin.operators.decisions import LOG_COLUMNS, decide, decisions, event_records, through
from bulletin.operators.joins import apply_scores
from bulletin.operators.model import digest_summary_response, gated_clean, score_responses, selection_responses
from bulletin.operators.ranking import item_index, section_selection, topk_per_section
from bulletin.operators.rows import settle
from bulletin.operators.scoring import bounded, with_score_bounds
from bulletin.operators.sections import fallback_issue, placed_sections
from bulletin.operators.shorten import shorten
from bulletin.operators.temporal import event_expired, publish_recency, temporal_relevance
from bulletin.plans.render import render_digest


@dataclass(frozen=True)
class Replies:
    """Model replies as tables; what is absent is decided by rules.

    ``scores`` and ``selections`` have (section, raw), by the item index among the recent
    notices and among the candidates of the final cut; ``cleaned`` and ``summaries`` have
    (notice_id, raw).
    """

    scores: DataFrame | None = None
    selections: DataFrame | None = None
    cleaned: DataFrame | None = None
    summaries: DataFrame | None = None


@dataclass(frozen=True)
class IssueRun:
    """``sections``: one text per section. ``log``: one record per notice, and those of sections and feeds."""

    sections: DataFrame
    records: Callable[[], DataFrame]

    @property
    def log(self) -> DataFrame:
        return self.records()


def already_printed(df: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """Flag titles of earlier issues; ``earlier`` has (title)."""
    if earlier is None:
        return decide(df, F.lit(True), F.lit("not_printed_before"), "previous_issue")
    seen = earlier.select(title_key(F.col("title")).alias("_key")).where(F.col("_key") != "").distinct().withColumn("_seen", F.lit(True))
    joined = df.withColumn("_key", title_key(F.col("title"))).join(seen, "_key", "left")
    new = F.col("_seen").isNull()
    return decide(joined, new, F.when(new, "not_printed_before").otherwise("in_previous_issue"), "previous_issue").drop("_key", "_seen")


def _judged_notices(notices: DataFrame, clock: RunClock, earlier: DataFrame | None, clean: bool) -> DataFrame:
    """Narrow rows of all notices: the decision on each, and of the live ones the points and their bounds."""
    judged = through(notices, lambda df: publish_recency(df, clock).drop("basis"), lambda df: already_printed(df, earlier))
    body = raw_clean(F.col("content")) if clean else F.col("content")
    read = judged.withColumn("content", F.when(F.col("keep"), body)).withColumnRenamed("reason", "why")
    described = [c for c in LOG_COLUMNS if c in notices.columns]
    carry = dict.fromkeys(["notice_id", "ordinal", "section", "title", *described])
    return with_score_bounds(read, clock).select(*carry, "keep", "why", "stage", "score", "reason", "low", "high", "tags")


def _cut(candidates: DataFrame, clock: RunClock, selections: DataFrame | None) -> DataFrame:
    """(notice_id, rank) of what the final cut keeps."""
    if selections is None:
        return section_selection(candidates, clock).select("notice_id", "rank")
    over = F.col("section").eqNullSafe(F.lit(rules.REPORT_SECTION)) & event_expired(F.col("content"), clock)
    ruled = F.col("section").eqNullSafe(F.lit(rules.REPORT_SECTION)) | F.col("section").eqNullSafe(F.lit(rules.OTHER_SECTION))
    picked = selection_responses(item_index(candidates.where(~ruled & ~over).select("notice_id", "section", "ordinal")), selections)
    own = section_selection(candidates.where(ruled), clock)
    return picked.select("notice_id", F.col("pick").cast("int").alias("rank")).unionByName(own.select("notice_id", F.col("rank").cast("int").alias("rank")))


def issue_run(
    notices: DataFrame, sections: DataFrame, clock: RunClock, replies: Replies = Replies(), earlier: DataFrame | None = None,
    errors: DataFrame | None = None, clean: bool = True, time: str = "", brand: str = "", explain: bool = True,
) -> IssueRun:
    """Rank, select, filter by time, cut, shorten and render; every notice leaves one record.

    The texts of all notices are parsed once, into settled narrow rows: rankings, section
    lists and the log read those. Only the few selected notices are read again, by id.

    ``errors`` (stage, error, stage_ord) become records; a run without any notice prints the
    explanatory issue instead, if it is to ``explain`` itself. Every listed section and every
    section of the notices is printed; one that no item reaches has the lead for empty sections.
    """
    judged = settle(_judged_notices(notices, clock, earlier, clean))
    alive = judged.where("keep")
    if replies.scores is not None:
        alive = apply_scores(item_index(alive), score_responses(replies.scores)).drop("item_index")
    best = topk_per_section(bounded(alive)).select("notice_id", "score", "rank")

    # The selected notices with their texts: at most a handful per section.
    chosen = notices.join(best.select("notice_id"), "notice_id", "left_semi")
    chosen = chosen.withColumn("content", raw_clean(F.col("content")) if clean else F.col("content"))
    if replies.cleaned is not None:
        chosen = gated_clean(chosen, replies.cleaned).drop("accepted")
    in_time = temporal_relevance(chosen, clock, fallback=inline_date(F.col("content"))).drop("basis")
    timed = settle(in_time.withColumnRenamed("reason", "why"))
    candidates = timed.where("keep").drop("keep", "why", "stage")
    cut = _cut(candidates, clock, replies.selections)

    items = candidates.join(cut, "notice_id")
    if replies.summaries is not None:
        told = replies.summaries.select("notice_id", "raw")
        summary = digest_summary_response(F.col("raw"), item_summary(F.col("content")))
        items = items.join(told, "notice_id", "left").withColumn("summary", summary).drop("raw")
    texts = render_digest(shorten(items), placed_sections(judged, sections))
    if errors is None:
        errors = notices.sparkSession.createDataFrame([], "stage string, error string, stage_ord int")
    return IssueRun(_or_fallback(texts, judged, errors, brand) if explain else texts, lambda: _log(judged, best, timed, cut, texts, errors, clock, time))


def _or_fallback(texts: DataFrame, judged: DataFrame, errors: DataFrame, brand: str) -> DataFrame:
    # `judged` is settled, so whether it is empty costs one look.
    if not judged.isEmpty():
        return texts
    text = F.concat_ws("\n\n", F.concat(F.lit("# "), F.col("section")), F.concat(F.lit("## "), F.col("title")), F.col("content"))
    return fallback_issue(judged, errors, brand).select("section", "section_ord", F.lit(0).cast("bigint").alias("items"), text.alias("text"))


def _log(judged: DataFrame, best: DataFrame, timed: DataFrame, cut: DataFrame, texts: DataFrame, errors: DataFrame, clock: RunClock, time: str) -> DataFrame:
    """One record per notice: of the filter that dropped it, the ranking, the time filter, or the final cut."""
    selected = best.select("notice_id", F.lit(True).alias("_best"))
    late = timed.select(
        "notice_id", F.col("keep").alias("_in_time"), F.col("why").alias("_time_why"),
        (F.col("section").eqNullSafe(F.lit(rules.REPORT_SECTION)) & event_expired(F.col("content"), clock)).alias("_over"),
    )
    printed = cut.select("notice_id", F.lit(True).alias("_printed"))
    # All three are a few rows per section, whatever the number of notices.
    rows = judged.join(selected, "notice_id", "left").join(late, "notice_id", "left").join(printed, "notice_id", "left")
    title = F.trim(F.coalesce("title", F.lit("")))
    is_card = (title == "") | (title == rules.PLACEHOLDER_TITLE)
    other, report = (F.col("section").eqNullSafe(F.lit(s)) for s in (rules.OTHER_SECTION, rules.REPORT_SECTION))
    over_limit = F.when(F.col("_over"), "expired_physics_event").when(other, "max_wechat_items").when(report, "max_items_per_section")
    end = (
        F.when(~F.col("keep"), F.struct(F.col("why").alias("reason"), F.col("stage").alias("stage")))
        .when(F.col("_best").isNull(), F.struct(F.when(is_card, "placeholder").otherwise("below_section_best").alias("reason"), F.lit("ranked_selection").alias("stage")))
        .when(~F.col("_in_time"), F.struct(F.col("_time_why").alias("reason"), F.lit("temporal_filter").alias("stage")))
        .when(F.col("_printed").isNull(), F.struct(over_limit.otherwise("fallback_max_items_per_section").alias("reason"), F.lit("section_filter").alias("stage")))
        .otherwise(F.struct(F.lit("selected_for_final_markdown").alias("reason"), F.lit("section_filter").alias("stage")))
    )
    scored = F.when(F.col("keep"), F.create_map(F.lit("id"), F.col("notice_id").cast("string"), F.lit("tags"), F.array_join("tags", ","))).otherwise(
        F.create_map(F.lit("id"), F.col("notice_id").cast("string"))
    )
    ended = rows.withColumns({"_end": end, "status": F.when(F.coalesce("_printed", F.lit(False)), "kept").otherwise("dropped")})
    log = decisions(ended.drop("reason", "stage").select("*", "_end.reason", "_end.stage"), scored, time)
    empty = event_records(texts.where("items = 0").select("section"), "empty", "no_item_printed", "render_digest", time)
    known = F.coalesce(F.col("error"), F.lit(""))
    broken = event_records(errors.where(known != "").select("error", F.col("stage").alias("source")), "error", F.col("error"), "crawl", time)
    return log.unionByName(empty).unionByName(broken)
