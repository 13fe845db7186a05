"""Academic report pages to labelled report notices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.basics import non_empty, strip, text_or_empty
from bulletin.functions.dates import inline_date
from bulletin.functions.text import json_block, labelled_field, report_summary, report_text
from bulletin.operators.decisions import kept
from bulletin.operators.filters import report_classifier

REPORT_FIELDS = "struct<title:string, speaker:string, time:string, location:string, summary:string>"


def report_fields(df: DataFrame) -> DataFrame:
    """Fields of a report: the model's where it gave one, else the labelled ones of the text.

    Reads ``title``, ``content``, ``url`` and the optional model reply ``raw``.
    """
    model = F.from_json(json_block(F.col("raw")), REPORT_FIELDS)
    given = lambda name: non_empty(strip(model[name]))
    content = F.col("content")
    return df.withColumns(
        {
            "report_title": F.coalesce(given("title"), F.col("title")),
            "speaker": F.coalesce(given("speaker"), labelled_field(content, rules.SPEAKER_LABELS)),
            "event_time": F.coalesce(given("time"), labelled_field(content, rules.TIME_LABELS)),
            "location": F.coalesce(given("location"), labelled_field(content, rules.PLACE_LABELS)),
            "model_summary": text_or_empty(given("summary")),
            "original_summary": report_summary(content),
            "publish_date": text_or_empty(
                F.coalesce(non_empty(inline_date(content)), non_empty(inline_date(F.col("title"))))
            ),
        }
    )


def build_report(df: DataFrame) -> DataFrame:
    """Labelled body: dates, place, speaker, link, then the abstract (or the text itself)."""
    f = report_fields(df)
    line = lambda label, c: F.concat(F.lit(label), non_empty(F.col(c)))
    tail = F.coalesce(
        line("内容摘要：", "original_summary"),
        line("报告摘要：", "model_summary"),
        F.substring(text_or_empty(F.col("content")), 1, rules.REPORT_SUMMARY_CHARS),
    )
    body = F.concat_ws(
        "\n\n",
        line("发布日期: ", "publish_date"),
        line("报告时间: ", "event_time"),
        line("报告地点: ", "location"),
        line("报告人: ", "speaker"),
        F.concat(F.lit("链接: "), text_or_empty(F.col("url"))),
        F.lit(""),
        tail,
    )
    return f.withColumn("body", strip(body))


def report_job(df: DataFrame) -> DataFrame:
    """Page texts to report notices: repaired and trimmed, filtered to reports, labelled."""
    staged = df if "raw" in df.columns else df.withColumn("raw", F.lit(None).cast("string"))
    trimmed = staged.withColumn("content", report_text(F.col("content"), F.col("title")))
    return build_report(kept(report_classifier(trimmed)))
