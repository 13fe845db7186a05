"""Time the headline queries on local Spark and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_QUERIES
(comma-separated, or "all") select what runs. Every query is executed whole into the
no-op sink; the first, untimed query starts the JVM and the Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from bulletin.plans.catalog import QUERIES
from bulletin.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

HEADLINE = [
    "read_digest_items", "normalize_articles", "extract_main_content", "explode_links", "tables_to_rows", "html_to_text",
    "publish_recency", "temporal_relevance", "extract_signals", "distinct_signals", "keyword_rules", "copy_decision",
    "dedupe_articles", "dedupe_urls", "merge_by_title", "decision_summary", "example_digest",
    "rule_score", "score_guardrails", "rank_in_section", "topk_per_section", "latest_events_topk", "newest_first",
    "canonical_url", "clean_markdown", "repair_mojibake", "clip_units", "compress_body", "fit_field", "build_report",
    "ranking_requests", "score_responses", "scored_items", "gated_clean", "render_ranked", "render_digest",
    "classify_lines", "render_cards", "full_issue", "account_feed", "refilter_issue",
    "full_issues", "issue_run", "issue_log", "ingest_articles", "decision_log", "issue_memory", "section_samples", "resumed_calls",
]


def in_many_files(spark: SparkSession, sf_dir: str, files: int) -> str:
    """A copy of the tables in as many files as cores, made before any timing.

    The test tables are single row groups, which one core reads alone; a table of any size
    comes in many splits, and the queries themselves never redistribute a scan.
    """
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("OFF")
    label, sf_dir = os.path.basename(sf_dir.rstrip("/")), in_many_files(spark, sf_dir, int(cpus))
    QUERIES["text_units"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    QUERIES["decode_pages"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "notice digest queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": label,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
