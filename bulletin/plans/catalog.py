"""The query catalog: every operator run over whole driver tables.

Each entry takes (spark, sf_dir). Times leave as ISO text and arrays as joined text,
so that any engine can compare the results.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions import dates as D
from bulletin.functions import html as H
from bulletin.functions import text as X
from bulletin.functions import urls as U
from bulletin.functions.basics import find_all
from bulletin.operators import decisions as dec
from bulletin.operators import feeds as feed_runs
from bulletin.operators import issues as issue_rows
from bulletin.operators import calls, dedup, filters, headings, joins, memory, model, pages, ranking, reports, scoring, sections, temporal
from bulletin.plans import inputs as I
from bulletin.plans import issue, render
from bulletin.plans import run as runs
from bulletin.plans.inputs import table
from bulletin.session import checkpoint_dir
from bulletin.sources import decision_log as logs
from bulletin.sources import digest, feeds, issue_files as stored, sinks
from bulletin.streaming import ingest as stream

CLOCK = D.RunClock.of(I.RUN_DATE)
EVENT_CLOCK = D.RunClock.of("2024-01-22")
ISSUE_SECTIONS = ["教务通知", "物理系学术报告", "图书馆信息", "家园网信息", "其他公众号信息", "学生会信息"]
PAGE_TRACKING = ["ref", "utm_source"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def on(view_sql: str) -> Callable[[Callable[[DataFrame], DataFrame]], Query]:
    """Register a query that reads one view."""

    def register(fn: Callable[[DataFrame], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(I.view(spark, sf_dir, view_sql))

        run.__name__ = fn.__name__
        return query(run)

    return register


def judged(df: DataFrame, *more) -> DataFrame:
    return df.select("notice_id", "keep", "reason", *more)


def issue_sections(spark: SparkSession) -> DataFrame:
    return sections.section_table(spark, ISSUE_SECTIONS)


def with_model_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices with the answer of the label table, where it has one."""
    notices = I.view(spark, sf_dir, I.NOTICES)
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("notice_id"), (F.col("quality") == 1).alias("model_keep")
    )
    return notices.join(labels, "notice_id", "left").withColumn("snippet", F.col("content"))


# --- sources and sinks -------------------------------------------------------


@on(I.DIGESTS)
def read_digest_items(docs: DataFrame) -> DataFrame:
    return digest.read_digest_items(docs, "doc_id")


@on(I.FEEDS)
def normalize_articles(raw: DataFrame) -> DataFrame:
    return feeds.normalize_articles(raw, site="https://mp.example.com").select(
        "feed_id", "ordinal", "account_keyword", "title", "url", "digest", "publish_ts", "aid", "mid", "idx"
    )


@on(I.ACCOUNT_CANDIDATES)
def top1_account(candidates: DataFrame) -> DataFrame:
    return feeds.top1_account(candidates)


@query
def decode_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "pages").select(
        "page_id", F.encode("html", "UTF-8").alias("raw"), F.lit("text/html; charset=utf-8").alias("content_type")
    )
    return pages.decode_pages(stored).select("page_id", "html")


@query
def extract_main_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", H.main_content(F.col("html")).alias("main_html"))


@on(I.PAGE_META)
def extract_page_meta(stored: DataFrame) -> DataFrame:
    return stored.select(
        "page_id", H.page_publish_time(F.col("html")).alias("publish_time"), H.page_author(F.col("html")).alias("author")
    )


@query
def explode_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.explode_links(table(spark, sf_dir, "pages"))


@query
def payload_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The page lies in a list below an unknown key; a key that looks like markup never counts.
    inner = F.array(F.struct(F.col("url"), F.col("html").alias("page")))
    payload = F.to_json(F.struct(F.lit("ok").alias("<msg>"), F.lit("plain").alias("text"), F.struct(inner.alias("pages")).alias("data")))
    stored = table(spark, sf_dir, "pages").select("page_id", payload.alias("raw"))
    return stored.select("page_id", H.html_string("raw").alias("html"))


@on(I.OCR_REPLIES)
def ocr_payload_text(replies: DataFrame) -> DataFrame:
    return replies.select("conv_id", "turn", pages.ocr_text(F.col("raw")).alias("text"))


@query
def event_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.event_listing(I.view(spark, sf_dir, I.HALL_PAGES, deal="c_custkey"))


@on(I.FEED_GROUPS)
def first_nonempty_feed(rows: DataFrame) -> DataFrame:
    return sections.first_nonempty_feed(rows)


@on(I.PREFERENCES)
def load_preferences(docs: DataFrame) -> DataFrame:
    return digest.load_preferences(docs, "doc_id").select("doc_id", "section", "title", "score", "reason")


SAMPLED = ["教务通知", "图书馆信息", "家园网信息", "物理系学术报告"]


@on(I.TENDENCIES)
def section_blocks(docs: DataFrame) -> DataFrame:
    return headings.section_blocks(docs, SAMPLED, "doc_id")


@on(I.TENDENCIES)
def section_samples(docs: DataFrame) -> DataFrame:
    return headings.section_samples(docs, SAMPLED, "doc_id").drop("item_ord")


@on(I.TENDENCIES)
def sample_digest(docs: DataFrame) -> DataFrame:
    return headings.sample_digest(docs, SAMPLED, "doc_id")


@query
def issue_ts_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(
        F.lit("/data/out/"), F.when(F.col("o_orderkey") % 5 == 0, "other").otherwise("issue"), F.lit("_"),
        F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), F.when(F.col("o_orderkey") % 7 == 0, "2561").otherwise("0830"),
        F.when(F.col("o_orderkey") % 2 == 0, "_raw").otherwise(""), F.lit(".md"),
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", D.iso_minute(digest.issue_ts_from_path(path, "issue")).alias("issue_ts")
    )


@query
def write_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{checkpoint_dir(spark)}/bulletin-decisions-{uuid.uuid4().hex}"
    filtered = temporal.publish_recency(I.view(spark, sf_dir, I.NOTICES), CLOCK)
    sinks.write_decisions(dec.decisions(filtered), target, I.RUN_DATE)
    back = spark.read.schema("section string, title string, status string, reason string, stage string, run_date date").json(target)
    return back.groupBy("section", "status", "reason").agg(F.count(F.lit(1)).alias("records"))


@query
def write_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{checkpoint_dir(spark)}/bulletin-items-{uuid.uuid4().hex}"
    sinks.write_items(I.view(spark, sf_dir, I.NOTICES).select("notice_id", "section", "title", "content"), target)
    return spark.read.schema("notice_id bigint, section string, title string, content string").json(target)


@query
def decision_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is written twice and another one: each record once, in all its columns."""
    target = f"{checkpoint_dir(spark)}/bulletin-log-{uuid.uuid4().hex}"
    filtered = temporal.publish_recency(I.view(spark, sf_dir, I.NOTICES), CLOCK).withColumns(
        {
            "date": F.col("publish_date"), "source": F.col("account"),
            "url": F.concat(F.lit("https://e.com/"), F.col("notice_id").cast("string")),
        }
    )
    log = dec.decisions(filtered, F.create_map(F.lit("basis"), "basis", F.lit("id"), F.col("notice_id").cast("string")), "2026-04-20 00:00")
    for run, part in (("weekly", log.where("status = 'kept'")), ("weekly", log), ("kept only", log.where("status = 'kept'"))):
        logs.commit_decisions(part, target, run)
    back = logs.read_decisions(spark, target)
    return back.withColumns({"basis": F.col("details")["basis"], "id": F.col("details")["id"].cast("bigint")}).drop("details")


@query
def issue_file_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests stored as files, one of them per document; some cannot be read."""
    folder = f"{checkpoint_dir(spark)}/bulletin-files-{uuid.uuid4().hex}"
    n = F.col("doc_id")
    day = F.date_format(F.date_add(F.lit("2026-03-01").cast("date"), (n % 60).cast("int")), "yyyyMMdd")
    name = F.concat(F.lit("d"), (n % 7).cast("string"), F.lit("/"), n.cast("string"), F.lit("/issue_"), day, F.lit("_0830_raw.md"))
    data = F.concat(F.encode("text", "UTF-8"), F.when(n % 50 == 7, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit(""))))
    sinks.write_named_files(I.view(spark, sf_dir, I.DIGESTS).select(name.alias("name"), data.alias("data")), folder)
    recent = stored.read_issue_files(spark, folder).where(F.col("issue_ts") >= D.ntz(CLOCK.cutoff))
    ident = F.regexp_extract("doc_path", r"/([0-9]+)/[^/]*\z", 1).cast("bigint")
    docs = recent.withColumn("doc_id", ident)
    items = digest.read_digest_items(docs.where("error IS NULL"), "doc_id")
    broken = docs.where("error IS NOT NULL").select("doc_id", F.lit("unreadable").alias("section"))
    return items.unionByName(broken, allowMissingColumns=True)


# --- filters -----------------------------------------------------------------


@query
def publish_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.publish_prefilter(table(spark, sf_dir, "events"), EVENT_CLOCK, column="ts").select(
        "event_id", "keep", "reason"
    )


@on(I.NOTICES)
def publish_recency(notices: DataFrame) -> DataFrame:
    return judged(temporal.publish_recency(notices, CLOCK), "basis")


@on(I.NOTICES)
def temporal_relevance(notices: DataFrame) -> DataFrame:
    out = temporal.temporal_relevance(notices, CLOCK, fallback=D.inline_date(F.col("content")))
    return judged(out, D.iso_minute(F.col("basis")).alias("basis"))


@on(I.NOTICES)
def keyword_rules(notices: DataFrame) -> DataFrame:
    return notices.select("notice_id", filters.keyword_rule(F.col("title"), F.col("content")).alias("decision"))


@query
def copy_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(filters.copy_decision(with_model_keep(spark, sf_dir)))


@query
def mark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(filters.mark_items(with_model_keep(spark, sf_dir), filter_on=True, fallback_keep=False))


@on(I.NOTICES)
def title_blacklist(notices: DataFrame) -> DataFrame:
    return judged(filters.title_blacklist(notices, words=["音乐会预热", "数据库"]))


@on(I.REPORTS)
def report_classifier(rows: DataFrame) -> DataFrame:
    return judged(filters.report_classifier(rows))


@on(I.REPORTS)
def report_keep(rows: DataFrame) -> DataFrame:
    return judged(filters.report_keep(rows.withColumn("decision", F.col("notice_id") % 3 == 0)))


@on(I.NOTICES)
def any_keyword(notices: DataFrame) -> DataFrame:
    return judged(filters.any_keyword(notices))


@on(I.NOTICES)
def label_equals(notices: DataFrame) -> DataFrame:
    label = F.when(F.col("notice_id") % 3 == 0, rules.OPENING_LABEL).when(F.col("notice_id") % 3 == 1, "其他")
    return judged(filters.label_equals(notices.withColumn("label", label)))


@query
def url_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.when(F.col("page_id") % 10 == 0, "").otherwise(F.col("url"))
    stored = table(spark, sf_dir, "pages").select(F.col("page_id").alias("notice_id"), url.alias("url"))
    return judged(filters.url_guard(stored, "example.com"))


@on(I.REPORTS)
def expired_event(rows: DataFrame) -> DataFrame:
    return judged(temporal.expired_event(rows, CLOCK), D.iso_minute(F.col("event_at")).alias("event_at"))


@on(I.DATE_TEXTS)
def older_than_cutoff(rows: DataFrame) -> DataFrame:
    return rows.select("notice_id", D.older_than_cutoff(F.col("text"), CLOCK).alias("older"))


@on(I.NOTICES)
def next_week_window(notices: DataFrame) -> DataFrame:
    return notices.select("notice_id", D.next_week_window(F.col("publish_date"), CLOCK).alias("in_window"))


@on(I.NOTICES)
def drop_placeholder(notices: DataFrame) -> DataFrame:
    n = F.col("notice_id")
    title = F.when(n % 11 == 0, rules.PLACEHOLDER_TITLE).when(n % 13 == 0, " ").otherwise(F.col("title"))
    return judged(filters.drop_placeholder(notices.withColumns({"title": title, "content": F.when(n % 7 != 0, F.col("content"))})))


# --- joins -------------------------------------------------------------------


@query
def accounts_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = feeds.top1_account(I.view(spark, sf_dir, I.ACCOUNT_CANDIDATES)).withColumn("account_ord", F.col("keyword_ord"))
    joined = joins.accounts_articles(accounts, I.view(spark, sf_dir, I.ARTICLES))
    return joined.select("keyword", "account_ord", "fakeid", "ordinal", "title")


@query
def previous_issue_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = I.view(spark, sf_dir, I.NOTICES)
    old = notices.where(F.col("notice_id") % 10 == 3).select(F.concat(F.lit("[ "), F.upper("title"), F.lit("]：")).alias("title"))
    return joins.previous_issue_anti(notices, old).select("notice_id", "title_key")


@query
def issue_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two issues, each without what the issues of the four weeks before it printed."""
    folder = f"{checkpoint_dir(spark)}/bulletin-history-{uuid.uuid4().hex}"
    notices = I.view(spark, sf_dir, I.NOTICES)
    for digit, day in ((3, "2026-04-13"), (4, "2026-04-06"), (5, "2026-02-02"), (6, "2026-03-23")):
        memory.remember(notices.where(F.col("notice_id") % 10 == digit), folder, day)
    issues = issue_rows.issue_table(spark, [D.RunClock.of("2026-04-13"), CLOCK])
    pairs = dec.kept(temporal.publish_recency(issue_rows.issue_notices(notices, issues), D.IssueClock()))
    seen = memory.remembered(memory.history(spark, folder), issues)
    return memory.drop_remembered(pairs, seen).select("issue_date", "notice_id", "title_key")


def _indexed_scores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    notices = I.view(spark, sf_dir, I.NOTICES)
    scored = notices.withColumns(
        {"score": scoring.rule_score(F.col("title"), F.col("content")), "reason": F.lit(rules.BASE_SCORE_REASON)}
    )
    return ranking.item_index(scored, measure=notices), model.score_responses(I.view(spark, sf_dir, I.SCORE_REPLIES))


@query
def apply_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, replies = _indexed_scores(spark, sf_dir)
    return joins.apply_scores(items, replies).select("notice_id", "section", "item_index", "score", "reason")


@query
def section_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.section_leads(issue_sections(spark), I.view(spark, sf_dir, I.NOTICES)).select("section", "items", "lead")


def _preference_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = I.view(spark, sf_dir, I.NOTICES)
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "notice_id")
    return notices.join(labels, "notice_id").select(
        "section", "title", "ordinal",
        (F.col("quality") * 60 + F.col("toxic") * 7).cast("int").alias("score"),
        F.when(F.col("toxic") == 1, "不当").otherwise("").alias("reason"),
    )


@query
def section_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = joins.example_digest(_preference_rows(spark, sf_dir))
    spaced = F.concat(F.substring("section", 1, 2), F.lit(" "), F.substring("section", 3, 20))
    notices = I.view(spark, sf_dir, I.NOTICES).select("notice_id", spaced.alias("section"))
    return joins.section_preferences(notices, samples).select(
        "notice_id", F.length("examples").alias("example_chars"), F.md5(F.encode("examples", "UTF-8")).alias("example_md5")
    )


@query
def image_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = I.view(spark, sf_dir, I.NOTICES)
    marked = notices.select(
        "notice_id", F.concat(F.lit("[[IMG_OCR_1]]\n\n\n\n"), "content", F.lit("\n[[IMG_OCR_2]]中[[IMG_OCR_3]]末")).alias("content")
    )
    n = F.col("notice_id")
    kind = lambda i: F.when((n + i) % 4 == 0, "TABLE").when((n + i) % 4 == 1, "QRCODE").otherwise("OTHER")
    notes = F.array(
        *[
            F.struct(
                F.lit(i).alias("idx"), F.concat(F.lit("https://e.com/"), n.cast("string"), F.lit(f"_{i}.png")).alias("url"),
                F.when((n + i) % 5 == 0, " ").otherwise(F.concat(F.lit(" 图文 "), n.cast("string"))).alias("ocr_text"), kind(i).alias("type"),
            )
            for i in (1, 2)
        ]
    )
    images = notices.select("notice_id", F.explode(notes).alias("i")).select("notice_id", "i.*")
    return joins.image_annotations(marked, images).select("notice_id", "content")


@query
def stage_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = spark.createDataFrame([*rules.STAGE_SECTIONS, ("crawl_lib", "新清华学堂")], "stage string, section string")
    # The whole notice table has every section but the one of the failed hall feed.
    return sections.stage_errors(I.view(spark, sf_dir, I.NOTICES), I.view(spark, sf_dir, I.STAGE_ERRORS), stages)


# --- dedup -------------------------------------------------------------------


@on(I.ARTICLES)
def dedupe_articles(articles: DataFrame) -> DataFrame:
    twice = [articles.withColumn("ordinal", F.struct(F.lit(copy).alias("copy"), F.col("ordinal").alias("at"))) for copy in (0, 1)]
    return dedup.dedupe_articles(twice[0].unionByName(twice[1])).select(F.col("ordinal.at").alias("ordinal"), "dedupe_key")


@on(I.ARTICLES)
def dedupe_urls(articles: DataFrame) -> DataFrame:
    url = F.when(F.col("notice_id") % 50 != 0, F.concat(F.lit("https://e.com/"), (F.col("notice_id") % 30).cast("string")))
    return judged(dedup.dedupe_urls(articles.withColumn("url", url)))


@on(I.HALL)
def merge_by_title(rows: DataFrame) -> DataFrame:
    return dedup.merge_by_title(rows).select("title", "n_dates", "location", "price", "absolute_src")


@on(I.HALL)
def title_dates(rows: DataFrame) -> DataFrame:
    return dedup.title_dates(rows)


@on(I.HALL)
def event_blocks(rows: DataFrame) -> DataFrame:
    return render.event_blocks(dedup.merge_by_title(rows), dedup.title_dates(rows))


@on(I.HALL)
def duplicate_titles(rows: DataFrame) -> DataFrame:
    return dedup.duplicate_titles(rows).select("ordinal", "keep", "reason")


@on(I.NOTICES)
def distinct_signals(notices: DataFrame) -> DataFrame:
    signals = temporal.with_signals(notices, CLOCK, fallback=D.inline_date(F.col("content")))
    return temporal.distinct_signals(signals).select(
        "notice_id", "kind", "raw", D.iso_minute(F.col("parsed")).alias("parsed"), "context"
    )


# --- aggregation -------------------------------------------------------------


@on(I.DECISION_LOG)
def decision_summary(log: DataFrame) -> DataFrame:
    return dec.decision_summary(log)


@on(I.NOTICES)
def latest_signal(notices: DataFrame) -> DataFrame:
    latest = temporal.latest_signals(temporal.with_signals(notices, CLOCK))
    return latest.select("notice_id", *[D.iso_minute(F.col(k)).alias(k) for k in ("deadline", "event", "publish")])


@query
def example_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.example_digest(_preference_rows(spark, sf_dir))


@query
def visible_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.visible_counts(filters.mark_items(with_model_keep(spark, sf_dir), filter_on=True), "account")


@query
def section_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = I.view(spark, sf_dir, I.ARTICLES)
    filed = articles.withColumn("section", scoring.account_section(*map(F.col, ("account", "title", "digest", "content"))))
    return sections.section_buckets(filed, sections.section_table(spark, [*rules.ACCOUNT_SECTIONS, "空栏目"]))


# --- ranking -----------------------------------------------------------------


def _scored(notices: DataFrame) -> DataFrame:
    return scoring.with_rule_score(notices, CLOCK)


@on(I.NOTICES)
def rank_in_section(notices: DataFrame) -> DataFrame:
    return ranking.rank_in_section(_scored(notices)).select("notice_id", "section", "score", "rank")


@on(I.NOTICES)
def topk_per_section(notices: DataFrame) -> DataFrame:
    title = F.when(F.col("notice_id") % 9 == 0, rules.PLACEHOLDER_TITLE).otherwise(F.col("title"))
    return ranking.topk_per_section(_scored(notices.withColumn("title", title))).select("notice_id", "section", "score", "rank")


@on(I.REPORTS)
def latest_events_topk(rows: DataFrame) -> DataFrame:
    return judged(ranking.latest_events_topk(rows, CLOCK))


@on(I.NOTICES)
def first_n(notices: DataFrame) -> DataFrame:
    return judged(ranking.first_n(notices))


@on(I.ARTICLES)
def newest_first(articles: DataFrame) -> DataFrame:
    return ranking.newest_first(articles, measure=articles).select("notice_id", "publish_ts", "position")


@on(I.NOTICES)
def item_index(notices: DataFrame) -> DataFrame:
    kept = notices.where(~F.col("title").startswith("音乐会"))
    return ranking.item_index(kept, measure=notices).select("notice_id", "section", "item_index")


@query
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    variants = F.array(t, F.concat(F.lit("报告 "), t), F.substring(t, 1, 400), F.concat(F.lit("时间ÃÃ"), F.substring(t, 1, 100)))
    return table(spark, sf_dir, "documents").select("doc_id", X.best_candidate(variants).alias("best"))


# --- sets --------------------------------------------------------------------


@query
def union_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = I.view(spark, sf_dir, I.NOTICES).select("notice_id", "title", "section")
    of = lambda name: notices.where(F.col("section") == name)
    hall = I.view(spark, sf_dir, I.HALL).select(F.col("ordinal").alias("notice_id"), "title", "price")
    accounts = I.view(spark, sf_dir, I.ARTICLES).select("notice_id", "title", "url")
    feed_list = [
        ("info", of("教务通知")), ("myhome", of("家园网信息")), ("learn", None), ("lib", of("图书馆信息")), ("hall", hall),
        ("physics", of("物理系学术报告")), ("accounts", accounts), ("other", of("其他公众号信息")),
    ]
    return sections.union_feeds(feed_list).select("feed", "feed_ord", "notice_id", "title", "section", "price", "url")


def _five_feeds(spark: SparkSession, sf_dir: str) -> feed_runs.Collected:
    """Five feeds, one of them corrupt at its last row."""
    notices = I.view(spark, sf_dir, I.NOTICES).select("notice_id", "title", "section", "ordinal")
    of = lambda name: notices.where(F.col("section") == name)
    hall = I.view(spark, sf_dir, I.HALL)
    last = hall.agg(F.max("ordinal")).scalar()
    torn = F.when(F.col("ordinal") == last, F.raise_error(F.lit("连接超时"))).otherwise(F.col("title"))
    builders = {
        "crawl_info": lambda: of("教务通知"), "crawl_hall": lambda: hall.select(F.col("ordinal").alias("notice_id"), torn.alias("title")),
        "crawl_lib": lambda: of("图书馆信息"), "crawl_myhome": lambda: spark.read.parquet(f"{sf_dir}/no-such-feed.parquet"), "crawl_physics": lambda: of("物理系学术报告"),
    }
    return feed_runs.collect_feeds(spark, list(builders.items()))


@query
def collected_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the feeds that work, beside one record per feed that does not."""
    got = _five_feeds(spark, sf_dir)
    errors = got.errors.select(F.col("stage").alias("feed"), F.col("stage_ord").alias("feed_ord"), F.lit("error").alias("kind"))
    items = got.items.select("feed", "feed_ord", "notice_id", "title", "section", F.lit("item").alias("kind"))
    return items.unionByName(errors, allowMissingColumns=True)


@query
def section_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _five_feeds(spark, sf_dir)
    told = got.errors.withColumn("error", F.concat(F.lit("第"), F.col("stage_ord").cast("string"), F.lit("个来源")))
    stages = spark.createDataFrame(rules.STAGE_SECTIONS, "stage string, section string")
    return feed_runs.placeholders(got.items, told, stages, sections.section_table(spark))


@query
def complete_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = I.view(spark, sf_dir, I.NOTICES)
    return sections.complete_sections(notices, sections.section_table(spark))


@query
def fallback_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a run that found nothing, and of one that found the notices, which needs no such issue."""
    notices, errors = I.view(spark, sf_dir, I.NOTICES), I.view(spark, sf_dir, I.STAGE_ERRORS)
    runs = {"empty": notices.limit(0), "filled": notices}
    empty, filled = (sections.fallback_issue(found, errors, brand="周报").withColumn("run", F.lit(run)) for run, found in runs.items())
    return empty.unionByName(filled)


# --- scoring -----------------------------------------------------------------


@on(I.NOTICES)
def rule_score(notices: DataFrame) -> DataFrame:
    return notices.select("notice_id", scoring.rule_score(F.col("title"), F.col("content")).alias("score"))


@on(I.NOTICES)
def score_guardrails(notices: DataFrame) -> DataFrame:
    return _scored(notices).select("notice_id", "score", "reason", F.array_join("tags", ",").alias("tags"))


@on(I.NOTICES)
def expired_cap(notices: DataFrame) -> DataFrame:
    return scoring.expired_cap(notices).select("notice_id", "cap")


@on(I.NOTICES)
def all_dates_past(notices: DataFrame) -> DataFrame:
    return notices.select("notice_id", D.all_dates_past(F.col("content"), CLOCK).alias("past"))


@on(I.NOTICES)
def has_current_or_future_date(notices: DataFrame) -> DataFrame:
    return notices.select("notice_id", D.has_current_or_future_date(F.col("content"), CLOCK).alias("ahead"))


@on(I.DIGESTS)
def parse_embedded_score(docs: DataFrame) -> DataFrame:
    items = digest.read_digest_items(docs, "doc_id")
    return items.select(
        "doc_id", "section_ord", "item_ord",
        X.embedded_score(F.col("content")).alias("score"), X.without_score_lines(F.col("content")).alias("content"),
    )


@on(I.ARTICLES)
def section_classifier(articles: DataFrame) -> DataFrame:
    section = scoring.account_section(*map(F.col, ("account", "title", "digest", "content")))
    return articles.select("notice_id", section.alias("section"))


# --- dates -------------------------------------------------------------------


@on(I.RUNS)
def run_clock(runs: DataFrame) -> DataFrame:
    day = D.run_day(F.col("run_date"))
    return runs.select("run_id", day.alias("run_day"), D.iso_minute(day.cast("timestamp_ntz")).alias("now"))


@on(I.RUNS)
def issue_cutoff(runs: DataFrame) -> DataFrame:
    override = F.col("cutoff").cast("timestamp_ntz")
    return runs.select("run_id", D.iso_minute(D.issue_cutoff(D.run_day(F.col("run_date")), override)).alias("cutoff"))


@on(I.RUNS)
def issue_table(runs: DataFrame) -> DataFrame:
    issues = issue_rows.issues_of(runs.withColumn("cutoff", F.col("cutoff").cast("timestamp_ntz")), cutoff="cutoff")
    return issues.select("issue_date", D.iso_minute(F.col("issue_cutoff")).alias("cutoff"))


@on(I.DATE_TEXTS)
def parse_datetime_text(rows: DataFrame) -> DataFrame:
    return rows.select("notice_id", D.iso_minute(D.parse_datetime_text(F.col("text"), CLOCK)).alias("parsed"))


@on(I.DATE_TEXTS)
def parse_datetime_eod(rows: DataFrame) -> DataFrame:
    return rows.select("notice_id", D.iso_minute(D.parse_datetime_eod(F.col("text"))).alias("parsed"))


@on(I.NOTICES)
def extract_signals(notices: DataFrame) -> DataFrame:
    rows = temporal.signal_rows(temporal.with_signals(notices, CLOCK))
    return rows.select("notice_id", "line_no", "pos", "kind", "raw", D.iso_minute(F.col("parsed")).alias("parsed"), "context")


@on(I.NOTICES)
def extract_publish_date(notices: DataFrame) -> DataFrame:
    return notices.select("notice_id", D.publish_date_text(F.col("content")).alias("publish_text"))


@on(I.DATE_TEXTS)
def inline_date(rows: DataFrame) -> DataFrame:
    return rows.select("notice_id", D.inline_date(F.col("text")).alias("inline"))


@on(I.DATE_TEXTS)
def assemble_date(rows: DataFrame) -> DataFrame:
    year = F.when(F.col("notice_id") % 4 != 0, "2026").otherwise("")
    detail = F.concat(F.month("at").cast("string"), F.lit("月"), F.dayofmonth("at").cast("string"), F.lit("日 19:30"))
    return rows.select("notice_id", D.assemble_date(year, F.when(F.col("notice_id") % 9 == 0, "待定").otherwise(detail)).alias("date"))


@on(I.DATE_TEXTS)
def parse_epoch(rows: DataFrame) -> DataFrame:
    return rows.select("notice_id", D.parse_epoch(F.col("epoch_text")).alias("epoch"))


@on(I.ARTICLES)
def format_publish(articles: DataFrame) -> DataFrame:
    return articles.select("notice_id", D.format_publish(F.col("publish_ts"), F.col("publish_text")).alias("published"))


# --- text --------------------------------------------------------------------


@on(I.DIRTY)
def clean_markdown(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", X.clean_markdown(F.col("dirty")).alias("cleaned"))


@on(I.DIRTY)
def normalize_space(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", X.normalize_space(F.col("dirty")).alias("cleaned"))


@query
def sanitize_fragment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", H.sanitize_fragment(F.col("html")).alias("fragment"))


@on(I.DIGESTS)
def doc_headline(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", X.first_heading(F.col("text")).alias("headline"), X.first_plain_line(F.col("text")).alias("summary"))


@query
def strip_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", H.strip_tags(F.col("html")).alias("text"))


@on(I.PAGE_PARTS)
def html_to_text(stored: DataFrame) -> DataFrame:
    return pages.html_to_text(stored)


@on(I.PAGE_PARTS)
def tables_to_rows(stored: DataFrame) -> DataFrame:
    return pages.tables_to_rows(stored)


@on(I.DIRTY)
def strip_images(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", X.strip_images(F.col("dirty")).alias("cleaned"))


@on(I.PAGE_PARTS)
def extract_images(stored: DataFrame) -> DataFrame:
    return pages.extract_images(stored, site="https://mp.example.com").select("page_id", "idx", "image_url", "token")


@on(I.DIRTY)
def normalize_headings(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", X.normalize_headings(F.col("dirty"), F.col("title")).alias("body"))


@on(I.DIRTY)
def quality_score(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", X.quality_score(F.col("dirty")).alias("quality"))


@on(I.DIRTY)
def mojibake_score(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", X.mojibake_score(F.col("dirty")).alias("q")).select("doc_id", "q.*")


@query
def repair_mojibake(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Misread copies: the UTF-8 bytes of a CJK line seen as latin-1 characters.
    broken = F.decode(F.encode(F.lit("学术报告：时间地点"), "UTF-8"), "ISO-8859-1")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("\n", "text", broken, F.lit("正常行")).alias("text"))
    return rows.select("doc_id", X.repair_mojibake(F.col("text")).alias("text"))


@on(I.DIRTY)
def mojibake_audit(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.explode(X.broken_lines(F.col("dirty"))).alias("b")).select("doc_id", "b.*")


@on(I.REPORTS)
def trim_report_text(rows: DataFrame) -> DataFrame:
    return rows.select("notice_id", X.trim_report_text(F.col("content"), F.col("title")).alias("trimmed"))


@on(I.REPORTS)
def lecture_segment(rows: DataFrame) -> DataFrame:
    return rows.select("notice_id", X.lecture_segment(F.col("content")).alias("segment"))


@on(I.REPORTS)
def labelled_field(rows: DataFrame) -> DataFrame:
    field = lambda labels: X.labelled_field(F.col("content"), labels)
    return rows.select(
        "notice_id", field(rules.SPEAKER_LABELS).alias("speaker"), field(rules.TIME_LABELS).alias("event_time"),
        field(rules.PLACE_LABELS).alias("place"),
    )


@on(I.REPORTS)
def report_summary(rows: DataFrame) -> DataFrame:
    return rows.select("notice_id", X.report_summary(F.col("content")).alias("summary"))


def _report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = I.view(spark, sf_dir, I.REPORT_REPLIES)
    return I.view(spark, sf_dir, I.REPORTS).join(replies, "notice_id", "left")


@query
def build_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.build_report(_report_rows(spark, sf_dir)).select("notice_id", "report_title", "body")


@query
def text_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.text_units(F.col("text")).alias("units"))


@query
def clip_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.clip_units(F.col("text"), rules.SUMMARY_UNITS).alias("clipped"))


@on(I.REPORTS)
def compress_body(rows: DataFrame) -> DataFrame:
    staged = rows.withColumn("summary", X.item_summary(F.col("content")))
    return staged.select(
        "notice_id", X.compress_body(F.col("content"), F.col("summary"), F.col("section")).alias("body")
    )


@on(I.ARTICLES)
def fallback_summary(articles: DataFrame) -> DataFrame:
    return articles.select(
        "notice_id", X.feed_summary(F.col("digest"), F.col("content")).alias("feed_summary"),
        X.item_summary(F.col("content")).alias("digest_summary"),
    )


@query
def summary_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" "), X.item_summary(F.col("text")))).when(
        F.col("doc_id") % 3 == 1, "另写"
    ).otherwise("")
    return table(spark, sf_dir, "documents").select("doc_id", X.summary_repeats(summary, F.col("text")).alias("repeats"))


@on(I.ARTICLES)
def filter_snippet(articles: DataFrame) -> DataFrame:
    notes = F.when(F.col("notice_id") % 2 == 0, F.array(F.lit(" 图一 "), F.lit(""), F.lit("图二"))).otherwise(
        F.array().cast("array<string>")
    )
    return articles.select("notice_id", X.filter_snippet(F.col("digest"), F.col("content"), notes).alias("snippet"))


@on(I.ARTICLES)
def fit_field(articles: DataFrame) -> DataFrame:
    title = F.concat(F.lit("\\u901a\\u77e5 "), F.col("title"), F.lit("  关于本学期各项安排的详细通知与说明"), F.col("content"))
    n = F.col("notice_id")
    source = F.when(n % 3 == 0, F.col("url")).when(n % 3 == 1, "ftp://e.com/x").otherwise("https://")
    fields = {
        "title": X.fit_field(F.when(n % 10 == 0, " ").otherwise(title), "title", fallback="周报"),
        "author": X.fit_field(F.col("account"), "author"),
        "digest": X.fit_field(F.concat("digest", F.lit(" "), "content"), "digest", fallback="已整理"),
        "source_url": X.fit_field(source, "source_url"),
    }
    # Fitted once, then measured.
    fitted = articles.select("notice_id", *[c.alias(name) for name, c in fields.items()])
    sizes = {"chars": F.length, "bytes": F.octet_length}
    return fitted.select("*", *[size(name).alias(f"{name}_{unit}") for name in fields for unit, size in sizes.items()])


@on(I.MARKED_ISSUES)
def split_label(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    label, value = X.split_label(F.col("line"))
    return rows.select("doc_id", "n", label.alias("label"), value.alias("value"))


# --- urls --------------------------------------------------------------------


@on(I.LINKS)
def normalize_url(links: DataFrame) -> DataFrame:
    return links.select("notice_id", U.normalize_url(F.col("url"), "https://mp.example.com").alias("url"))


@on(I.LINKS)
def canonical_url(links: DataFrame) -> DataFrame:
    return links.select("notice_id", U.canonical_url(F.col("url")).alias("canonical"))


@query
def canonical_page_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", U.canonical_url(F.col("url"), PAGE_TRACKING).alias("canonical"))


@on(I.LINKS)
def set_query_param(links: DataFrame) -> DataFrame:
    bare = F.when(F.col("notice_id") % 5 == 0, F.split_part("url", F.lit("?"), F.lit(1))).otherwise(F.col("url"))
    return links.select("notice_id", U.set_query_param(bare, "lmid", "LM_JWGG").alias("url"))


@on(I.PAGE_PARTS)
def resolve_resource_urls(stored: DataFrame) -> DataFrame:
    made = pages.resolve_resource_urls(stored)
    return made.select("page_id", F.posexplode(find_all(F.col("html"), r'src="([^"]+)"', 1)).alias("pos", "src"))


# --- model tables ------------------------------------------------------------


@on(I.NOTICES)
def ranking_requests(notices: DataFrame) -> DataFrame:
    return model.ranking_requests(notices, measure=notices)


@on(I.SCORE_REPLIES)
def score_responses(replies: DataFrame) -> DataFrame:
    return model.score_responses(replies)


@query
def scored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, _ = _indexed_scores(spark, sf_dir)
    out = model.scored_items(items, I.view(spark, sf_dir, I.SCORE_REPLIES), CLOCK)
    return out.select("notice_id", "score", "reason")


@on(I.NOTICES)
def decision_requests(notices: DataFrame) -> DataFrame:
    staged = notices.withColumns({"snippet": F.col("content"), "date": D.inline_date(F.col("content"))})
    return model.decision_requests(staged, "筛选规则:")


@on(I.NOTICES)
def selection_requests(notices: DataFrame) -> DataFrame:
    return model.selection_requests(notices.withColumn("date", D.inline_date(F.col("content"))), measure=notices).drop("candidates")


@on(I.NOTICES)
def summary_requests(notices: DataFrame) -> DataFrame:
    return model.summary_requests(notices)


@on(I.NOTICES)
def clean_requests(notices: DataFrame) -> DataFrame:
    return model.clean_requests(notices)


@on(I.REPORTS)
def report_requests(rows: DataFrame) -> DataFrame:
    return model.report_requests(rows.withColumn("publish_date", D.inline_date(F.col("content"))))


@on(I.DECISION_REPLIES)
def decision_responses(replies: DataFrame) -> DataFrame:
    return model.decision_responses(replies).select("notice_id", "model_keep", "status", "reason")


@query
def selection_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = I.view(spark, sf_dir, I.NOTICES).select("notice_id", "section", "ordinal")
    items = ranking.item_index(notices)
    return model.selection_responses(items, I.view(spark, sf_dir, I.SELECTION_REPLIES)).select(
        "section", "notice_id", "item_index", "pick", "reason"
    )


@query
def summary_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("  摘要\n"), F.col("text"))).when(F.col("doc_id") % 3 == 0, "")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"), raw.alias("raw"))
    return model.summary_responses(rows).select("doc_id", "feed_summary", "digest_summary")


@query
def gated_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = I.view(spark, sf_dir, I.NOTICES)
    replies = notices.where(F.col("notice_id") % 3 != 0).select(
        "notice_id",
        F.when(F.col("notice_id") % 3 == 1, F.concat(F.lit("整理："), "content")).otherwise("整理要点").alias("raw"),
    )
    return model.gated_clean(notices, replies).select("notice_id", "accepted", "content")


@query
def report_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_fields(_report_rows(spark, sf_dir)).select(
        "notice_id", "report_title", "speaker", "event_time", "location", "model_summary", "publish_date"
    )


def _keyword_answer(prompts: list[str]) -> list[str | None]:
    """Stand-in for a provider: answers by the length of the prompt, sometimes not at all."""
    return [None if len(p) % 7 == 0 else ("YES" if len(p) % 2 else "NO") for p in prompts]


@on(I.NOTICES)
def model_call(notices: DataFrame) -> DataFrame:
    requests = notices.select("notice_id", F.concat(F.lit("标题: "), "title", F.lit("\n"), F.col("content")).alias("prompt"))
    return model.decision_responses(model.model_call(requests, _keyword_answer, "notice_id").drop("error"))


@query
def resumed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the notices are asked about, then all of them: what is answered is not asked again."""
    store = f"{checkpoint_dir(spark)}/bulletin-replies-{uuid.uuid4().hex}"
    n = F.col("notice_id")
    prompt = F.concat(F.lit("标题: "), F.col("title"), F.lit("\n"), F.col("content"))
    requests = I.view(spark, sf_dir, I.NOTICES).select("notice_id", prompt.alias("prompt"))
    calls.resumable_call(requests.where(n % 2 == 0), _keyword_answer, "notice_id", store, tasks=8)
    return calls.resumable_call(requests, _keyword_answer, "notice_id", store, tasks=8)


# --- rendering ---------------------------------------------------------------


@query
def render_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = I.view(spark, sf_dir, I.NOTICES)
    return render.render_ranked(ranking.rank_in_section(_scored(notices)), notices, issue_sections(spark))


@query
def render_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = issue.final_items(I.view(spark, sf_dir, I.NOTICES), CLOCK)
    return render.render_digest(items, issue_sections(spark))


@on(I.ARTICLES)
def render_articles(articles: DataFrame) -> DataFrame:
    staged = articles.withColumn("summary", F.when(F.col("notice_id") % 2 == 0, F.lit(" 一句话 ")).otherwise(""))
    return render.render_articles(staged).select("notice_id", "text")


@on(I.MARKED_ISSUES)
def classify_lines(docs: DataFrame) -> DataFrame:
    return render.classify_lines(docs).select("doc_id", "line_no", "kind", "label", "value")


@on(I.NOTICES)
def highlight_times(notices: DataFrame) -> DataFrame:
    return notices.select("notice_id", X.highlight_times(F.col("content")).alias("html"))


@on(I.MARKED_ISSUES)
def render_cards(docs: DataFrame) -> DataFrame:
    return render.render_cards(docs)


# --- whole runs --------------------------------------------------------------


@query
def full_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issue.full_issue(I.view(spark, sf_dir, I.NOTICES), issue_sections(spark), CLOCK)


def _issue_run(spark: SparkSession, sf_dir: str) -> runs.IssueRun:
    notices = I.view(spark, sf_dir, I.NOTICES).withColumn("source", F.col("account"))
    earlier = notices.where(F.col("notice_id") % 10 == 3).select("title")
    replies = runs.Replies(scores=I.view(spark, sf_dir, I.SCORE_REPLIES))
    return runs.issue_run(notices, issue_sections(spark), CLOCK, replies, earlier, I.view(spark, sf_dir, I.STAGE_ERRORS))


@query
def issue_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issue_run(spark, sf_dir).sections


@query
def issue_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _issue_run(spark, sf_dir).log
    return log.withColumns({"id": F.col("details")["id"].cast("bigint"), "tags": F.col("details")["tags"]}).drop("details", "time")


@query
def full_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = issue_rows.issue_table(spark, [D.RunClock.of(day) for day in I.RUN_DATES])
    return issue.full_issues(I.view(spark, sf_dir, I.NOTICES), issues, issue_sections(spark))


@on(I.NOTICES)
def issue_notices(notices: DataFrame) -> DataFrame:
    """How many notices each of three issues takes up, by the reason of its own clock."""
    issues = issue_rows.issue_table(notices.sparkSession, [D.RunClock.of(day) for day in I.RUN_DATES])
    judged_ = temporal.publish_recency(issue_rows.issue_notices(notices, issues), D.IssueClock())
    return judged_.where("keep").groupBy("issue_date", "section", "reason").agg(F.count(F.lit(1)).alias("notices"))


@query
def ranked_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issue.ranked_issue(I.view(spark, sf_dir, I.NOTICES), issue_sections(spark), CLOCK)


@query
def account_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issue.account_feed(I.view(spark, sf_dir, I.ARTICLES), CLOCK)


@on(I.ARTICLES)
def article_decisions(articles: DataFrame) -> DataFrame:
    """The log of the account feed, from the same pass as its items."""
    judged_ = issue.judged_articles(dedup.dedupe_articles(articles), CLOCK)
    log = dec.decisions(judged_.withColumnRenamed("account", "source"), F.create_map(F.lit("id"), F.col("notice_id").cast("string")))
    return log.select(F.col("details")["id"].cast("bigint").alias("notice_id"), "section", "title", "status", "reason", "stage", "url", "source")


@query
def ingest_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account feed in two arrivals that overlap: the second delivers everything again."""
    base = f"{checkpoint_dir(spark)}/bulletin-ingest-{uuid.uuid4().hex}"
    articles = dedup.dedupe_articles(I.view(spark, sf_dir, I.ARTICLES)).drop("dedupe_key")
    articles = articles.withColumn("fetched_at", F.lit(f"{I.RUN_DATE} 00:00:00").cast("timestamp"))
    for part in (articles.where(F.col("notice_id") % 3 != 0), articles):
        part.write.mode("append").parquet(f"{base}/landing")
        arriving = stream.landed(spark, f"{base}/landing", articles.schema)
        stream.ingest(arriving, f"{base}/out", f"{base}/progress", CLOCK).awaitTermination()
    items = stream.ingested_items(spark, f"{base}/out")
    return items.select("notice_id", "section", "publish_ts", F.md5(F.encode("content", "UTF-8")).alias("content_md5"))


@query
def refilter_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = digest.read_digest_items(I.view(spark, sf_dir, I.DIGESTS), "doc_id")
    place = F.struct("doc_id", "section_ord", "item_ord")
    staged = items.select(place.alias("notice_id"), "section", "title", "content", place.alias("ordinal"))
    return issue.refilter_issue(staged, issue_sections(spark), CLOCK)
