"""Work on the level of sections and feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.basics import non_empty, strip, text_or_empty


def section_table(spark: SparkSession, names: Sequence[str] = tuple(rules.REQUIRED_SECTIONS)) -> DataFrame:
    """sections(section, section_ord) of a fixed list.

    Inline VALUES have an exact size, so the planner can see that broadcasting them is safe.
    """
    rows = ", ".join(f"(:s{i}, {i})" for i in range(1, len(names) + 1))
    args = {f"s{i}": name for i, name in enumerate(names, start=1)}
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(section, section_ord)", args=args)


def section_ord(names: Sequence[str], section: Column) -> Column:
    """Place of a section in a fixed order; unknown sections come last."""
    return F.coalesce(
        F.nullif(F.array_position(F.array(*[F.lit(n) for n in names]), section), F.lit(0)), F.lit(len(names) + 1)
    ).cast("int")


def placed_sections(items: DataFrame, sections: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every section of the list, then those of ``items`` that it lacks, by their first item.

    Section names are few; only they meet in one task. ``by`` names columns of both tables
    (the issue) inside which sections are placed.
    """
    own = items.where(F.col("section").isNotNull()).groupBy(*by, "section").agg(F.min("ordinal").alias("_first"))
    extra = own.join(sections, [*by, "section"], "left_anti")
    last = sections.agg(F.coalesce(F.max("section_ord"), F.lit(0)).alias("n")).scalar()
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_first", "section")) + last
    listed = sections.select(*by, "section", F.col("section_ord").cast("int").alias("section_ord"))
    return listed.unionByName(extra.select(*by, "section", place.cast("int").alias("section_ord")))


def _mapped(section: Column, leads: dict[str, str]) -> Column:
    pairs = [F.lit(x) for kv in leads.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), section)


def section_lead(section: Column, items: Column) -> Column:
    """Lead line: the empty text, the section's own, or the generic one."""
    return F.when(items == 0, rules.EMPTY_LEAD).otherwise(
        F.coalesce(_mapped(section, rules.SECTION_LEADS), F.lit(rules.GENERIC_LEAD))
    )


def card_lead(section: Column) -> Column:
    return F.coalesce(_mapped(section, rules.CARD_LEADS), F.lit(rules.CARD_LEAD_GENERIC))


def section_leads(sections: DataFrame, items: DataFrame) -> DataFrame:
    """Every section with its item count and lead."""
    counts = items.groupBy("section").agg(F.count(F.lit(1)).alias("items"))
    joined = sections.join(counts, "section", "left").withColumn("items", F.coalesce(F.col("items"), F.lit(0)))
    return joined.withColumn("lead", section_lead(F.col("section"), F.col("items")))


def complete_sections(items: DataFrame, required: DataFrame) -> DataFrame:
    """Placeholder rows for the required sections that have no item."""
    present = items.select("section").distinct()
    missing = required.join(present, "section", "left_anti").select(
        "section",
        F.lit(rules.PLACEHOLDER_TITLE).alias("title"),
        F.lit(rules.PLACEHOLDER_BODY).alias("content"),
        F.lit(True).alias("placeholder"),
    )
    own = items.select("section", "title", "content", F.lit(False).alias("placeholder"))
    return own.unionByName(missing)


def stage_errors(items: DataFrame, errors: DataFrame, stages: DataFrame) -> DataFrame:
    """Error placeholders for failed feeds whose section is absent."""
    failed = errors.join(stages, "stage").withColumn("error", strip(text_or_empty(F.col("error"))))
    present = items.select("section").distinct()
    return (
        failed.where(F.col("error") != "")
        .join(present, "section", "left_anti")
        .groupBy("section")
        .agg(F.min_by("error", "stage_ord").alias("error"))
        .select(
            "section",
            F.lit(rules.PLACEHOLDER_TITLE).alias("title"),
            F.concat(F.lit(f"{rules.ERROR_BODY}\n\n原因: "), F.col("error")).alias("content"),
        )
    )


def union_feeds(feeds: Sequence[tuple[str, DataFrame | None]]) -> DataFrame:
    """Feeds one after another; ``feed_ord`` keeps their order and a failed feed (None) adds nothing."""
    out = None
    for position, (name, feed) in enumerate(feeds, start=1):
        if feed is None:
            continue
        tagged = feed.withColumns({"feed": F.lit(name), "feed_ord": F.lit(position)})
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("every feed failed; use fallback_issue")
    return out


def first_nonempty_feed(df: DataFrame, group: str = "feed_group") -> DataFrame:
    """Rows of the best feed that has any, per group.

    The smallest priority per group is a partial aggregate; large groups are never gathered.
    """
    best = df.groupBy(group).agg(F.min("prio").alias("_best"))
    return df.join(best, group).where(F.col("prio") == F.col("_best")).drop("_best")


def fallback_issue(items: DataFrame, errors: DataFrame, brand: str = "", preface: str = rules.FALLBACK_PREFACE) -> DataFrame:
    """The explanatory issue, present only when there is no item at all.

    ``errors`` has a row per stage of a run, which are few.
    """
    spark = items.sparkSession
    any_item = items.select(F.lit(1).alias("one")).limit(1).agg(F.count("one").alias("n")).scalar()
    lines = errors.where(text_or_empty(F.col("error")) != "").agg(
        F.coalesce(
            non_empty(
                F.array_join(
                    F.transform(
                        F.array_sort(
                            F.collect_list(
                                F.struct("stage_ord", F.concat_ws("", F.lit("- "), "stage", F.lit(": "), "error").alias("line"))
                            )
                        ),
                        lambda s: s["line"],
                    ),
                    "\n",
                )
            ),
            F.lit("- 无详细错误信息"),
        ).alias("_lines")
    ).select(F.concat(F.lit(preface), F.col("_lines")).alias("content"))
    note = lines.select(
        F.lit(0).alias("section_ord"), F.lit(brand).alias("section"), F.lit("本期说明").alias("title"), "content"
    )
    rest = section_table(spark, rules.FALLBACK_SECTIONS).select(
        "section_ord", "section", F.lit(rules.PLACEHOLDER_TITLE).alias("title"), F.lit(rules.PLACEHOLDER_BODY).alias("content")
    )
    return note.unionByName(rest).where(any_item == 0)


def section_buckets(items: DataFrame, sections: DataFrame) -> DataFrame:
    """Item count per section in the fixed order, unlisted sections last; sections without items are reported empty."""
    counts = items.groupBy("section").agg(
        F.count(F.lit(1)).alias("items"), F.min("ordinal").alias("first_ordinal"), F.max("ordinal").alias("last_ordinal")
    )
    joined = placed_sections(items, sections).join(counts, "section", "left")
    return joined.select(
        "section", "section_ord",
        F.coalesce(F.col("items"), F.lit(0)).alias("items"),
        "first_ordinal", "last_ordinal",
        F.when(F.col("items").isNull(), "empty").otherwise("kept").alias("status"),
        F.when(F.col("items").isNull(), "no_visible_wechat_items").otherwise("assigned_wechat_section").alias("reason"),
    )


def visible_counts(items: DataFrame, by: str) -> DataFrame:
    return items.groupBy(by).agg(
        F.count_if(F.col("keep")).alias("visible"), F.count(F.lit(1)).alias("total")
    )
