"""Parts of a document under a heading, bounded by the next heading of the same or a higher level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin import rules
from bulletin.functions.basics import WS, let, non_empty, strip, unix_lines
from bulletin.functions.text import squeeze_blank_lines
from bulletin.operators.joins import example_digest
from bulletin.operators.rows import explode_once
from bulletin.sources.digest import ITEM_START, cut_at, first_line, rest_of, scored

#: A heading of level 1 to 3 with something after its marker, at the start of a line.
HEADING_START = r"(?=#{1,3}[ \t][^\n]*\S)(?<![^\n])"
HEADING_LINE = r"^(#{1,3})[ \t][^\n]*\S"


def heading_key(title: Column) -> Column:
    """A heading without any white space."""
    return F.regexp_replace(title, f"{WS}+", "")


def aliases(section: str) -> list[str]:
    bare = "".join(section.split())
    return [bare, *rules.SECTION_ALIASES.get(section, [])]


def pieces(text: Column) -> Column:
    """array<struct<level, title, text>>: a text cut before every heading; what precedes the first has level 0."""
    cut = cut_at(unix_lines(text), HEADING_START, HEADING_LINE)

    def piece(p: Column) -> Column:
        level = F.length(F.regexp_extract(p, HEADING_LINE, 1))
        return F.struct(level.alias("level"), F.when(level > 0, heading_key(first_line(p, level))).alias("key"), p.alias("text"))

    return F.transform(cut, piece)


def block_under(cut: Column, names: Sequence[str]) -> Column:
    """Text under the first heading called one of ``names``, up to the next heading of its level or above; else NULL.

    One pass over the pieces for the start, one for the end, however deep headings nest.
    """
    start = F.array_position(F.transform(cut, lambda p: F.coalesce(p["key"].isin(*names), F.lit(False))), F.lit(True)).cast("int")

    def until(at: Column) -> Column:
        level = F.get(cut, at - 1)["level"]
        later = F.slice(cut, at + 1, F.size(cut))
        ends = F.array_position(F.transform(later, lambda p: (p["level"] > 0) & (p["level"] <= level)), F.lit(True)).cast("int")
        inside = F.when(ends > 0, F.slice(later, F.lit(1), ends - 1)).otherwise(later)
        whole = F.concat(rest_of(F.get(cut, at - 1)["text"]), F.array_join(F.transform(inside, lambda p: p["text"]), ""))
        return F.when(at > 0, squeeze_blank_lines(strip(whole)))

    return let(start, until)


def section_blocks(documents: DataFrame, sections: Sequence[str], doc: str = "doc_path") -> DataFrame:
    """(doc, section, block) of the wanted sections that a document has under a heading of any level.

    Names are compared without white space, and by their aliases. Work inside the row: a text
    is cut once for all sections.
    """
    wanted = lambda cut: F.array(*[F.struct(F.lit(s).alias("section"), block_under(cut, aliases(s)).alias("block")) for s in sections])
    found = F.filter(let(pieces(F.col("text")), wanted), lambda b: b["block"].isNotNull())
    return explode_once(documents, [doc], found, "_i", "_b").select(doc, "_b.section", "_b.block")


def has_scores(block: Column) -> Column:
    return F.contains(block, F.lit(rules.SCORE_LABEL)) | F.contains(block, F.lit(rules.HUMAN_SCORE_LABEL))


def section_samples(documents: DataFrame, sections: Sequence[str], doc: str = "doc_path") -> DataFrame:
    """Scored samples (doc, section, item_ord, title, score, reason) under the headings of the wanted sections."""
    return _samples(section_blocks(documents, sections, doc), doc)


def _samples(blocks: DataFrame, doc: str) -> DataFrame:
    items = explode_once(
        blocks.where(has_scores(F.col("block"))), [doc, "section"], cut_at(F.col("block"), ITEM_START, r"^## [^\n]*\S"), "item_ord", "item"
    )
    named = items.where(F.col("item_ord") > 0).select(
        doc, "section", "item_ord", first_line(F.col("item"), F.lit(2)).alias("title"), strip(rest_of(F.col("item"))).alias("content")
    )
    return scored(named, [doc, "section", "item_ord", "title"])


def sample_digest(documents: DataFrame, sections: Sequence[str], doc: str = "doc_path") -> DataFrame:
    """(section, examples): the scored samples of each section as lines, in the order of documents and items.

    A section that has scores but no scored item gives the head of its first block instead;
    one without any score gives nothing.
    """
    blocks = section_blocks(documents, sections, doc)
    lines = example_digest(_samples(blocks, doc).withColumn("ordinal", F.struct(doc, "item_ord")))
    head = F.substring("block", 1, rules.EXAMPLE_SECTION_CHARS)
    raw = blocks.where(has_scores(F.col("block"))).groupBy("section").agg(F.min_by(head, F.col(doc)).alias("_raw"))
    joined = raw.join(lines, "section", "left")
    return joined.select("section", F.coalesce(non_empty(F.col("examples")), F.col("_raw")).alias("examples"))
