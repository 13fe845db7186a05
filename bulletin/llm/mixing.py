"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the fractional number of copies of each of its
documents. Documents are dealt into blocks of about `fan_in`; in a block one document after
the other is paired with the residual so far, and words are moved between the two fractions
at random, in the proportion that keeps every expectation, until one of them is integral.
The one fraction left per block goes on to the next level: a reduction tree whose levels
shrink by `fan_in`, until one fraction per source is rounded by itself. So the words a
source takes differ from its target by less than two of its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin.llm.common import let, numbered, settle

WORD = r"[^\x20\x09-\x0D]+"
#: Fractions this close to 0 or 1 count as integral.
EPS = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*parts: Column | int) -> Column:
    """A number in [0, 1) fixed by its arguments."""
    bits = F.xxhash64(*[F.lit(p) if isinstance(p, int) else p for p in parts])
    return F.shiftrightunsigned(bits, 11) / F.lit(float(2**53))


def source_targets(sources: DataFrame, weights: tuple[float, ...], share: float, max_copies: float) -> DataFrame:
    """`source, source_size, target`: weights by code point order, caps reshared by weight.

    `sources` has `source, source_size`. Each round is one aggregate; the driver holds two sums.
    """
    ranked = numbered(sources, [F.col("source").isNull().asc(), F.col("source").asc()], "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("ordinal") % len(weights) + 1).cast("int"))
    ranked = settle(ranked.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * float(max_copies)), "mix-weights")
    total = share * (ranked.agg(F.sum("source_size")).head()[0] or 0)
    rate, before = 0.0, -1
    while True:
        over = F.col("_weight") * rate > F.col("_cap")
        capped, free, n = ranked.agg(
            F.sum(F.when(over, F.col("_cap")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("_weight"))), F.sum(over.cast("int"))
        ).head()
        if not free or n == before:
            break
        rate, before = (total - capped) / free, n
    target = F.least(F.col("_weight") * rate, F.col("_cap")) if free else F.col("_cap")
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def _fold(items: Column, seed: int, level: int) -> Column:
    """Pair the items of one block in order: `done` (decided, with `up`) and `rest` (the residual, or null)."""
    kind = "source string, doc_id bigint, size bigint, tag bigint, copies bigint, base bigint, w double, p double"
    decided = f"array<struct<{','.join(f'{x.split()[0]}:{x.split()[1]}' for x in kind.split(', '))},up:boolean>>"
    start = F.struct(
        F.lit(None).cast("struct<" + ",".join(f"{x.split()[0]}:{x.split()[1]}" for x in kind.split(", ")) + ">").alias("rest"),
        F.array().cast(decided).alias("done"),
    )

    def step(state: Column, item: Column) -> Column:
        a = state["rest"]

        def move(m: Column) -> Column:
            """m: words that may go from item to residual (`give`) or back (`take`)."""
            up = m["u"] * (m["give"] + m["take"]) < m["take"]
            pa = F.when(up, a["p"] + m["give"] / a["w"]).otherwise(a["p"] - m["take"] / a["w"])
            pb = F.when(up, item["p"] - m["give"] / item["w"]).otherwise(item["p"] + m["take"] / item["w"])
            return F.struct(pa.alias("pa"), pb.alias("pb"))

        def settle_one(m: Column) -> Column:
            fixed = (m["pa"] <= EPS) | (m["pa"] >= 1 - EPS)
            gone = F.when(fixed, a.withField("up", m["pa"] >= 0.5)).otherwise(item.withField("up", m["pb"] >= 0.5))
            left = F.when(fixed, item.withField("p", m["pb"])).otherwise(a.withField("p", m["pa"]))
            return F.struct(left.alias("rest"), F.concat(state["done"], F.array(gone)).alias("done"))

        room = F.struct(
            F.least((1 - a["p"]) * a["w"], item["p"] * item["w"]).alias("give"),
            F.least(a["p"] * a["w"], (1 - item["p"]) * item["w"]).alias("take"),
            uniform(seed, level, a["tag"], item["tag"]).alias("u"),
        )
        # A residual that a tie left integral is decided as it is.
        whole = (a["p"] <= EPS) | (a["p"] >= 1 - EPS)
        moved = F.when(whole, F.struct(a["p"].alias("pa"), item["p"].alias("pb"))).otherwise(let(room, move))
        return F.when(a.isNull(), F.struct(item.alias("rest"), state["done"].alias("done"))).otherwise(let(moved, settle_one))

    return F.aggregate(items, start, step)


FIELDS = ("source", "doc_id", "size", "tag", "copies", "base", "w", "p")


def choose_copies(items: DataFrame, seed: int = 17, fan_in: int = 256) -> DataFrame:
    """Round the fractions of `items`: columns `source, doc_id, size, tag, copies, base` plus `up`.

    `items` has FIELDS with `p` in [0, 1) and the weight `w` > 0 in words.
    """
    parts, level = [], 0
    while True:
        counts = items.groupBy("source").agg(F.count("*").alias("_n"))
        most = counts.agg(F.max("_n")).head()[0] or 0
        blocks = F.ceil(F.col("_n") / fan_in)
        laid = items.join(settle(counts.withColumn("_blocks", blocks.cast("long")).drop("_n").withColumnRenamed("source", "_source"), "mix-blocks"), F.col("source").eqNullSafe(F.col("_source")))
        laid = laid.withColumn("_block", F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "tag"), "_blocks"))
        held = laid.groupBy("source", "_block").agg(F.sort_array(F.collect_list(F.struct("tag", *[f for f in FIELDS if f != "tag"]))).alias("_items"))
        ordered = F.transform("_items", lambda x: F.struct(*[x[f].alias(f) for f in FIELDS]))
        folded = settle(held.select(_fold(ordered, seed, level).alias("f")), f"mix-level{level}")
        parts.append(folded.select(F.explode("f.done").alias("d")).select("d.*"))
        items = folded.select("f.rest.*").filter("w is not null")
        level += 1
        if most <= fan_in:
            break
    last = items.withColumn("up", uniform(seed, level, F.col("tag")) < F.col("p"))
    out = last
    for part in parts:
        out = out.unionByName(part)
    return out


def mix_items(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_copies: float = 2.0,
    seed: int = 17,
    fan_in: int = 256,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Copies per distinct (source, doc_id, size): `source, doc_id, size, rows, copies, source_size, target`.

    `copies` counts all copies that the `rows` equal rows get together. Null sources are a
    source of their own, the last one; null texts and texts without words have size 0, take
    no words and get the rounded number of copies.
    """
    rows = docs.select(F.col(source_col).alias("source"), F.col(id_col).cast("long").alias("doc_id"), word_count(F.col(text_col)).alias("size"))
    items = settle(rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("rows")), "mix-items")
    sizes = items.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = settle(source_targets(sizes, weights, share, max_copies).withColumnRenamed("source", "_source"), "mix-targets")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    mass = F.least(each, F.lit(float(max_copies))) * F.col("rows")
    # A fraction within rounding of a whole number is that number.
    near = F.when(F.abs(mass - F.round(mass)) < EPS, F.round(mass)).otherwise(mass)
    wide = items.join(targets, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_mass", near)
    wide = wide.withColumns(
        {
            "base": F.floor("_mass").cast("long"),
            "p": F.col("_mass") - F.floor("_mass"),
            "w": F.col("size").cast("double"),
            "tag": F.xxhash64(F.lit(seed), "source", "doc_id", "size"),
            "copies": F.col("rows"),
        }
    )
    open_ = (F.col("p") > 0) & (F.col("size") > 0)
    rounded = choose_copies(wide.filter(open_).select(*FIELDS), seed, fan_in)
    rounded = rounded.select("source", "doc_id", "size", F.col("copies").alias("rows"), (F.col("base") + F.col("up").cast("long")).alias("copies"))
    fixed = wide.filter(~open_).select(
        "source", "doc_id", "size", "rows", (F.col("base") + (uniform(seed, F.col("tag")) < F.col("p")).cast("long")).alias("copies")
    )
    both = rounded.unionByName(fixed)
    return both.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """One row per document: `doc_id, source, size, source_size, target, copies, taken`.

    Equal rows share their copies as evenly as whole numbers allow.
    """
    items = mix_items(docs, **options)
    # Equal rows are dealt out in runs of at most 10,000, so that no array grows with their number.
    run = 10_000
    runs = items.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / run))))
    row = F.explode(F.sequence(F.col("_run") * run, F.least((F.col("_run") + 1) * run, F.col("rows")) - 1))
    dealt = runs.withColumn("_row", row)
    copies = F.floor(F.col("copies") / F.col("rows")) + (F.col("_row") < F.col("copies") % F.col("rows")).cast("long")
    dealt = dealt.withColumn("_copies", copies.cast("long"))
    return dealt.select(
        "doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target",
        F.col("_copies").alias("copies"), (F.col("_copies") * F.col("size")).alias("taken"),
    )


def apply_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options: object) -> DataFrame:
    """The mixed corpus: every row of `docs` as often as the mix takes it, other columns untouched."""
    seed = int(options.get("seed", 17))
    items = mix_items(docs, id_col=id_col, source_col=source_col, text_col=text_col, **options)
    items = items.select(F.col("source").alias("_s"), F.col("doc_id").alias("_d"), F.col("size").alias("_z"), "rows", "copies")
    items = settle(items.withColumnsRenamed({"rows": "_rows", "copies": "_copies"}), "mix-copies")
    keyed = docs.withColumns({"_size": word_count(F.col(text_col)), "_pick": F.monotonically_increasing_id()})
    found = keyed.join(
        items,
        F.col(source_col).eqNullSafe(F.col("_s")) & F.col(id_col).cast("long").eqNullSafe(F.col("_d")) & (F.col("_size") == F.col("_z")),
    )
    # Equal rows cannot be told apart: each gets the whole part, the rest falls by lot.
    lot = uniform(seed, F.col("_pick")) * F.col("_rows") < F.col("_copies") % F.col("_rows")
    n = F.floor(F.col("_copies") / F.col("_rows")) + F.when(F.col("_rows") > 1, lot.cast("long")).otherwise(0)
    return found.withColumn("_n", n.cast("int")).filter("_n > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*docs.columns)
