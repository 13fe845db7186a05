"""Benchmark decontamination by SimHash over item-sized windows.

Words are lower-cased runs of non-space; shingles are five consecutive words (all words of
an item shorter than that). A window is as many words of a document as the item has. Only
windows that share a shingle with an item can be similar to it, and of those the ones that
start at a shared shingle suffice: moving a window right to its first shared shingle loses
nothing. The same shared shingles say which windows hold too few of them for the similarity;
those are left out before their texts are read again. Windows get a 64-bit SimHash of their shingle multiset and are kept within
`radius` bits of the item's; the radius + 1 blocks of the fingerprint tell at once when no
block agrees, which cannot be within the radius. What is left is verified by the weighted
Jaccard similarity of the two multisets.

The radius of 26 is far beyond what a similarity of 0.8 gives (9.6 bits on average, with a
deviation of 2.9), so the fingerprint saves exact work and costs no match.

Null and empty texts match nothing, null and empty items are not searched. Equal rows give
their matches once; columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin.llm.common import let, settle
from bulletin.llm.mixing import WORD

SHINGLE = 5
BITS = 64
#: One bit in each 16-bit lane.
LANES = 0x0001000100010001
#: Lanes count this many shingles at most; longer items are verified without a fingerprint.
LANE_LIMIT = 0xFFFF


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def shingles(word_hashes: Column, size: int = SHINGLE) -> Column:
    """Hashes of all runs of `size` words, given the words' hashes."""
    n = F.size(word_hashes) - size + 1
    run = lambda i: F.xxhash64(*[F.get(word_hashes, i + k) for k in range(size)])
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), run)).otherwise(F.array().cast("array<bigint>"))


def shingle_rows(rows: DataFrame, size: int) -> DataFrame:
    """A row for each shingle of `_h`, the words' hashes: `_n` words, `_pos, _hash`. Hashed after the explosion, where Spark compiles it."""
    places = F.when(F.size("_h") >= size, F.sequence(F.lit(0), F.size("_h") - size))
    each = rows.select("*", F.size("_h").alias("_n"), F.explode(places).alias("_pos"))
    return each.withColumn("_hash", F.xxhash64(*[F.get("_h", F.col("_pos") + k) for k in range(size)])).drop("_h")


def full_windows(places: Column, doc_words: Column, item_words: Column, size: Column, similarity: float) -> Column:
    """Starts of the windows that hold enough shared shingles for `similarity`, given the sorted places of all shared ones.

    `c` of the shingles of window and item in common are a similarity of c / (all - c).
    """
    last = F.greatest(doc_words - item_words, F.lit(0))
    own = F.least(doc_words, item_words) - size + 1
    need = F.greatest(F.ceil((own + item_words - size + 1) * (similarity / (1 + similarity)) - 1e-6), F.lit(1)).cast("int")
    # At the end of a document the window ends with it, and may begin before its first shared shingle.
    ahead = F.filter(places, lambda p, i: (p < last) & (F.get(places, i + need - 1) < p + own))
    return F.when(F.get(places, F.size(places) - need) >= last, F.concat(ahead, F.array(last))).otherwise(ahead)


def fingerprint(hashes: Column) -> Column:
    """64-bit SimHash of a multiset of 64-bit hashes: a bit is set where most of them have it.

    Four bits are counted at a time in the 16-bit lanes of one number.
    """

    def lanes(k: int) -> Column:
        add = lambda total, h: total + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(LANES))
        return F.aggregate(hashes, F.lit(0).cast("long"), add)

    counted = F.array(*[lanes(k) for k in range(16)])

    def assemble(sums: Column) -> Column:
        bit = lambda k, lane: F.when(
            F.shiftrightunsigned(F.get(sums, F.lit(k)), 16 * lane).bitwiseAND(F.lit(0xFFFF)) * 2 > F.size(hashes), F.shiftleft(F.lit(1).cast("long"), 16 * lane + k)
        ).otherwise(F.lit(0).cast("long"))
        total = bit(0, 0)
        for k in range(16):
            for lane in range(4):
                if k or lane:
                    total = total.bitwiseOR(bit(k, lane))
        return total

    return let(counted, assemble)


def blocks_meet(difference: Column, radius: int) -> Column:
    """Whether one of radius + 1 blocks of the fingerprint agrees: true for all pairs within the radius."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    meet = F.lit(False)
    for lo, hi in zip(edges, edges[1:], strict=False):
        mask = ((1 << (hi - lo)) - 1) << lo
        meet = meet | (difference.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)) == 0)
    return meet


def overlap(window: Column, kinds: Column) -> Column:
    """Size of the multiset intersection of `window` with `kinds`, an array of (hash, n)."""
    one = lambda total, k: total + F.least(k["n"], F.size(F.filter(window, lambda h: h == k["hash"])))
    return F.aggregate(kinds, F.lit(0), one)


def matches(
    docs: DataFrame, items: DataFrame, similarity: float = 0.8, radius: int = 26,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Pairs of document and item with a window at `similarity` or more.

    Columns `doc_id, item_id, similarity, start_word` (0-based, of the first of the most
    similar windows), and `key1, key2`, two hashes of the text.
    """
    listed = items.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("_w")).filter("size(_w) > 0").distinct()
    listed = listed.select("item_id", F.size("_w").alias("item_words"), F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    size = F.least(F.col("item_words"), F.lit(SHINGLE))
    own = F.when(size == SHINGLE, shingles(F.col("_h")))
    for short in range(1, SHINGLE):
        own = own.when(size == short, shingles(F.col("_h"), short))
    listed = listed.select("item_id", "item_words", size.alias("q"), own.alias("shingles"))
    kinds = F.transform(F.array_distinct("shingles"), lambda h: F.struct(h.alias("hash"), F.size(F.filter("shingles", lambda x: x == h)).alias("n")))
    listed = settle(listed.withColumns({"kinds": kinds, "item_print": fingerprint(F.col("shingles"))}), "bench-items")
    # Of bounded size or not, Spark knows the size of the settled table and picks the join by it.
    wanted = settle(listed.select("item_id", "q", F.explode(F.array_distinct("shingles")).alias("_hash")), "bench-shingles")
    sizes = [r[0] for r in listed.select("q").distinct().collect()] or [SHINGLE]

    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    keyed = keyed.withColumns({"key1": F.xxhash64("_text"), "key2": F.xxhash64(F.lit(1), "_text")})
    hashes = F.transform(words(F.col("_text")), lambda w: F.xxhash64(w))
    hits = None
    for q in sizes:
        each = shingle_rows(keyed.select("doc_id", "key1", "key2", hashes.alias("_h")), q)
        found = each.join(wanted.filter(F.col("q") == q), "_hash").select("doc_id", "key1", "key2", "item_id", "_n", "_pos")
        hits = found if hits is None else hits.unionByName(found)
    names = "doc_id", "item_id", "similarity", "start_word", "key1", "key2"
    hits = hits.groupBy("doc_id", "key1", "key2", "item_id", "_n").agg(F.sort_array(F.collect_set("_pos")).alias("_places"))
    hits = hits.join(listed.select("item_id", "item_words", "q").distinct(), "item_id")
    starts = full_windows(F.col("_places"), F.col("_n"), F.col("item_words"), F.col("q"), similarity)
    hits = settle(hits.select("doc_id", "key1", "key2", "item_id", "item_words", "q", F.explode(starts).alias("_start")), "bench-hits")
    spots = settle(hits.select("doc_id", "key1", "key2").distinct(), "bench-spots")
    same = ["key1", "key2"]
    touched = keyed.withColumnRenamed("doc_id", "_id").join(spots, same).filter(F.col("_id").eqNullSafe(F.col("doc_id"))).drop("_id")
    touched = touched.dropDuplicates(["doc_id", *same]).select("doc_id", *same, hashes.alias("_h"))
    windows = touched.withColumnRenamed("doc_id", "_id").join(hits, same).filter(F.col("_id").eqNullSafe(F.col("doc_id"))).drop("_id")
    windows = windows.join(listed, ["item_id", "item_words", "q"])
    cut = None
    for q in sizes:
        part = F.slice("_h", F.col("_start") + 1, F.col("item_words"))
        cut = F.when(F.col("q") == q, shingles(part, q)) if cut is None else cut.when(F.col("q") == q, shingles(part, q))

    # One expression, so that nothing in it is evaluated twice; below the radius only.
    def verify(window: Column) -> Column:
        def checked(difference: Column) -> Column:
            near = (blocks_meet(difference, radius) & (F.bit_count(difference) <= radius)) | (F.size("shingles") > LANE_LIMIT)
            share = lambda n: n / (F.size(window) + F.size("shingles") - n)
            return F.when(near, let(overlap(window, F.col("kinds")), share))

        return let(fingerprint(window).bitwiseXOR(F.col("item_print")), checked)

    windows = windows.select("doc_id", "key1", "key2", "item_id", "_start", let(cut, verify).alias("similarity"))
    best = F.max(F.struct("similarity", (-F.col("_start")).alias("_start"))).alias("_best")
    out = windows.groupBy("doc_id", "key1", "key2", "item_id").agg(best).filter(F.col("_best.similarity") >= similarity)
    return out.select("doc_id", "item_id", F.col("_best.similarity").alias("similarity"), (-F.col("_best._start")).cast("long").alias("start_word"), *same).select(*names)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """`docs` without the documents that hold an item, all columns as they were."""
    bad = matches(docs, items, id_col=id_col, text_col=text_col, **options)
    bad = settle(bad.select(F.col("key1").alias("_k1"), F.col("key2").alias("_k2")).distinct(), "bench-leaks")
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.join(bad, (F.xxhash64(text) == F.col("_k1")) & (F.xxhash64(F.lit(1), text) == F.col("_k2")), "left_anti")
