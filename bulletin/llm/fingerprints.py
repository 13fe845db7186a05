"""Document fingerprints: threshold-scaled sketches of word shingles.

A shingle is five consecutive words (all words of a text that has fewer); words are runs
without ASCII white space, in lower case. A sketch retains every distinct shingle hash in
the lowest 1/`scale` of the 64-bit range. The rule looks at one hash alone, so the sketch of
a union is the union of sketches (`merged`), and texts of very different length keep
comparable shares: the part of A's retained hashes that B retains estimates how much of A
lies in B.

A fingerprint also carries a hash of all words. It tells texts apart whose sketches are
empty, and makes the likeness of equal texts 1 at any length.

Only built-in functions are used: a text is hashed in the row it lies in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bulletin.llm.common import int_array, let, settle

SHINGLE, SCALE = 5, 8
_SPACES = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Lower-cased runs without ASCII white space; null has none."""
    spaced = F.translate(F.lower(F.coalesce(text, F.lit(""))), _SPACES, " " * len(_SPACES))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def sketch(text: Column, size: int = SHINGLE, scale: int = SCALE) -> Column:
    """struct(digest bigint, hashes array<bigint>): the retained hashes ascending, without repeats."""
    top = -(1 << 63) + (1 << 64) // scale - 1

    def of(w: Column) -> Column:
        run = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)])
        all_words = F.xxhash64(w)
        n = F.size(w) - size + 1
        hashes = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), run)).when(F.size(w) > 0, F.array(all_words)).otherwise(F.array().cast("array<bigint>"))
        low = F.filter(hashes, lambda h: h <= F.lit(top))
        return F.struct(all_words.alias("digest"), F.sort_array(F.array_distinct(low)).alias("hashes"))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def printed(sketched: Column) -> Column:
    """A sketch as text: the digest, a colon, the retained hashes, each as 16 hex digits."""
    hexed = F.transform(sketched["hashes"], lambda h: F.lpad(F.lower(F.hex(h.bitwiseXOR(F.lit(-(1 << 63))))), 16, "0"))
    return F.concat(F.lpad(F.lower(F.hex(sketched["digest"])), 16, "0"), F.lit(":"), F.array_join(hexed, ""))


def merged(a: Column, b: Column) -> Column:
    """Retained hashes of two texts together."""
    return F.sort_array(F.array_union(a["hashes"], b["hashes"]))


def shared(a: Column, b: Column) -> Column:
    """Retained hashes that both have."""
    return F.size(F.array_intersect(a["hashes"], b["hashes"]))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def containment(a: Column, b: Column) -> Column:
    """Estimated part of a's shingles that b has; 1 for equal words, else 0 where a retains none."""
    return F.when(a["digest"] == b["digest"], F.lit(1.0)).otherwise(_share(shared(a, b), F.size(a["hashes"])))


def likeness(a: Column, b: Column) -> Column:
    """Estimated containment of the text with fewer shingles in the other, 0 to 1."""
    fewer = F.least(F.size(a["hashes"]), F.size(b["hashes"]))
    return F.when(a["digest"] == b["digest"], F.lit(1.0)).otherwise(_share(shared(a, b), fewer))


def jaccard(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity, 0 to 1."""
    n = shared(a, b)
    return F.when(a["digest"] == b["digest"], F.lit(1.0)).otherwise(_share(n, F.size(a["hashes"]) + F.size(b["hashes"]) - n))


def _range_of(key: tuple[Column, Column], starts: tuple[Column, Column], n: int) -> Column:
    """How many of the `n` ascending (id, hash) `starts` lie at or below `key`, by binary search in constant arrays."""
    steps = F.array(*[F.lit(1 << e) for e in reversed(range(n.bit_length()))])

    def at_or_below(at: Column) -> Column:
        ident, text_hash = (F.get(s, at) for s in starts)
        return (ident < key[0]) | ((ident == key[0]) & (text_hash <= key[1]))

    down = lambda lo, step: F.when((lo + step <= n) & at_or_below(lo + step - 1), lo + step).otherwise(lo)
    return F.aggregate(steps, F.lit(0), down) if n else F.lit(0)


def with_next(rows: DataFrame, carry: Column, range_bytes: int = 64 << 20) -> DataFrame:
    """`_id, own, next`: `carry`, a struct with `text`, of every row and of the next one in descending order of `_id`.

    The last row's next is the first. `rows` has `_id, _hash, _t`. Rows are cut into ranges
    of about `range_bytes` of text; the bounds, two numbers a range, come from a shuffle of
    ids, hashes and sizes. The row that precedes a range is sent along with it as a guest, so
    that texts are shuffled once and ranges do not wait for each other. Null ids count as the
    smallest, so they come last; equal ids go by hash and text.
    """
    spark = rows.sparkSession
    place = F.coalesce("_id", F.lit(-(1 << 63)))
    sizes = settle(rows.select(F.struct(place.alias("i"), F.col("_hash").alias("h")).alias("key"), F.octet_length("_t").alias("_bytes")), "next-keys")
    total = sizes.agg(F.sum("_bytes")).head()[0] or 0
    ranges = max(1, -(-total // range_bytes), min(total >> 20, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = sizes.repartitionByRange(ranges, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    held = sorted(((r.lo.i, r.lo.h), (r.hi.i, r.hi.h)) for r in dealt.collect())
    columns = [int_array([bound[side][part] for bound in held]) for side in (0, 1) for part in (0, 1)]
    if not held:
        return rows.select("_id", carry.alias("own"), carry.alias("next")).filter("false")
    # Ascending order is the descending one backwards: the next row is the one before.
    starts = tuple(F.slice(c, 2, len(held)) for c in columns[:2])
    placed = rows.select("_id", place.alias("_i"), "_hash", carry.alias("own"), _range_of((place, F.col("_hash")), starts, len(held) - 1).alias("_range"))
    leaves = (F.get(columns[2], F.col("_range")) == F.col("_i")) & (F.get(columns[3], F.col("_range")) == F.col("_hash"))
    seat = lambda part, guest: F.struct(part.cast("int").alias("range"), F.lit(guest).alias("guest"))
    seats = F.when(leaves, F.array(seat(F.col("_range"), False), seat((F.col("_range") + 1) % len(held), True))).otherwise(F.array(seat(F.col("_range"), False)))
    sent = placed.select("_id", "_i", "_hash", "own", F.explode(seats).alias("seat")).select("_id", "_i", "_hash", "own", "seat.range", "seat.guest")
    seen = Window.partitionBy("range").orderBy(F.col("guest").desc(), "_i", "_hash", "own.text")
    return sent.withColumn("next", F.lag("own").over(seen)).filter("NOT guest").select("_id", "own", "next")


def fingerprint_neighbours(
    docs: DataFrame, size: int = SHINGLE, scale: int = SCALE, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = 64 << 20
) -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likeness.

    Columns `doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next`, and the estimates `within_edited` (part of the text in its edited form),
    `within_next` and `jaccard_next`. The edited text has its last floor(n_chars / 2) code
    points replaced by the first as many (or all) of the next document in descending order
    of the id. Null texts are empty; a text without words has an empty sketch and is like
    another such text only. Null ids come last, equal ids go by hash and text; equal rows
    follow each other. A single row is its own next. An empty table gives no rows. Other
    columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), text.alias("_t"))
    rows = rows.select("_id", F.xxhash64("_t").alias("_hash"), "_t")
    own = F.struct(F.col("_t").alias("text"), sketch(F.col("_t"), size, scale).alias("sketch"))
    found = with_next(rows, own, range_bytes)
    half = F.floor(F.length("own.text") / 2).cast("int")
    edited = F.concat(F.substring("own.text", F.lit(1), F.length("own.text") - half), F.substring("next.text", F.lit(1), half))
    made = found.select("_id", "own", F.col("next.sketch").alias("next"), let(edited, lambda e: F.struct(F.sha2(e, 256).alias("sha"), sketch(e, size, scale).alias("sketch"))).alias("e"))
    a, b, c = F.col("own.sketch"), F.col("e.sketch"), F.col("next")
    return made.select(
        F.col("_id").alias("doc_id"), F.length("own.text").cast("bigint").alias("n_chars"), F.col("e.sha").alias("edited_sha256"),
        printed(a).alias("fingerprint"), printed(b).alias("edited_fingerprint"),
        likeness(a, b).alias("near_edited"), likeness(a, c).alias("near_next"),
        containment(a, b).alias("within_edited"), containment(a, c).alias("within_next"), jaccard(a, c).alias("jaccard_next"),
    )
