"""Near-duplicates by BagMinHash over word shingle multisets.

A shingle that occurs w times owns the weights (0, w]. The weights are cut at 1, 2, 4, 8
and so on; every (shingle, interval) has its own Poisson process of points in time, each
with a signature place and, in intervals longer than one, a weight below which it does not
count. The signature keeps the earliest counting point per place, so two texts agree at a
place with exactly their weighted Jaccard similarity. Points come in time order, and a
process stops once its text's places are all filled earlier: work per text is about
its number of shingles rather than that times the places.

Signatures are banded. Exact copies are one text from the start. In a bucket every text is
held against the bucket's best-connected text, then all that is in another class against
the best of the others, and what still crosses classes once more within the texts that
share a second band. These rounds only save work: whatever bucket holds several classes
after them, its members are held against each other exactly, by a join on the rarest
shingles of every text that no pair at the threshold can do without. All candidates are
verified by exact multiset overlap. The links of the first round are joined to classes;
those of a later round link classes, so that it joins these few only, and a round without
a link leaves classes and buckets as they are. Rounds relabel the texts that share a bucket
and the rows of open buckets; all texts get their label once, after the last round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulletin.llm.common import settle
from bulletin.llm.shingling import BASE, U64, mix, shingle_bags

_G1, _G2, _G3 = U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB)


#: Counts that order shingles by rarity are kept for so many leading bits of their hash.
SLOT_BITS = 18
#: The first steps of all processes that each see which have ended; after them one in as many does.
OFTEN = 16


def _times(n: int, factor: np.uint64) -> np.uint64:
    return U64(n * int(factor) & (2**64 - 1))


def bag_signatures(owner: np.ndarray, value: np.ndarray, times: np.ndarray, texts: int, places: int) -> np.ndarray:
    """texts x places: earliest point per place, infinite for texts without shingles."""
    signature = np.full((texts, places), np.inf)
    flat = signature.reshape(-1)
    # The interval k > 0 covers the weights (2^(k-1), 2^k]; k = 0 covers (0, 1].
    text, seed, low, high, weight = [], [], [], [], []
    k = 0
    while True:
        lo, hi = (0, 1) if k == 0 else (2 ** (k - 1), 2**k)
        at = np.flatnonzero(times > lo)
        if not len(at):
            break
        text.append(owner[at])
        seed.append(mix(value[at] + _times(k, _G1)))
        low.append(np.full(len(at), lo, np.float64))
        high.append(np.full(len(at), hi, np.float64))
        weight.append(times[at].astype(np.float64))
        k += 1
    if not text:
        return signature
    text, seed, low, high, weight = map(np.concatenate, (text, seed, low, high, weight))
    clock = np.zeros(len(text))
    step = 0
    while len(text):
        draw = mix(seed + _times(step, BASE))
        clock = clock - np.log1p(-((draw >> U64(11)).astype(np.float64) / 2.0**53)) / (high - low)
        # A point that comes too late changes nothing, so late steps, which are small, look for processes to stop only now and then.
        if step < OFTEN or step % OFTEN == 0:
            going = clock < signature.max(axis=1)[text]
            if not going.all():
                text, seed, low, high, weight, clock, draw = (x[going] for x in (text, seed, low, high, weight, clock, draw))
        other = mix(draw ^ _G2)
        place = ((other >> U64(32)) * U64(places) >> U64(32)).astype(np.int64)
        level = low + (high - low) * ((mix(draw ^ _G3) >> U64(11)).astype(np.float64) / 2.0**53)
        counts = level < weight
        np.minimum.at(flat, (text * places + place)[counts], clock[counts])
        step += 1
    return signature


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """texts x bands: one number per band of `rows` places."""
    bits = signature.view(np.uint64).reshape(len(signature), -1, rows)
    keys = np.zeros(bits.shape[:2], np.uint64)
    for r in range(rows):
        keys = mix(keys * BASE + bits[:, :, r])
    return keys.view(np.int64)


def _sign(bands: int, rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, owner, value, times in shingle_bags(batch.column("text"), size):
                signature = bag_signatures(owner, value, times, hi - lo, bands * rows)
                keys = band_keys(signature, rows)
                # Texts without words have no bands.
                full = np.isfinite(signature[:, 0])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(full * bands)]), pa.int32()), pa.array(keys[full].reshape(-1))
                )
                rest = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([rest.column("doc_id"), rest.column("tid"), lists], ["doc_id", "tid", "bands"])

    return run


def _verify(size: int, similarity: float):
    """Rows sorted by (leader, salt, member last): a leader's bag is kept while its members stream by. Gives `a, b` of the members that reach `similarity`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bag = None, None
        for batch in batches:
            leaders, heads = batch.column("leader").to_pylist(), batch.column("head").to_pylist()
            near: list[int] = []
            for lo, hi, owner, value, times in shingle_bags(batch.column("text"), size):
                edge = np.searchsorted(owner, np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    own, n = value[edge[i] : edge[i + 1]], times[edge[i] : edge[i + 1]]
                    if heads[lo + i]:
                        held, bag = leaders[lo + i], (own, n, n.sum())
                        continue
                    if held != leaders[lo + i]:
                        raise ValueError("a member came without its leader")
                    keys, m, total = bag
                    at = np.searchsorted(keys, own)
                    at[at == len(keys)] = 0
                    shared = np.minimum(m[at], n)[keys[at] == own].sum() if len(keys) and len(own) else 0
                    union = total + n.sum() - shared
                    if union and shared / union >= similarity:
                        near.append(lo + i)
            rows = pa.array(near, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(c).take(rows) for c in ("a", "b")], ["a", "b"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, similarity: float, size: int, run: int = 400) -> DataFrame:
    """`a, b` of the `pairs` (leader, tid, a, b) at `similarity` or more; a leader's members are dealt out in runs of about `run`."""
    counts = pairs.groupBy("leader").agg(F.ceil(F.count("*") / run).cast("int").alias("_salts"))
    counts = settle(counts, "near-leaders")
    heads = counts.select("leader", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("salt"), F.col("leader").alias("tid"), F.lit(True).alias("head"))
    members = pairs.join(counts, "leader").select(
        "leader", F.pmod(F.xxhash64("tid"), F.col("_salts")).cast("int").alias("salt"), "tid", F.lit(False).alias("head"), "a", "b"
    )
    rows = heads.unionByName(members, allowMissingColumns=True).join(texts, "tid")
    laid = rows.repartition("leader", "salt").sortWithinPartitions("leader", "salt", F.col("head").desc())
    return laid.mapInArrow(_verify(size, similarity), "a string, b string")


def components(edges: DataFrame) -> DataFrame:
    """`tid, label` for every vertex of `edges` (a, b): the smallest vertex that it reaches.

    Every round takes the smallest label among a vertex and its neighbours and then the label of the label.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).union(edges.select("a", F.col("a").alias("b"))).union(edges.select(F.col("b").alias("a"), "b"))
    both = settle(both.distinct(), "near-edges")
    labels = settle(both.groupBy(F.col("a").alias("tid")).agg(F.min("b").alias("label")), "near-labels")
    while True:
        own = F.max(F.when(F.col("a") == F.col("b"), F.col("label"))).alias("label")
        near = both.join(labels, both["b"] == labels["tid"]).groupBy("a").agg(own, F.min("label").alias("_near"))
        jump = labels.select(F.col("tid").alias("_t"), F.col("label").alias("_up"))
        step = near.join(jump, F.col("_near") == F.col("_t")).select(F.col("a").alias("tid"), "label", F.least("_near", "_up").alias("_new"))
        step = settle(step, "near-labels")
        labels = step.select("tid", F.col("_new").alias("label"))
        if step.filter("_new <> label").isEmpty():
            return labels


def _labelled(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """`rows` with the labels that `classes` (tid, label) has for their texts; other texts are their own class."""
    return rows.join(classes, "tid", "left").withColumn("label", F.coalesce("label", "tid"))


def _relabelled(classed: DataFrame, classes: DataFrame) -> DataFrame:
    """`classed` with the labels that `classes` (tid, label) has for its labels."""
    found = classes.select(F.col("tid").alias("label"), F.col("label").alias("_to"))
    return classed.join(found, "label", "left").withColumn("label", F.coalesce("_to", "label")).drop("_to")


def _crossing(classed: DataFrame) -> DataFrame:
    """The rows of the buckets that hold several classes."""
    classed = settle(classed, "near-labelled")
    split = classed.groupBy("band", "key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).filter("_lo <> _hi").select("band", "key")
    return settle(classed.join(split, ["band", "key"]), "near-open")


def _unseen(pairs: DataFrame, done: DataFrame) -> DataFrame:
    """Each of `pairs` (leader, tid, a, b) once, whichever leads, without those that `done` has."""
    ends = [F.least("leader", "tid").alias("_lo"), F.greatest("leader", "tid").alias("_hi")]
    each = pairs.groupBy(*ends).agg(F.min(F.struct("leader", "tid", "a", "b")).alias("_pair"))
    return each.join(done.select(*ends), ["_lo", "_hi"], "left_anti").select("_pair.*")


def _second_best(open_: DataFrame) -> DataFrame:
    """The best text outside the class of the bucket's leader, against all of the other classes."""
    lead = open_.groupBy("band", "key").agg(F.max(F.struct("degree", "tid", "label")).alias("_lead"))
    rest = open_.join(lead, ["band", "key"]).filter("label <> _lead.label")
    second = rest.groupBy("band", "key").agg(F.max(F.struct("degree", "tid", "label")).alias("_second"))
    return open_.join(second, ["band", "key"]).filter("label <> _second.label").select(
        F.col("_second.tid").alias("leader"), "tid", F.col("_second.label").alias("a"), F.col("label").alias("b")
    )


def _meeting(open_: DataFrame, texts: DataFrame) -> DataFrame:
    """Within buckets that hold several classes: texts that share a second band, each against one drawn from them.

    A passage that very many documents share fills buckets with texts that are otherwise
    apart. Two texts at the threshold share many bands, so they meet again in a second one,
    while those that only share the passage hardly do.
    """
    bands = texts.select("tid", "bands")
    each = open_.select("band", "key", "tid", "label").join(bands, "tid").select("band", "key", "tid", "label", F.posexplode("bands").alias("_band", "_key"))
    both = F.sort_array(F.array(F.struct("band", "key"), F.struct(F.col("_band").alias("band"), F.col("_key").alias("key"))))
    each = each.filter("band <> _band").select(F.xxhash64(both).alias("meet"), "tid", "label")
    lead = F.max(F.struct(F.xxhash64("meet", "tid").alias("lot"), F.col("tid"), F.col("label"))).alias("_lead")
    crossed = each.groupBy("meet").agg(lead, F.min("label").alias("_lo"), F.max("label").alias("_hi")).filter("_lo <> _hi").select("meet", "_lead")
    return each.join(crossed, "meet").filter("label <> _lead.label").select(
        F.col("_lead.tid").alias("leader"), "tid", F.col("_lead.label").alias("a"), F.col("label").alias("b")
    )


def _spread(size: int):
    """How many texts hold a shingle of each slot, per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for _, _, _, value, _ in shingle_bags(batch.column("text"), size):
                counts += np.bincount((value >> U64(64 - SLOT_BITS)).astype(np.int64), minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["slot", "n"])

    return run


def _rarest(size: int, similarity: float, shared):
    """The first shingles of every text, rare ones before common ones: `num, class, token, rest, total`.

    `rest` is the weight of the text from that shingle on. A shingle is left out once the
    rest is too light for an overlap at `similarity`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity = shared.value
        for batch in batches:
            for lo, hi, owner, value, times in shingle_bags(batch.column("text"), size):
                order = np.lexsort((value, rarity[(value >> U64(64 - SLOT_BITS)).astype(np.int64)], owner))
                value, times = value[order], times[order]
                total = np.bincount(owner, weights=times, minlength=hi - lo).astype(np.int64)
                ahead = np.cumsum(times) - times
                rest = total[owner] - (ahead - (np.cumsum(total) - total)[owner])
                at = np.flatnonzero(rest >= similarity * total[owner] - 1e-6)
                rows = pa.array(owner[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("num").slice(lo, hi - lo).take(rows), batch.column("class").slice(lo, hi - lo).take(rows),
                        pa.array(value[at].view(np.int64)), pa.array(rest[at]), pa.array(total[owner[at]]),
                    ],
                    ["num", "class", "token", "rest", "total"],
                )

    return run


def _completion(open_: DataFrame, texts: DataFrame, similarity: float, size: int) -> DataFrame:
    """All pairs of texts of different classes in `open_` that can reach `similarity`: none that does is left out.

    Shingles have one order, the rare ones first (by counts of a table of fixed size; any
    order is right). The overlap of two texts is at most what either has from their first
    common shingle on, so at that shingle both rests are `similarity / (1 + similarity)` of
    the two totals or more. Texts that share only a common passage differ in all shingles
    before it and do not meet.
    """
    spark = open_.sparkSession
    known = settle(open_.select("tid", "label").distinct().withColumn("num", F.monotonically_increasing_id()), "near-numbers")
    classes = known.groupBy("label").agg(F.min("num").alias("class"))
    laid = settle(known.join(classes, "label").join(texts, "tid").select("num", "class", "text"), "near-open-texts")
    table = laid.mapInArrow(_spread(size), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    rarity = np.zeros(1 << SLOT_BITS, np.int64)
    rarity[table["slot"].to_numpy()] = table["n"].to_numpy()
    shared = spark.sparkContext.broadcast(rarity)
    first = settle(laid.mapInArrow(_rarest(size, similarity, shared), "num long, class long, token long, rest long, total long"), "near-rarest")
    crossed = first.groupBy("token").agg(F.min("class").alias("_lo"), F.max("class").alias("_hi")).filter("_lo <> _hi").select("token")
    first = settle(first.join(crossed, "token", "left_semi"), "near-crossing")
    a = first.select("token", *[F.col(c).alias(f"_{c}") for c in ("num", "class", "rest", "total")])
    share = similarity / (1 + similarity)
    meet = a.join(first, "token").filter(
        f"_num < num and _class <> class and least(_rest, rest) >= {share!r} * (_total + total) - 1e-6"
    )
    pairs = meet.select("_num", "num").distinct()
    left = known.select(F.col("num").alias("_num"), F.col("tid").alias("leader"), F.col("label").alias("a"))
    return pairs.join(left, "_num").join(known.select("num", "tid", F.col("label").alias("b")), "num").select("leader", "tid", "a", "b")


def _classed(docs: DataFrame, similarity: float, size: int, bands: int, rows: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """`doc_id, tid` of every row, and of every text `tid, first, copies, label`: texts of a class have one label."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("tid"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = settle(base.mapInArrow(_sign(bands, rows, size), "doc_id long, tid string, bands array<bigint>"), "near-signatures")
    texts = settle(signed.groupBy("tid").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.first("bands").alias("bands")), "near-texts")
    members = texts.select("tid", F.posexplode("bands").alias("band", "key"))
    crowded = members.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
    inside = settle(members.join(crowded, ["band", "key"]), "near-members")
    degree = inside.groupBy("tid").agg(F.sum("n").alias("degree"))
    inside = settle(inside.join(degree, "tid").drop("n"), "near-degrees")
    wanted = inside.select("tid").distinct().join(texts.select("tid", "first"), "tid")
    # Only one row of each text: its smallest id, and one of the rows that tie on it.
    fetched = base.join(wanted.withColumnRenamed("tid", "_w"), (F.col("tid") == F.col("_w")) & F.col("doc_id").eqNullSafe(F.col("first")))
    fetched = settle(fetched.select("tid", "text").dropDuplicates(["tid"]), "near-fetched")

    best = inside.groupBy("band", "key").agg(F.max(F.struct("degree", "tid")).alias("_lead"))
    pairs = inside.join(best, ["band", "key"]).select(F.col("_lead.tid").alias("leader"), "tid").filter("leader <> tid").distinct()
    done = settle(pairs.select("leader", "tid", F.col("leader").alias("a"), F.col("tid").alias("b")), "near-pairs")
    labels = components(settle(verified(done, fetched, similarity, size), "near-links"))
    named, rest, moved = _labelled(fetched.select("tid"), labels), _labelled(inside, labels), True
    for candidates in (_second_best, lambda x: _meeting(x, texts), lambda x: _completion(x, fetched, similarity, size)):
        if moved:
            open_ = _crossing(rest)
        if open_.isEmpty():
            break
        pairs = settle(_unseen(candidates(open_), done), "near-pairs")
        done = done.unionByName(pairs)
        links = settle(verified(pairs, fetched, similarity, size), "near-links")
        moved = not links.isEmpty()
        if moved:
            labels = components(links)
            named, rest = _relabelled(named, labels), _relabelled(open_, labels)
    classed = _labelled(texts.select("tid", "first", "copies"), named)
    return signed.select("doc_id", "tid"), classed


def _heads(classed: DataFrame) -> DataFrame:
    """Of every class `label, head, class_texts, class_size`; among texts that tie on their first id the smaller digest decides."""
    head = F.min(F.struct(F.col("first").isNull().alias("null"), F.col("first").alias("first"), F.col("tid").alias("tid"))).alias("head")
    return classed.groupBy("label").agg(head, F.count("*").alias("class_texts"), F.sum("copies").alias("class_size"))


def near_duplicates(
    docs: DataFrame, similarity: float = 0.8, size: int = 5, bands: int = 24, rows: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: `doc_id, class_id, class_texts, class_size, keep, tid`.

    `class_id` is the smallest id of the class, `keep` marks one row of it (among rows that
    tie on that id, one of them), `class_texts` counts distinct texts and `class_size` rows.
    Texts without a word are copies of each other only if they are equal byte by byte.
    Null ids are the largest. At a similarity of 0.8 a pair misses all bands with a
    probability of 3e-6.
    """
    signed, classed = _classed(docs, similarity, size, bands, rows, id_col, text_col)
    classed = settle(classed, "near-labelled")
    classed = settle(
        classed.join(_heads(classed), "label").select("tid", F.col("head.first").alias("class_id"), F.col("head.tid").alias("_head"), "class_texts", "class_size"),
        "near-classes",
    )
    # One row of the head's rows with the smallest id, should equal rows repeat.
    out = signed.select("doc_id", "tid", F.monotonically_increasing_id().alias("_row"))
    firsts = out.groupBy("tid").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("_first"))
    keepers = firsts.select("tid", F.col("_first._row").alias("_keep"))
    per_text = settle(classed.join(keepers, "tid"), "near-result")
    return out.join(per_text, "tid").select(
        "doc_id", "class_id", "class_texts", "class_size",
        ((F.col("tid") == F.col("_head")) & (F.col("_row") == F.col("_keep"))).alias("keep"), "tid",
    )


def drop_near_duplicates(
    docs: DataFrame, similarity: float = 0.8, size: int = 5, bands: int = 24, rows: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with one document of each class, all columns as they were. Rows equal in id and text are one."""
    signed, classed = _classed(docs, similarity, size, bands, rows, id_col, text_col)
    repeated = not signed.groupBy("doc_id", "tid").count().filter("count > 1").isEmpty()
    kept = settle(_heads(classed).select(F.col("head.first").alias("_d"), F.col("head.tid").alias("_t")), "near-kept")
    text = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    found = docs.join(kept, (text == F.col("_t")) & F.col(id_col).cast("long").eqNullSafe(F.col("_d")))
    if repeated:
        found = found.dropDuplicates(["_d", "_t"])
    return found.select(*docs.columns)
