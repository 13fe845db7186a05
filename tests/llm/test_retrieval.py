"""Ranked search, fingerprints and clustering against plain Python on small tables."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from bulletin.llm import centroids, fingerprints, lexical_search

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"
WORDS = [a + b for a in ("ka", "Mo", "zü", "77", "w") for b in ("ri", "TA", "né", "0", "")]


def texts(rng, n, longest=60):
    return [(i, " ,.-\n"[rng.randrange(5)].join(rng.choices(WORDS, k=rng.randrange(longest)))) for i in range(n)]


# --- ranked search -----------------------------------------------------------


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def bag(text):
    return Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text or "")))


def ranked(docs, items, k):
    bags = [(i, bag(t)) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(bag(text))
    out = []
    for item, terms in asked.items():
        found = []
        for i, b in bags:
            m = 50 + (50 * b.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 20 * m)) for t in terms if t in b)
            if score > 0:
                found.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,leaf,block_terms", [(1, 4, 1 << 14), (2, 1, 20)])
def test_search_equals_brute_force(spark, seed, leaf, block_terms):
    rng = random.Random(seed)
    docs = texts(rng, 300) + [(900 + i, "ka ri né") for i in range(60)] + [(5, "ka ri né"), (None, "ka ri né"), (7, None), (8, ""), (9, "... !")]
    docs += [(None, "zü w"), (1000, "w " * 30_000)]
    items = texts(rng, 12, 9) + [(3, "kari w0"), (50, None), (51, ""), (None, "né motA")]
    frame = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS score", "'x' AS term").repartition(3)
    got = lexical_search.search(frame, spark.createDataFrame(items, ITEMS), k=7, leaf=leaf, tree_docs=64, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == ranked(docs, items, 7)


def test_search_of_nothing(spark):
    some, none = spark.createDataFrame([(1, "a")], DOCS), spark.createDataFrame([], DOCS)
    items = some.withColumnRenamed("doc_id", "item_id")
    assert lexical_search.search(none, items).count() == 0
    assert lexical_search.search(some, items.limit(0)).count() == 0


def random_rows(rng, n, width):
    held = [np.sort(rng.choice(width, rng.integers(0, width), replace=False)) for _ in range(n)]
    ptr = np.concatenate([[0], np.cumsum([len(h) for h in held])])
    return lexical_search.Sparse(ptr, np.concatenate(held), rng.integers(0, 26_000_000_000, ptr[-1]))


@pytest.mark.parametrize("seed", range(4))
def test_no_document_exceeds_the_bound_of_its_ball(seed):
    rng = np.random.default_rng(seed)
    rows = random_rows(rng, 150, 40)
    tree = lexical_search.BallTree(rows, 40, 5)
    queries = rng.random((40, 12)) < 0.3
    bound = tree.bounds(queries.astype(float))
    dense = np.zeros((150, 40))
    dense[np.repeat(np.arange(150), np.diff(rows.ptr)), rows.at] = rows.values
    scores = dense @ queries

    def below(node):
        return tree.leaves[node][0] if tree.leaves[node] else np.concatenate([below(c) for c in tree.children[node]])

    assert sorted(below(0)) == list(range(150))
    for node in range(len(tree.children)):
        assert (scores[below(node)].max(0) <= bound[node]).all()
        assert tree.leaves[node] is None or len(tree.leaves[node][0]) <= 5


def test_distant_subtrees_are_not_scored():
    # Two topics without a common term: a query on one prunes the other.
    ptr = np.arange(0, 401)
    rows = lexical_search.Sparse(ptr, np.repeat([0, 1], 200), np.full(400, 10**9))
    rows.values[:200] += np.arange(200) * 1000
    tree = lexical_search.BallTree(rows, 2, 8)
    mask = np.array([True, False])
    best = lexical_search.Best(5)
    scored = lexical_search.descend(tree, tree.bounds(mask[:, None].astype(float))[:, 0], mask, np.arange(400), np.zeros(400, bool), best)
    assert best.ids.tolist() == [199, 198, 197, 196, 195] and scored < 100


# --- fingerprints ------------------------------------------------------------

MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_longs(values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest((v & MASK).to_bytes(8, "little"), seed=h)
    return signed(h)


def plain_sketch(text, size, scale):
    w = [signed(xxhash.xxh64_intdigest(x.encode(), seed=42)) for x in re.split("[ \t\n\x0b\x0c\r]+", text.lower()) if x]
    runs = [hash_longs(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [hash_longs(w)] if w else []
    return hash_longs(w), sorted({h for h in runs if h < -(1 << 63) + (1 << 64) // scale})


def plain_print(s):
    return f"{s[0] & MASK:016x}:" + "".join(f"{(h ^ -(1 << 63)) & MASK:016x}" for h in s[1])


def plain_likeness(a, b):
    if a[0] == b[0]:
        return 1.0
    fewer = min(len(a[1]), len(b[1]))
    return len(set(a[1]) & set(b[1])) / fewer if fewer else 0.0


@pytest.mark.parametrize("size,scale,range_bytes", [(5, 8, 1 << 26), (2, 2, 400), (3, 1, 60)])
def test_fingerprints_equal_brute_force(spark, size, scale, range_bytes):
    rng = random.Random(scale)
    docs = [(i * 3, t) for i, t in texts(rng, 90)] + [(-5, None), (400, ""), (401, "  \t"), (402, "Same Words here"), (403, "same words  here")]
    docs += [(500, " ".join(rng.choices(WORDS, k=5000))), (501, "𝄞é🙂 " * 9)]
    frame = spark.createDataFrame(docs, DOCS).selectExpr("*", "'x' AS fingerprint", "1 AS own").repartition(4)
    got = {r.doc_id: r for r in fingerprints.fingerprint_neighbours(frame, size, scale, range_bytes=range_bytes).collect()}
    assert len(got) == len(docs)
    order = sorted(docs, key=lambda d: -d[0])
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        t, after = t or "", after or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        own, other, changed = (plain_sketch(x, size, scale) for x in (t, after, edited))
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (plain_print(own), plain_print(changed))
        assert (r.near_edited, r.near_next) == (plain_likeness(own, changed), plain_likeness(own, other))


def test_fingerprints_of_repeated_null_and_single_rows(spark):
    rows = [(None, "a b"), (None, "c d"), (1, "x y z"), (1, "x y z"), (1, "x y z"), (2, "q")]
    got = fingerprints.fingerprint_neighbours(spark.createDataFrame(rows, DOCS), range_bytes=3).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(i), len(t)) for i, t in rows)
    assert len({r.fingerprint for r in got if r.doc_id == 1}) == 1
    single = fingerprints.fingerprint_neighbours(spark.createDataFrame([(4, "one two")], DOCS)).collect()[0]
    assert single.near_next == 1.0 and single.edited_sha256 == hashlib.sha256(b"one one").hexdigest()
    assert fingerprints.fingerprint_neighbours(spark.createDataFrame([], DOCS)).count() == 0


def test_sketches_merge_and_estimate_containment(spark):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(4000))
    part = " ".join(long.split(" ")[1000:1800])
    s = lambda c: fingerprints.sketch(F.col(c))
    both = F.concat_ws(" | | | | | ", "long", "part")
    r = spark.createDataFrame([(long, part)], "long string, part string").select(
        fingerprints.containment(s("part"), s("long")).alias("inside"), fingerprints.containment(s("long"), s("part")).alias("outside"),
        fingerprints.jaccard(s("long"), s("part")).alias("jaccard"),
        fingerprints.merged(s("long"), s("part")).alias("merged"), fingerprints.sketch(both)["hashes"].alias("whole"),
    ).first()
    assert r.inside == 1.0 and 0.12 < r.outside < 0.28 and 0.12 < r.jaccard < 0.28
    assert set(r.merged) <= set(r.whole) and len(r.whole) - len(r.merged) < 12


def test_fingerprints_run_without_python(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], DOCS)
    plan = fingerprints.fingerprint_neighbours(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- clustering --------------------------------------------------------------


def plain_clusters(rows, k, rounds, dims):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [list(v) for _, v in order[:k]]
    dist = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    nearest = lambda v: min(range(len(centers)), key=lambda j: (dist(v, centers[j]), j))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v), []).append(v)
        for j, own in groups.items():
            centers[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    said = [(i, nearest(v), dist(v, centers[nearest(v)])) for i, v in kept]
    inertia = Counter()
    for _, j, d in said:
        inertia[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for i, j, d in said), key=str)


@pytest.mark.parametrize("k,dims,rounds", [(5, 6, 3), (16, 3, 2), (300, 4, 1)])
def test_clusters_equal_brute_force(spark, k, dims, rounds):
    rng = random.Random(k)
    # Few distinct coordinates: many equal distances and equal centroids.
    rows = [(i, [rng.choice([-0.51, -0.02, 0.0, 0.25, 1.0]) for _ in range(dims)]) for i in range(200)]
    rows += [(i, [0.25] * dims) for i in range(200, 290)] + [(7, [0.25] * dims), (None, [1.5] * dims), (None, [0.5] * dims)]
    rows += [(600, None), (601, [0.1] * (dims + 1)), (602, [None] + [0.1] * (dims - 1)), (603, [float("nan")] * dims), (604, [float("inf")] + [0.0] * (dims - 1)), (605, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS cluster", "'x' AS v").repartition(3)
    got = centroids.cluster(frame, k=k, rounds=rounds, dims=dims)
    assert sorted(map(tuple, got.collect()), key=str) == plain_clusters(rows, k, rounds, dims)


def test_clusters_of_nothing(spark):
    got = centroids.cluster(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>"))
    assert got.count() == 0
    full = centroids.cluster(spark.createDataFrame([(1, [1.0] * 64)], "vec_id long, embedding array<float>"))
    assert full.dtypes == got.dtypes and full.count() == 1


def test_tournament_keeps_the_smaller_number_on_ties():
    points = np.array([[2, 0], [0, 0], [0, 0], [1, 5]], np.int64)
    best = centroids.tournament(np.array([[0, 0], [1, 0], [2, 0], [1, 4]], np.int64), *centroids.planes(points))
    assert best.tolist() == [1, 0, 0, 3]


def test_components_beyond_the_exact_range_are_refused(spark):
    rows = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="in magnitude"):
        centroids.cluster(rows).collect()
