"""Which windows of a document are verified, and how their shingles are hashed; signatures whatever their steps."""

import io
import random
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from bulletin.llm import decontaminate, near_dedup


def test_shingles_are_hashed_by_compiled_code(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c"), (3, ""), (4, "x y z z y")], "doc_id long, text string")
    words = docs.select("doc_id", F.transform(decontaminate.words(F.col("text")), lambda w: F.xxhash64(w)).alias("_h"))
    for size in (1, 3, 5):
        each = decontaminate.shingle_rows(words, size)
        plain = words.select("doc_id", F.size("_h").alias("_n"), F.posexplode(decontaminate.shingles(F.col("_h"), size)).alias("_pos", "_hash"))
        assert sorted(each.collect()) == sorted(plain.collect())
    text = io.StringIO()
    with redirect_stdout(text):
        each.agg(F.bit_xor("_hash")).explain()
    assert text.getvalue().count("lambdafunction") == 1  # the words' hashes


@pytest.mark.parametrize("similarity", [0.5, 0.8, 1.0])
def test_windows_with_too_few_shared_shingles_are_left_out(spark, similarity):
    r = random.Random(9)
    rows = []
    for i in range(400):
        n, item, q = r.randrange(5, 40), r.randrange(5, 25), 5
        places = sorted(r.sample(range(n - q + 1), r.randrange(1, n - q + 2)))
        rows.append((i, places, n, item, q))
    frame = spark.createDataFrame(rows, "i int, places array<int>, n int, item int, q int")
    got = frame.select("i", decontaminate.full_windows(F.col("places"), F.col("n"), F.col("item"), F.col("q"), similarity).alias("s"))
    left = 0
    for (i, places, n, item, q), found in zip(rows, [x.s for x in got.orderBy("i").collect()], strict=True):
        starts = sorted({max(min(p, n - item), 0) for p in places})
        own, wanted = min(n, item) - q + 1, item - q + 1
        common = lambda s: sum(s <= p < s + own for p in places)  # noqa: E731, B023
        assert found == [s for s in starts if common(s) >= similarity * (own + wanted - common(s)) - 1e-9], i
        left += len(starts) - len(found)
    assert left > 500


def test_signatures_do_not_depend_on_when_processes_stop(monkeypatch):
    rng = np.random.default_rng(2)
    owner = np.sort(rng.integers(0, 40, 600))
    value, times = rng.integers(0, 2**63, 600, dtype=np.uint64), rng.integers(1, 9, 600)
    bags = owner, value, times, 40, 96
    seldom = near_dedup.bag_signatures(*bags)
    monkeypatch.setattr(near_dedup, "OFTEN", 1)
    assert (near_dedup.bag_signatures(*bags) == seldom).all()
