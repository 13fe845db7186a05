"""Queries of the training-data operators over whole tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulletin.llm import (
    centroids, decontaminate, exact_dedup, fingerprints, html_density, language_id, lexical_search, mixing, near_dedup, repeats, secret_scan,
    sharding, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs).select("doc_id", "shard", "shard_bytes", "shard_docs")


ORACLES["op2_shard"] = """
WITH keyed AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))), 1, 15))::BIGINT AS key
  FROM documents
), nodes AS (
  SELECT d.depth, key >> (60 - d.depth)::INTEGER AS prefix, sum(bytes) AS bytes, count(*) AS docs, count(DISTINCT key) AS keys
  FROM keyed, (SELECT unnest(range(0, 25)) AS depth) d GROUP BY 1, 2
), leaves AS (
  SELECT k.doc_id, n.*, row_number() OVER (PARTITION BY k.key, k.doc_id ORDER BY n.depth) AS nth
  FROM keyed k JOIN nodes n ON n.prefix = k.key >> (60 - n.depth)::INTEGER
  WHERE n.bytes <= 67108864 OR n.keys = 1
)
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INTEGER, '0') END AS shard,
  bytes::BIGINT AS shard_bytes, docs::BIGINT AS shard_docs
FROM leaves WHERE nth = 1
"""


@_query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op5_exact_dedup"] = """
WITH norm AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM norm WINDOW w AS (PARTITION BY t)
"""


@_query
def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


@_query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.matches(docs, items).select("doc_id", "item_id", "similarity", "start_word")


# The test items have five words or more.
ORACLES["op9_decontaminate"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark
), ds AS (
  SELECT doc_id, len(w) AS n, p - 1 AS pos, array_to_string(w[p:p + 4], ' ') AS s FROM dw, unnest(range(1, len(w) - 3)) AS t(p)
), its AS (
  SELECT item_id, len(w) AS item_words, array_to_string(w[p:p + 4], ' ') AS s FROM iw, unnest(range(1, len(w) - 3)) AS t(p)
), kinds AS (
  SELECT item_id, item_words, s, count(*) AS n FROM its GROUP BY ALL
), spots AS (
  SELECT DISTINCT d.doc_id, k.item_id, k.item_words, greatest(least(d.pos, d.n - k.item_words), 0) AS start
  FROM ds d JOIN kinds k ON d.s = k.s
), held AS (
  SELECT p.doc_id, p.item_id, p.item_words, p.start, d.s, count(*) AS n
  FROM spots p JOIN ds d ON d.doc_id = p.doc_id AND d.pos BETWEEN p.start AND p.start + p.item_words - 5 GROUP BY ALL
), shared AS (
  SELECT h.doc_id, h.item_id, h.item_words, h.start, sum(h.n) AS own, sum(least(h.n, coalesce(k.n, 0))) AS common
  FROM held h LEFT JOIN kinds k ON h.item_id = k.item_id AND h.s = k.s GROUP BY ALL
), scored AS (
  SELECT doc_id, item_id, start, common / (own + item_words - 4 - common) AS similarity FROM shared
)
SELECT doc_id, item_id, max(similarity) AS similarity, arg_max(start, (similarity, -start))::BIGINT AS start_word
FROM scored WHERE similarity >= 0.8 GROUP BY ALL
"""


@_query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~language_id.held_out()))
    said = language_id.identify(docs.select("doc_id", "text", language_id.held_out().alias("held_out")), model)
    return said.select("doc_id", "held_out", "lang_pred", "score", "rejected", "cross_entropy")


@_query
def op6_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@_query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_warc(_table(spark, sf_dir, "pages"))
    return warc.read_warc(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = secret_scan.train(secret_scan.default_samples(docs))
    return secret_scan.report(secret_scan.scan(docs, model))


@_query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_texts", "class_size", "keep")


@_query
def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return found.select(
        "doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


_BASE32 = "concat(" + ", ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha, {1 + 5 * (i // 4)}, 5))::BIGINT >> {15 - 5 * (i % 4)}) & 31)::INTEGER + 1, 1)"
    for i in range(32)
) + ")"
ORACLES["op4_warc"] = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> max(page_id) OVER w THEN max(page_id) OVER w END AS refers_to
FROM p WINDOW w AS (PARTITION BY html)
"""


@_query
def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


ORACLES["op11_search"] = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), held AS (
  SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), docs AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY ALL
), corpus AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM docs
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term
), impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS impact
  FROM held JOIN weights USING (term) JOIN docs USING (doc_id), corpus
), scored AS (
  SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""


@_query
def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_neighbours(_table(spark, sf_dir, "documents"))


@_query
def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def _rounds(rounds: int) -> str:
    """Assignment and mean of every round, as common table expressions."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""pairs{r} AS (
  SELECT p.vec_id, c.cluster, c.v AS center, p.v, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
  FROM points p, centers{r} c
), near{r} AS (
  SELECT vec_id, v, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM pairs{r} GROUP BY vec_id, v
)""")
        if r < rounds:
            out.append(f"""means{r} AS (
  SELECT cluster, list(mean ORDER BY place) AS v FROM (
    SELECT cluster, place, floor(sum(x)::DOUBLE / count(*))::BIGINT AS mean
    FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS place FROM near{r}) y GROUP BY ALL
  ) x GROUP BY cluster
), centers{r + 1} AS (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM centers{r} c LEFT JOIN means{r} m USING (cluster)
)""")
    return ", ".join(out)


# The sums of the test tables are far below 2^53, so that a floor in doubles is exact.
ORACLES["op13_clusters"] = f"""
WITH points AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), centers0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, v FROM points ORDER BY sha256('1:' || vec_id) LIMIT 16
), {_rounds(3)}
SELECT n.vec_id, n.cluster::INTEGER AS cluster, n.distance, (sum(n.distance) OVER (PARTITION BY n.cluster))::BIGINT AS cluster_inertia,
  (sum(n.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM near3 n JOIN centers3 c USING (cluster)
"""
