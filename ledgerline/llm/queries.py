"""The registered queries: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, html, jaccard, knn, licenses, lm, negatives, packing, phrases, quality, sharding, toxicity, warc
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS, OLD_SHARDS = 16, 12
TOXIC_FROM = 0.7


def tokenizer_file(name: str) -> str:
    """Where the box keeps a public vocabulary; elsewhere pass another path."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), digests_only=True)


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op8_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 12 shards by key hash to 16 of near equal bytes; text and slots are read from the files written."""
    old = F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS))
    written = sharding.reshard(table(spark, sf_dir, "documents"), old, SHARDS)
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    done = sharding.slots(written.withColumn("text_crc32", crc).drop("text"))
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op9_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(knn.integer_vectors(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0, 5)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th row; the label of every 7th is moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.labelled_vectors(table(spark, sf_dir, "embeddings").withColumn("label", moved))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Query] = {
    "op1_lm": op1_lm,
    "op2_html": op2_html,
    "op3_quality": op3_quality,
    "op4_bpe": op4_bpe,
    "op5_jaccard": op5_jaccard,
    "op6_toxicity": op6_toxicity,
    "op7_pack": op7_pack,
    "op8_reshard": op8_reshard,
    "op9_knn": op9_knn,
    "op10_warc": op10_warc,
    "op11_licenses": op11_licenses,
    "op12_phrases": op12_phrases,
    "op13_negatives": op13_negatives,
}

_OP5 = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[k:k + 3], ' ') END AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS k FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

_OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""

_OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hexes FROM pages
), g AS (SELECT hexes, max(page_id) AS target FROM p GROUP BY hexes)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(p.hexes, (1 + 5 * (i // 4))::INTEGER, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = target THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = target THEN NULL ELSE target END AS refers_to
FROM p JOIN g ON g.hexes = p.hexes
"""

_OP12 = """
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS p FROM t)
), windows AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, range(1, 5) AS sizes(m) WHERE len(w) >= m)
), f AS (SELECT lang, m, phrase, count(*) AS f FROM windows GROUP BY lang, m, phrase
), n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
), cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 30
), cuts AS (
  SELECT lang, m, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)
), scored AS (
  SELECT c.*, l.f AS l, r.f AS r, (2000000::HUGEINT * a) // (l.f + r.f) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.x JOIN f r ON r.lang = c.lang AND r.phrase = c.y
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS around
  FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM cand, range(2, 4) AS sizes(s) WHERE s < m) GROUP BY ALL
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM (SELECT z.*, row_number() OVER (PARTITION BY z.lang ORDER BY z.score DESC, z.a DESC, z.phrase) AS rank
      FROM lowest z LEFT JOIN inside i ON i.lang = z.lang AND i.phrase = z.phrase
      WHERE i.around IS NULL OR 100::HUGEINT * i.around < 80::HUGEINT * z.a) JOIN n USING (lang)
WHERE rank <= 2000
"""

_OP13 = """
WITH v AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
  s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""

ORACLE_SQL: dict[str, str] = {"op5_jaccard": _OP5, "op9_knn": _OP9, "op10_warc": _OP10, "op12_phrases": _OP12, "op13_negatives": _OP13}
