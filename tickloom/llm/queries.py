"""The operators of this folder over the supplied tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import audit, langid, leaks, lm, mixing, near_text, negatives, pii, tokens, toxic, urls, vectors, warc
from tickloom.llm.store import small_batches

VOCABULARY = "word_bpe_49k.json"
RULES: list[urls.Rule] = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, n: int):
    """The fold of a row among ``n``, by the checksum of its id; 0 without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % n, F.lit(0))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.near_duplicates(spark, _table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(spark, _table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(spark, _table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark, _table(spark, sf_dir, "pages"), RULES)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 7) == 2
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", held_out)
    return lm.score_texts(spark, docs).withColumn("held_out", held_out)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, _table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    trees = langid.train(spark, docs.where(~held_out))
    return langid.identify(spark, docs, trees).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(spark, _table(spark, sf_dir, "documents"))


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(spark, _table(spark, sf_dir, "embeddings"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(spark, _table(spark, sf_dir, "embeddings").withColumn("label", label))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    model = toxic.train(spark, docs.where(~held_out), _table(spark, sf_dir, "labels"))
    return toxic.find_toxic(spark, docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "spans")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_minhash_dedup,
        op2_source_mix,
        op3_token_counts,
        op4_url_filter,
        op5_lm_score,
        op6_decontaminate,
        op7_warc,
        op8_language,
        op9_pii,
        op10_vector_dedup,
        op11_hard_negatives,
        op12_toxicity,
        op13_filter_audit,
    )
    return {query.__name__: query for query in found}


_COMPONENTS = """
, both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links)
, reach AS (
  SELECT a AS id, a AS root FROM both_ways
  UNION
  SELECT l.b, r.root FROM reach r JOIN both_ways l ON l.a = r.id
)
, roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id)
"""

_OP1 = (
    r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_transform(range(1, len(w) - 3), lambda i: w[i : i + 4]) END) AS s
  FROM worded
), sized AS (
  SELECT d.doc_id, count(s.doc_id) AS n FROM documents d LEFT JOIN shingled s ON s.doc_id = d.doc_id GROUP BY d.doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingled x JOIN shingled y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b
  WHERE 100 * k >= 85 * (p.n + q.n - k)
)
"""
    + _COMPONENTS
    + """
SELECT z.doc_id, z.n AS n_shingles, coalesce(r.root, z.doc_id) AS component_id,
       z.doc_id = coalesce(r.root, z.doc_id) AS kept
FROM sized z LEFT JOIN roots r ON r.id = z.doc_id
"""
)

_OP7 = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), largest AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM hashed
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM largest
"""

_OP10 = (
    """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), normed AS (
  SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM usable
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM normed x JOIN normed y
    ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e)
  WHERE list_inner_product(x.e, y.e) / (x.norm * y.norm) >= 0.98
)
"""
    + _COMPONENTS
    + """
, linked AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT v.vec_id, coalesce(k.n, 0)::BIGINT AS n_links, coalesce(r.root, v.vec_id) AS component_id,
       v.vec_id = coalesce(r.root, v.vec_id) AS kept
FROM embeddings v LEFT JOIN linked k ON k.id = v.vec_id LEFT JOIN roots r ON r.id = v.vec_id
"""
)

SQL = {
    "op1_minhash_dedup": _OP1,
    "op2_source_mix": mixing.ORACLE.format(documents="documents"),
    "op7_warc": _OP7,
    "op10_vector_dedup": _OP10,
    "op11_hard_negatives": negatives.ORACLE,
    "op13_filter_audit": audit.ORACLE,
}
