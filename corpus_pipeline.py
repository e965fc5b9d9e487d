"""The corpus pipeline: language, near-duplicates, decontamination, personal data, mix.

Every stage takes ``documents`` rows (doc_id, text, lang, source, n_chars) and returns
what it keeps of them in the same columns; the last returns the mix. Ids are taken to
be unique: rows that share one are kept or dropped together. A document without an id
cannot be named by any stage, and the first one rejects it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import langid, leaks, mixing, near_text, pii
from tickloom.llm.queries import fold
from tickloom.llm.store import small_batches, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Texts whose word shingles have this similarity, in hundredths, are near-duplicates.
NEAR_PERCENT = 80

#: The mix rests on sampled training and floating sums of earlier stages: no SQL.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; null, blank and letterless texts go, null ``lang`` is filled."""
    docs = docs.select(*COLUMNS)
    small_batches(spark)
    trees = langid.train(spark, docs.where(fold("doc_id", 3) != 1))
    return langid.accepted(spark, docs.where("doc_id is not null"), trees)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id, once."""
    docs = docs.select(*COLUMNS)
    small_batches(spark)
    judged = written(spark, near_text.near_duplicates(spark, docs, percent=NEAR_PERCENT), "judged")
    # Written first: Spark then knows their size when it plans the joins.
    dropped = written(spark, judged.where("not kept").select("doc_id").distinct(), "dropped")
    repeated = written(
        spark, judged.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated"
    )
    kept = docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    docs = docs.select(*COLUMNS)
    small_batches(spark)
    found = leaks.find_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaked = written(spark, found.where("contaminated").select("doc_id").distinct(), "leaked")
    return docs.join(leaked, "doc_id", "left_anti").select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced; ``n_chars`` follows the text."""
    clean = pii.redact_personal_data(small_batches(spark), docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How much of each document the mix takes: see :func:`tickloom.llm.mixing.mix_sources`."""
    return mixing.mix_sources(spark, docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", redact),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
