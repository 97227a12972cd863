"""Preparation of a training corpus from documents: each stage works on what the one before kept.

Rows need not have distinct ids: a stage that decides by joining does so on the text or on
the id and the text, so repeated and null ids are decided one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glimmerdex.llm import bpe, decontaminate, pii, quality, simhash
from glimmerdex.llm.registry import free_name, pick, table
from glimmerdex.plans.sizing import keyed_join, scratch_path, written

ORACLE_SQL = None  # learned scores, hash fingerprints and token ids are beyond SQL; tests use brute force


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold. The model learns from this stage's own labelled documents.

    Null and empty texts are scored like any other; repeated rows stay; an empty table stays empty."""
    labels = quality.labels_of(spark, sf_dir)
    texts = pick(docs, doc_id="doc_id", text="text")
    labelled = keyed_join(texts, labels.select("doc_id").distinct(), ["doc_id"], "text", "left_semi")
    stats, column = quality.measured(labelled, keep=["doc_id"])
    model = quality.fit(stats.withColumnRenamed(column, "statistics"), labels)
    score = free_name(docs, "score")
    kept = quality.judged(docs, model, score).filter(F.col(score) >= quality.THRESHOLD)
    return kept.select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near duplicates (three-word shingles, two bits), the one with the
    smallest id (a null counts as smallest), then the smallest hash of its text; of rows that agree in both, one.

    Null and blank texts have fingerprint zero and are one group; an empty table stays empty."""
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, F.struct("doc_id", F.xxhash64("text").alias("text_hash")))
    marked = written(simhash.near_duplicates(keyed, id_col=key), "near-duplicates")
    copies = marked.filter("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct()
    kept = keyed_join(keyed, copies, [key], "text", "left_anti")
    repeated = written(
        marked.groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("rows")).filter("rows > 1").select(key), "repeated"
    )
    if repeated.limit(1).count():
        nth = Window.partitionBy(key).orderBy(key)
        again = keyed_join(kept, repeated, [key], "text", "left_semi").withColumn("nth", F.row_number().over(nth))
        kept = keyed_join(kept, repeated, [key], "text", "left_anti").unionByName(again.filter("nth = 1").drop("nth"))
    return kept.select(*_columns(docs))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with any benchmark item.

    Null and empty texts overlap with nothing and stay, as do repeated rows without an overlap."""
    hashed = free_name(docs, "text_hash")
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text")
    found = decontaminate.contaminated(texts, table(spark, sf_dir, "benchmark"), id_col="text_hash")
    bad = written(found.select(F.col("doc_id").alias(hashed)).distinct(), "contaminated")
    kept = keyed_join(docs.withColumn(hashed, F.xxhash64("text")), bad, [hashed], "doc_id", "left_anti")
    return kept.select(*_columns(docs))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data in their texts replaced and n_chars counted anew.

    No row goes: null texts stay null with a null n_chars, empty ones stay empty."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as token ids, with the text that the ids decode to.

    A null or empty text has no ids and decodes to an empty text; every row keeps its own result."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path(bpe.VOCABULARY))


STAGES = [
    ("quality_classifier", quality_filter),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("pii", without_personal_data),
    ("bpe_codec", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        kept = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(kept)
        docs = spark.read.parquet(kept)
    return docs
