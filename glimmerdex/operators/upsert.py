"""Validation, replacement and removal of documents, keyed by document identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glimmerdex.operators.filters import to_column
from glimmerdex.operators.ranking import top_k
from glimmerdex.plans.sizing import broadcast_if_small, is_small, keyed_join


def validate(
    batch: DataFrame, id_col: str = "id", text_col: str = "text", seq_col: str = "ingest_seq",
    vector_col: str | None = None, dims: int | None = None,
) -> DataFrame:
    """The batch with a `reason` column, null for accepted rows.

    Rejected are rows without id or text, vectors of another length than `dims`, and all
    but the latest row of an id that occurs more than once. Repeated ids are found by a partial aggregate; the
    few that are come back by a broadcast, or by a join salted over the order, so
    an id holding much of the batch is never one task's group.
    """
    usable = F.col(id_col).isNotNull() & F.col(text_col).isNotNull()
    if vector_col and dims:
        usable &= F.coalesce(F.size(vector_col) == dims, F.lit(True))
    repeated = (
        batch.filter(usable)
        .groupBy(id_col)
        .agg(F.max(seq_col).alias("_last"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .select(id_col, "_last")
    )
    joined = keyed_join(batch, repeated, [id_col], seq_col, "left")
    reason = (
        F.when(F.col(id_col).isNull(), F.lit("missing_id"))
        .when(F.col(text_col).isNull(), F.lit("missing_text"))
        .when(F.size(vector_col) != dims if vector_col and dims else F.lit(False), F.lit("vector_length"))
        .when(F.col("_last").isNotNull() & (F.col(seq_col) < F.col("_last")), F.lit("replaced_in_batch"))
    )
    return joined.withColumn("reason", reason).select(*batch.columns, "reason")


def latest(documents: DataFrame, before: tuple[Column, ...] = ()) -> DataFrame:
    """One row per key, the one submitted last; `before` settles equal submissions."""
    order = [F.col("ingest_seq").desc(), *before, F.xxhash64("text", "meta_json")]
    return top_k(documents, 1, by=("doc_key",), order=order, rank="_rank").drop("_rank")


def upsert(base: DataFrame, changes: DataFrame) -> DataFrame:
    """Changes replace base rows of the same key unless the base row is newer.

    `base` holds one row per key. Only the changes and the rows they touch are
    shuffled, when the measured size of the changed keys allows a broadcast.
    """
    keys = broadcast_if_small(changes.select("doc_key").distinct())
    untouched = base.join(keys, "doc_key", "left_anti")
    touched = base.join(keys, "doc_key", "left_semi").withColumn("_new", F.lit(0))
    rivals = touched.unionByName(changes.withColumn("_new", F.lit(1)))
    return untouched.unionByName(latest(rivals, (F.col("_new").desc(),)).drop("_new"))


def delete_by_ids(documents: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows go whose key or original id is listed."""
    listed = ids.select(F.col(id_col).cast("string").alias("doc_key")).filter(F.col(id_col).isNotNull()).distinct()
    small = is_small(listed)
    left = keyed_join(documents, listed, ["doc_key"], "uri", "left_anti", small)
    left = keyed_join(left, listed.withColumnRenamed("doc_key", "ext_id"), ["ext_id"], "doc_key", "left_anti", small)
    return left.select(*documents.columns)


def delete_by_query(documents: DataFrame, query) -> DataFrame:
    """Rows go for which the predicate holds; a null predicate keeps the row."""
    predicate: Column = query if isinstance(query, Column) else to_column(query)
    return documents.filter(~F.coalesce(predicate, F.lit(False)))


def delete(documents: DataFrame, ids: DataFrame | None = None, query=None, delete_all: bool = False) -> DataFrame:
    """One entry point; a predicate takes precedence over ids."""
    if isinstance(query, Column) or query:
        return delete_by_query(documents, query)
    if ids is not None:
        return delete_by_ids(documents, ids)
    if delete_all:
        return documents.filter(F.lit(False))
    raise ValueError("give ids, a query, or delete_all=True")
