"""Fetch by id, and retrieval that falls back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glimmerdex.operators.ranking import top_k
from glimmerdex.plans.sizing import is_small, keyed_join, written


def request_table(spark, ids: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(ids)), "pos long, id string")


def get_by_ids(documents: DataFrame, requests: DataFrame) -> DataFrame:
    """Documents in request order, for a table (pos, id).

    An id is a document key or an original id; the key match wins, then the first
    document with that original id. Missing ids give no row, repeated ids repeat.

    Few ids are broadcast and the documents are read once. Many meet the two id columns
    alone in a join; whole documents are read for the keys found.
    """
    wanted = requests.select("id").distinct()
    small = is_small(requests)
    order = [F.col("_choice"), F.col("doc_key")]
    if small:
        asked = F.broadcast(wanted.filter("id IS NOT NULL"))
        by_key, by_name = (asked.select(F.col("id").alias(name)) for name in ("_key", "_name"))
        hit = documents.join(by_key, F.col("doc_key") == F.col("_key"), "left").join(by_name, F.col("ext_id") == F.col("_name"), "left")
        ways = F.array(F.struct(F.col("_key").alias("id"), F.lit(0).alias("choice")), F.struct(F.col("_name").alias("id"), F.lit(1).alias("choice")))
        way = F.explode(F.filter(ways, lambda w: w["id"].isNotNull())).alias("_way")
        found = hit.filter("_key IS NOT NULL OR _name IS NOT NULL").select(*documents.columns, way).select(
            *documents.columns, F.col("_way.id").alias("id"), F.col("_way.choice").alias("_choice")
        )
        best = top_k(found, 1, by=("id",), order=order, rank="_rank")
        return best.join(F.broadcast(requests), "id").select("id", "pos", *documents.columns).orderBy("pos")
    names = F.explode(
        F.array(
            F.struct(F.col("doc_key").alias("id"), F.lit(0).alias("choice")),
            F.struct(F.col("ext_id").alias("id"), F.lit(1).alias("choice")),
        )
    )
    named = documents.select("doc_key", names.alias("_name")).select(
        "doc_key", F.col("_name.id").alias("id"), F.col("_name.choice").alias("_choice")
    )
    matches = keyed_join(named, wanted, ["id"], "doc_key")
    found = top_k(matches, 1, by=("id",), order=order, rank="_rank").select("id", "doc_key")
    resolved = written(keyed_join(requests, found, ["id"], "pos"), "resolved")
    # Few requests share a document: each meets the whole documents once, none of which is repeated.
    keys = resolved.select("doc_key").distinct()
    whole = documents.join(F.broadcast(keys) if is_small(keys) else keys, "doc_key")
    return resolved.join(whole, "doc_key").select("id", "pos", *documents.columns).orderBy("pos")


def with_fallback(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Primary hits, and secondary hits for the queries that have none."""
    first, second = primary.withColumn("_choice", F.lit(0)), secondary.withColumn("_choice", F.lit(1))
    # A query's group is its two result lists; neither search is planned twice.
    chosen = F.min("_choice").over(Window.partitionBy("query_id"))
    both = first.unionByName(second).withColumn("_chosen", chosen)
    return both.filter(F.col("_choice") == F.col("_chosen")).drop("_choice", "_chosen")
