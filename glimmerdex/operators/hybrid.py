"""Fusion of keyword and vector candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glimmerdex import decisions as D
from glimmerdex.operators.filters import min_score as drop_below
from glimmerdex.operators.filters import to_column
from glimmerdex.operators.lexical import LexicalIndex, lexical_leg
from glimmerdex.operators.ranking import most_rows, rounded, top_k
from glimmerdex.operators.shaping import attach_documents
from glimmerdex.operators.vector import check_vectors, vector_pool
from glimmerdex.plans.sizing import keyed_join

JOIN_OF_MODE = {
    "union": "full_outer",
    "keywords_required": "left",
    "meaning_required": "right",
    "intersection": "inner",
}


def check_mode(mode: str) -> None:
    if mode not in D.MODES:
        raise ValueError(f"unknown mode {mode!r}; there are {', '.join(D.MODES)}")


def check_alpha(alpha: float) -> None:
    if not 0.0 <= alpha <= 1.0:
        raise ValueError(f"alpha must lie between 0 and 1, got {alpha!r}")


def normalised_lexical(lexical: DataFrame, norm_k: float | None = None) -> DataFrame:
    """Raw keyword scores in 0..1: over the best of the query, or saturating s / (s + k)."""
    score = F.col("raw")
    if norm_k is not None:
        scaled = score / (score + F.lit(float(norm_k)))
    else:
        # A query's group is its candidate pool, which is bounded.
        scaled = score / F.max(score).over(Window.partitionBy("query_id"))
    return lexical.withColumn("lex", scaled)


def joined_pools(lexical: DataFrame, vector: DataFrame, mode: str, norm_k: float | None = None) -> DataFrame:
    """(query_id, doc_key, lex, sem); a mode is a join type, a missing side counts 0.

    Raw scores are fused, so that rounding happens once, at the end.
    """
    check_mode(mode)
    left = normalised_lexical(lexical, norm_k).select("query_id", "doc_key", "lex")
    right = vector.select("query_id", "doc_key", F.col("raw").alias("sem"))
    return left.join(right, ["query_id", "doc_key"], JOIN_OF_MODE[mode]).fillna(0.0, ["lex", "sem"])


def fuse(pools: DataFrame, lexical_weight: float, vector_weight: float) -> DataFrame:
    total = lexical_weight + vector_weight
    if total <= 0:
        raise ValueError("lexical and vector weight must not both be zero")
    mixed = (F.lit(float(lexical_weight)) * F.col("lex") + F.lit(float(vector_weight)) * F.col("sem")) / F.lit(float(total))
    return pools.select("query_id", "doc_key", mixed.alias("score"))


def quality_boost(hits: DataFrame, quality: DataFrame, boost: float) -> DataFrame:
    """score x (1 + boost x quality); `quality` is (doc_key, quality), unknown counts 0."""
    factor = F.lit(1.0) + F.lit(float(boost)) * F.coalesce(F.col("quality").cast("double"), F.lit(0.0))
    rows = keyed_join(hits, quality.select("doc_key", "quality"), ["doc_key"], "query_id", "left")
    return rows.withColumn("score", F.col("score") * factor).drop("quality")


def freshness_factor(timestamp: Column, as_of: str, boost: float) -> Column:
    age = F.greatest(F.datediff(F.lit(as_of).cast("date"), timestamp.cast("date")), F.lit(0))
    # Without a date there is no gain; `greatest` alone would take it for today's.
    gain = F.when(timestamp.isNotNull(), F.exp(-age / F.lit(D.FRESHNESS_DAYS)))
    return F.lit(1.0) + F.lit(float(boost)) * F.coalesce(gain, F.lit(0.0))


def freshness_boost(
    hits: DataFrame, documents: DataFrame, boost: float, as_of: str, timestamp: str = "timestamp", at_most: int | None = None
) -> DataFrame:
    """score x (1 + boost x exp(-age in days / 30)), age against an explicit date."""
    rows = attach_documents(hits, documents, [timestamp], at_most)
    factor = freshness_factor(F.col(timestamp), as_of, boost)
    return rows.withColumn("score", F.col("score") * factor).drop(timestamp)


def hybrid_pools(
    index: LexicalIndex | DataFrame, queries: DataFrame, k: int, pool: int | None = None, where=None,
    weights: dict[str, float] | None = None, min_match=None, field: str = "embedding", vectors: DataFrame | None = None,
    vector_topk: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Keyword and vector candidates under the same filter; `vector_topk` sizes the vector pool alone.

    `vectors` may name a table with doc_key and the vector when the vectors are
    kept apart from the documents.
    """
    documents = index.documents if isinstance(index, LexicalIndex) else index
    vector_side = documents if vectors is None else vectors
    check_vectors(vector_side, field)
    size = D.pool_size(k, pool)
    lexical = lexical_leg(index, queries, k, where, size, weights, min_match)
    predicate = to_column(where)
    if vectors is not None and predicate is not None:
        vector_side = vectors.join(documents.filter(predicate).select("doc_key"), "doc_key", "left_semi")
        predicate = None
    return lexical, vector_pool(vector_side, queries, vector_topk or size, field, predicate)


def hybrid_search(
    index: LexicalIndex | DataFrame, queries: DataFrame, k: int = D.DEFAULT_K, mode: str = "union", alpha: float = 0.5,
    where=None, pool: int | None = None, weights: dict[str, float] | None = None, field: str = "embedding",
    vectors: DataFrame | None = None,
) -> DataFrame:
    """(query_id, doc_key, score, rank); alpha 0 is all meaning, 1 all keywords."""
    check_mode(mode)
    check_alpha(alpha)
    lexical, vector = hybrid_pools(index, queries, k, pool, where, weights, None, field, vectors)
    fused = fuse(joined_pools(lexical, vector, mode), alpha, 1.0 - alpha)
    return top_k(fused.withColumn("score", rounded(F.col("score"))), k)


def alpha_sweep(
    index: LexicalIndex | DataFrame, queries: DataFrame, alphas: list[float], k: int = D.DEFAULT_K, mode: str = "union",
    where=None, pool: int | None = None, field: str = "embedding", vectors: DataFrame | None = None,
) -> DataFrame:
    """(alpha, query_id, doc_key, score, rank): every balance over the same candidates."""
    check_mode(mode)
    for alpha in alphas:
        check_alpha(alpha)
    pools = joined_pools(*hybrid_pools(index, queries, k, pool, where, field=field, vectors=vectors), mode)
    alpha = F.explode(F.array(*[F.lit(float(a)) for a in alphas]))
    mixed = F.col("alpha") * F.col("lex") + (F.lit(1.0) - F.col("alpha")) * F.col("sem")
    swept = pools.withColumn("alpha", alpha).select("alpha", "query_id", "doc_key", rounded(mixed).alias("score"))
    return top_k(swept, k, by=("alpha", "query_id"))


def mode_sweep(
    index: LexicalIndex | DataFrame, queries: DataFrame, modes: tuple[str, ...] = D.MODES, k: int = D.DEFAULT_K,
    alpha: float = 0.5, where=None, pool: int | None = None, field: str = "embedding", vectors: DataFrame | None = None,
) -> DataFrame:
    """(mode, query_id, doc_key, score, rank): every matching mode over the same candidates, which are found once."""
    check_alpha(alpha)
    for mode in modes:
        check_mode(mode)
    lexical, vector = hybrid_pools(index, queries, k, pool, where, field=field, vectors=vectors)
    left = normalised_lexical(lexical).select("query_id", "doc_key", "lex")
    right = vector.select("query_id", "doc_key", F.col("raw").alias("sem"))
    both = left.join(right, ["query_id", "doc_key"], "full_outer")
    has = {"left": F.col("lex").isNotNull(), "right": F.col("sem").isNotNull()}
    has |= {"full_outer": F.lit(True), "inner": has["left"] & has["right"]}
    kept = F.array_compact(F.array(*[F.when(has[JOIN_OF_MODE[mode]], F.lit(mode)) for mode in modes]))
    lex, sem = (F.coalesce(c, F.lit(0.0)) for c in ("lex", "sem"))
    mixed = F.lit(float(alpha)) * lex + F.lit(1.0 - alpha) * sem
    swept = both.select(F.explode(kept).alias("mode"), "query_id", "doc_key", rounded(mixed).alias("score"))
    return top_k(swept, k, by=("mode", "query_id"))


def tuned_search(
    index: LexicalIndex | DataFrame, queries: DataFrame, knobs: dict, rows: int = D.TUNED_DEFAULT_ROWS, where=None,
    quality: DataFrame | None = None, as_of: str | None = None, field: str = "embedding", vectors: DataFrame | None = None,
) -> DataFrame:
    """One search with every knob: fuse, then boosts, then the score limit, then the top rows."""
    documents = index.documents if isinstance(index, LexicalIndex) else index
    mode = knobs["search_mode"]
    check_mode(mode)
    vector_topk = D.pool_size(rows, knobs["vector_topk"])
    lexical, vector = hybrid_pools(
        index, queries, rows, None, where, knobs["weights"], knobs["mm"], field, vectors, vector_topk
    )
    pools = joined_pools(lexical, vector, mode, knobs["lexical_norm_k"])
    hits = fuse(pools, knobs["lexical_weight"], knobs["vector_weight"])
    at_most = most_rows(queries, D.pool_size(rows) + vector_topk)
    if knobs["quality_boost"] and quality is not None:
        hits = quality_boost(hits, quality, knobs["quality_boost"])
    if knobs["freshness_boost"]:
        if as_of is None:
            raise ValueError("a freshness boost needs as_of")
        hits = freshness_boost(hits, documents, knobs["freshness_boost"], as_of, at_most=at_most)
    hits = hits.withColumn("score", rounded(F.col("score")))
    if knobs["min_score"] is not None:
        hits = drop_below(hits, knobs["min_score"])
    return top_k(hits, rows)
