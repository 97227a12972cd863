"""Registered queries: keyword, vector and hybrid search, ranking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glimmerdex import decisions as D
from glimmerdex.functions.text import ACCENTED, PLAIN, tokens
from glimmerdex.operators import filters, hybrid, lexical, lookup, ranking, tuning, vector
from glimmerdex.operators.filters import min_score
from glimmerdex.plans import inputs as I
from glimmerdex.plans.inputs import query
from glimmerdex.plans.sizing import scratch_path
from glimmerdex.sources.index_store import publish_lexical

HITS = ("query_id", "rank", "doc_key", "score")
ALL_FIELDS = ["title", "description", "text"]


def _hits(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(*extra, *HITS)


def _lexical_sql(weights, k, where="true", tail="SELECT query_id, rank, doc_key, score FROM top", fields=None, matched="true"):
    return f"""WITH {I.IDX}, {I.ASKED}, {I.sql_lexical(weights, where=where, fields=fields)},
{I.sql_top("top", "lex", k, where=matched)} {tail}"""


# -- keyword search -----------------------------------------------------------


@query("tokenize", f"WITH {I.IDX}, t AS (SELECT doc_key, {I.sql_tokens('text')} AS w FROM idx) "
       "SELECT doc_key, unnest(range(len(w))) AS pos, unnest(w) AS term FROM t")
def tokenize(spark, sf):
    return I.documents(spark, sf).select("doc_key", F.posexplode(tokens("text")).alias("pos", "term"))


@query("postings", f"WITH {I.IDX}, {I.sql_field_terms(I.plain_fields(ALL_FIELDS))} "
       "SELECT field, term, doc_key, tf, dl FROM post JOIN dl USING (doc_key, field)")
def postings(spark, sf):
    docs = I.documents(spark, sf)
    rows = lexical.long_postings(lexical.postings(docs, ALL_FIELDS), ALL_FIELDS)
    return rows.select("field", "term", "doc_key", "tf", "dl")


@query("term_stats", f"WITH {I.IDX}, {I.sql_field_terms(I.plain_fields(ALL_FIELDS))} "
       "SELECT field, term, df, n_docs, round(avgdl, 6) AS avgdl FROM df JOIN fstat USING (field)")
def term_stats(spark, sf):
    docs = I.searchable(spark, sf).documents
    # One row per field.
    totals = F.broadcast(lexical.field_lengths(docs, ALL_FIELDS))
    return lexical.term_counts(docs, ALL_FIELDS).join(totals, "field").select(
        "field", "term", "df", "n_docs", F.round("avgdl", 6).alias("avgdl")
    )


@query("bm25_text", _lexical_sql({"text": 1.0}, 10))
def bm25_text(spark, sf):
    return _hits(lexical.bm25_search(I.searchable(spark, sf), I.queries(spark, sf), "text", 10))


@query("lexical_search", _lexical_sql(D.LEXICAL_WEIGHTS, 10))
def lexical_search(spark, sf):
    return _hits(lexical.lexical_search(I.searchable(spark, sf), I.queries(spark, sf), 10))


@query("published_search", _lexical_sql(D.LEXICAL_WEIGHTS, 10))
def published_search(spark, sf):
    """Keyword search over published tables bucketed by document."""
    path = scratch_path(spark, "published")
    name = "published_" + path.rsplit("-", 1)[-1]
    docs = I.documents(spark, sf).drop("embedding", "meta")
    index = publish_lexical(docs, path, name, ALL_FIELDS, weightings=(D.LEXICAL_WEIGHTS,))
    return _hits(lexical.lexical_search(index, I.queries(spark, sf), 10))


@query("bounded_search", _lexical_sql(D.LEXICAL_WEIGHTS, 10))
def bounded_search(spark, sf):
    """The same over blocks of falling weight, reading what could reach the best ten."""
    path = scratch_path(spark, "bounded")
    docs = I.documents(spark, sf).drop("embedding", "meta")
    name = "bounded_" + path.rsplit("-", 1)[-1]
    index = publish_lexical(docs, path, name, ALL_FIELDS, weightings=(D.LEXICAL_WEIGHTS,), by_bounds=True)
    return _hits(lexical.lexical_search(index, I.queries(spark, sf), 10))


@query("lexical_filtered", _lexical_sql(D.LEXICAL_WEIGHTS, 10, "lang = 'en'"))
def lexical_filtered(spark, sf):
    where = filters.to_column({"lang": "en"}, I.PROMOTED)
    return _hits(lexical.lexical_search(I.searchable(spark, sf), I.queries(spark, sf), 10, where=where))


@query("lexical_leg", _lexical_sql(D.HYBRID_WEIGHTS, 10))
def lexical_leg(spark, sf):
    return _hits(lexical.lexical_leg(I.searchable(spark, sf), I.queries(spark, sf), D.HYBRID_DEFAULT_K))


_NEEDED = {
    "balanced": "greatest(ceil(n * 0.5), 1)",
    "strict": "n",
    "2<-25%": "CASE WHEN n > 2 THEN greatest(n - floor(n * 0.25), 1) ELSE n END",
}


def _min_match_sql() -> str:
    tops = [
        f"""SELECT '{spec}' AS mm, query_id, rank, doc_key, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_key) AS rank FROM (
    SELECT query_id, doc_key, round(raw, 6) AS score FROM lex JOIN n USING (query_id) WHERE matched >= {rule})) WHERE rank <= 10"""
        for spec, rule in _NEEDED.items()
    ]
    return f"""WITH {I.IDX}, {I.ASKED}, {I.sql_lexical(D.LEXICAL_WEIGHTS)},
n AS (SELECT query_id, count(*) AS n FROM lex_qt GROUP BY query_id) {" UNION ALL ".join(tops)}"""


@query("min_should_match", _min_match_sql())
def min_should_match(spark, sf):
    index, asked = I.searchable(spark, sf), I.queries(spark, sf)
    runs = [
        lexical.lexical_search(index, asked, 10, min_match=spec).withColumn("mm", F.lit(spec)) for spec in _NEEDED
    ]
    return _hits(reduce(DataFrame.unionByName, runs), "mm")


_WEIGHTS = {"title": 5.0, "description": 2.0, "uri": 1.5, "text": 1.0, "text_t": 0.5}
_FOLDED = I.sql_tokens(f"translate(lower(text), '{ACCENTED}', '{PLAIN}')")


@query("field_weights", _lexical_sql(_WEIGHTS, 10, fields={**I.plain_fields(["title", "description", "uri", "text"]), "text_t": _FOLDED}))
def field_weights(spark, sf):
    return _hits(lexical.lexical_search(I.searchable(spark, sf), I.queries(spark, sf), 10, _WEIGHTS))


_TURNS = "q AS (SELECT conv_id * 1000 + turn AS query_id, text AS query_text FROM conversations WHERE role = 'user')"


@query("batch_search", f"""WITH {I.IDX}, {_TURNS}, {I.sql_lexical(D.LEXICAL_WEIGHTS)}, {I.sql_top("top", "lex", 4)}
SELECT query_id, rank, doc_key, score FROM top""")
def batch_search(spark, sf):
    """Every user turn of every conversation as a query of one job."""
    turns = I.table(spark, sf, "conversations").filter(F.col("role") == "user")
    asked = turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), F.col("text").alias("query_text"))
    return _hits(lexical.lexical_search(I.searchable(spark, sf), asked, D.DEFAULT_K))


@query("min_score", _lexical_sql(D.LEXICAL_WEIGHTS, 10, tail="SELECT query_id, rank, doc_key, score FROM top WHERE score >= 1500"))
def minimum_score(spark, sf):
    return _hits(min_score(lexical.lexical_search(I.searchable(spark, sf), I.queries(spark, sf), 10), 1500.0))


# -- vector search ------------------------------------------------------------


def _vector_sql(k, where="true", columns="query_id, rank, doc_key, score"):
    return f"WITH {I.IDX}, {I.sql_vectors(where=where)}, {I.sql_top('top', 'vec', k)} SELECT {columns} FROM top"


@query("knn_by_vector", _vector_sql(4, columns="query_id, rank, doc_key"))
def knn_by_vector(spark, sf):
    return ranking.without_score(_hits(vector.knn_search(I.vectors(spark, sf), I.vector_queries(spark, sf))))


@query("knn_search", _vector_sql(10))
def knn_search(spark, sf):
    return _hits(vector.knn_search(I.vectors(spark, sf), I.vector_queries(spark, sf), 10))


@query("knn_filtered", _vector_sql(4, "lang = 'en'"))
def knn_filtered(spark, sf):
    where = filters.to_column({"lang": "en"}, I.PROMOTED)
    return _hits(vector.knn_search(I.vectors(spark, sf), I.vector_queries(spark, sf), where=where))


@query("vector_pool", _vector_sql(50))
def vector_pool(spark, sf):
    return _hits(vector.vector_pool(I.vectors(spark, sf), I.vector_queries(spark, sf), 50))


@query("knn_block", _vector_sql(10))
def knn_block(spark, sf):
    """Query blocks against document blocks, the way for query tables too large to broadcast."""
    return _hits(vector.knn_search(I.vectors(spark, sf), I.vector_queries(spark, sf), 10, by_cells=True))


@query("knn_approx")
def knn_approx(spark, sf):
    return _hits(vector.knn_approx(I.vectors(spark, sf), I.vector_queries(spark, sf), 10))


# -- hybrid search ------------------------------------------------------------


def _hybrid_sql(mode, k, **options):
    return f"WITH {I.sql_hybrid(mode, k, **options)} SELECT query_id, rank, doc_key, score FROM hyb"


def _hybrid(spark, sf, mode, k=10, **options):
    return _hits(
        hybrid.hybrid_search(
            I.searchable(spark, sf), I.vector_queries(spark, sf), k, mode, vectors=I.vectors(spark, sf), **options
        )
    )


@query("hybrid_union", _hybrid_sql("union", 10))
def hybrid_union(spark, sf):
    return _hybrid(spark, sf, "union")


@query("hybrid_keywords_required", _hybrid_sql("keywords_required", 10))
def hybrid_keywords_required(spark, sf):
    return _hybrid(spark, sf, "keywords_required")


@query("hybrid_meaning_required", _hybrid_sql("meaning_required", 10))
def hybrid_meaning_required(spark, sf):
    return _hybrid(spark, sf, "meaning_required")


@query("hybrid_intersection", _hybrid_sql("intersection", 10, pool=100))
def hybrid_intersection(spark, sf):
    return _hybrid(spark, sf, "intersection", pool=100)


@query("hybrid_filtered", _hybrid_sql("union", 5, where="lang = 'en'"))
def hybrid_filtered(spark, sf):
    where = filters.to_column({"lang": "en"}, I.PROMOTED)
    return _hybrid(spark, sf, "union", 5, where=where)


@query("hybrid_without_vectors", f"""WITH {I.IDX}, {I.ASKED}, {I.sql_lexical(D.HYBRID_WEIGHTS)},
{I.sql_top("lex_top", "lex", 10)},
{I.sql_vectors(where="item_id % 2 = 0")},
{I.sql_top("vec_top", "vec", 10)},
pools AS (SELECT coalesce(l.query_id, v.query_id) AS query_id, coalesce(l.doc_key, v.doc_key) AS doc_key, coalesce(l.lex, 0) AS lex, coalesce(v.raw, 0) AS sem
  FROM (SELECT query_id, doc_key, raw / max(raw) OVER (PARTITION BY query_id) AS lex FROM lex_top) l
  FULL JOIN vec_top v ON l.query_id = v.query_id AND l.doc_key = v.doc_key),
{I.sql_top("hyb", "pools", 5, "round(CAST(0.5 AS DOUBLE) * lex + CAST(0.5 AS DOUBLE) * sem, 6)")} SELECT query_id, rank, doc_key, score FROM hyb""")
def hybrid_without_vectors(spark, sf):
    """Every other query has no vector; those are answered by keywords alone."""
    asked = I.vector_queries(spark, sf).withColumn("query_vec", F.when(F.col("query_id") % 2 == 0, F.col("query_vec")))
    return _hits(hybrid.hybrid_search(I.searchable(spark, sf), asked, 5, vectors=I.vectors(spark, sf)))


ALPHAS = [0.0, 0.25, 0.5, 0.75, 1.0]
SWEEP_SQL = f"""{I.IDX}, {I.ASKED}, {I.sql_pools("union", 10)},
swept AS (SELECT alpha, query_id, doc_key, round(alpha * lex + (1 - alpha) * sem, 6) AS mixed
  FROM pools CROSS JOIN (SELECT CAST(unnest({ALPHAS}) AS DOUBLE) AS alpha)),
{I.sql_top("top", "swept", 10, "mixed", "alpha, query_id")}"""


def swept(spark, sf):
    return hybrid.alpha_sweep(
        I.searchable(spark, sf), I.vector_queries(spark, sf), ALPHAS, 10, vectors=I.vectors(spark, sf)
    )


@query("hybrid_alpha_sweep", f"WITH {SWEEP_SQL} SELECT alpha, query_id, rank, doc_key, score FROM top")
def hybrid_alpha_sweep(spark, sf):
    return _hits(swept(spark, sf), "alpha")


MODES_SQL = f"""{I.IDX}, {I.ASKED}, {I.sql_pools("union", 10)},
sides AS (SELECT p.*, l.doc_key IS NOT NULL AS by_word, v.doc_key IS NOT NULL AS by_meaning
  FROM pools p LEFT JOIN lex_top l USING (query_id, doc_key) LEFT JOIN vec_top v USING (query_id, doc_key)),
swept AS (SELECT mode, query_id, doc_key, round(CAST(0.5 AS DOUBLE) * lex + CAST(0.5 AS DOUBLE) * sem, 6) AS mixed
  FROM sides CROSS JOIN (VALUES ('union'), ('keywords_required'), ('meaning_required'), ('intersection')) t(mode)
  WHERE (by_word OR mode NOT IN ('keywords_required', 'intersection')) AND (by_meaning OR mode NOT IN ('meaning_required', 'intersection'))),
{I.sql_top("top", "swept", 10, "mixed", "mode, query_id")}"""


def swept_modes(spark, sf):
    return hybrid.mode_sweep(I.searchable(spark, sf), I.vector_queries(spark, sf), k=10, vectors=I.vectors(spark, sf))


@query("hybrid_mode_sweep", f"WITH {MODES_SQL} SELECT mode, query_id, rank, doc_key, score FROM top")
def hybrid_mode_sweep(spark, sf):
    return _hits(swept_modes(spark, sf), "mode")


@query("lexical_norm", f"""WITH {I.IDX}, {I.ASKED}, {I.sql_pools("union", 10, norm_k=50.0)},
{I.sql_top("top", "pools", 10, "round(CAST(0.5 AS DOUBLE) * lex + CAST(0.5 AS DOUBLE) * sem, 6)")} SELECT query_id, rank, doc_key, score FROM top""")
def lexical_norm(spark, sf):
    index, asked, vecs = I.searchable(spark, sf), I.vector_queries(spark, sf), I.vectors(spark, sf)
    pools = hybrid.joined_pools(*hybrid.hybrid_pools(index, asked, 10, vectors=vecs), "union", 50.0)
    fused = hybrid.fuse(pools, 0.5, 0.5)
    return _hits(ranking.top_k(fused.withColumn("score", ranking.rounded(F.col("score"))), 10))


AS_OF = "2025-01-01"
DATED = "TIMESTAMP '2024-01-01' + (doc_id % 365) * INTERVAL 1 DAY"


def _dated(spark, sf):
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    day = F.make_dt_interval(days=(F.col("doc_id") % 365).cast("int"))
    source = I.table(spark, sf, "documents").withColumn("timestamp", start + day)
    return source


def _dated_documents(spark, sf):
    docs = I.documents(spark, sf).drop("timestamp")
    dates = _dated(spark, sf).select(F.col("doc_id").cast("string").alias("ext_id"), "timestamp")
    return docs.join(dates, "ext_id")


def _quality(spark, sf):
    labels = I.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("ext_id"), "quality")
    return I.documents(spark, sf).select("doc_key", "ext_id").join(labels, "ext_id").select("doc_key", "quality")


def _fused(spark, sf):
    index, asked, vecs = I.searchable(spark, sf), I.vector_queries(spark, sf), I.vectors(spark, sf)
    return hybrid.fuse(hybrid.joined_pools(*hybrid.hybrid_pools(index, asked, 10, vectors=vecs), "union"), 0.5, 0.5)


_FUSED_SQL = f"""{I.IDX}, {I.ASKED}, {I.sql_pools("union", 10)},
fused AS (SELECT query_id, doc_key, (CAST(0.5 AS DOUBLE) * lex + CAST(0.5 AS DOUBLE) * sem) AS mixed FROM pools)"""


@query("quality_boost", f"""WITH {_FUSED_SQL},
boosted AS (SELECT query_id, doc_key, mixed * (1 + CAST(0.3 AS DOUBLE) * coalesce(quality, 0)) AS raw
  FROM fused JOIN idx USING (doc_key) LEFT JOIN labels USING (doc_id)),
{I.sql_top("top", "boosted", 10)} SELECT query_id, rank, doc_key, score FROM top""")
def quality_boost(spark, sf):
    hits = hybrid.quality_boost(_fused(spark, sf), _quality(spark, sf), 0.3)
    return _hits(ranking.top_k(hits.withColumn("score", ranking.rounded(F.col("score"))), 10))


@query("freshness_boost", f"""WITH {_FUSED_SQL},
boosted AS (SELECT query_id, doc_key, mixed * (1 + CAST(0.5 AS DOUBLE) * exp(-greatest(date_diff('day', CAST({DATED} AS DATE), DATE '{AS_OF}'), 0) / 30.0)) AS raw
  FROM fused JOIN idx USING (doc_key)),
{I.sql_top("top", "boosted", 10)} SELECT query_id, rank, doc_key, score FROM top""")
def freshness_boost(spark, sf):
    hits = hybrid.freshness_boost(_fused(spark, sf), _dated_documents(spark, sf), 0.5, AS_OF, at_most=ranking.most_rows(I.queries(spark, sf), 20))
    return _hits(ranking.top_k(hits.withColumn("score", ranking.rounded(F.col("score"))), 10))


_KNOBS = {
    "fw_title": 0.2, "fw_description": 0.5, "fw_text": 1.0, "lexical_weight": 0.7, "vector_weight": 0.6,
    "vector_topk": 40, "search_mode": "keywords_required", "quality_boost": 0.3, "freshness_boost": 0.2,
    "min_score": 0.1, "lexical_norm_k": 8.0, "mm": "flexible",
}


@query("tuned_search", f"""WITH {I.IDX}, {I.ASKED},
{I.sql_pools("keywords_required", 10, vector_topk=40, weights={"title": 0.2, "description": 0.5, "text": 1.0}, norm_k=8.0)},
boosted AS (SELECT query_id, doc_key,
    (CAST(0.7 AS DOUBLE) * lex + CAST(0.6 AS DOUBLE) * sem) / CAST({0.7 + 0.6} AS DOUBLE) * (1 + CAST(0.3 AS DOUBLE) * coalesce(quality, 0))
    * (1 + CAST(0.2 AS DOUBLE) * exp(-greatest(date_diff('day', CAST({DATED} AS DATE), DATE '{AS_OF}'), 0) / 30.0)) AS raw
  FROM pools JOIN idx USING (doc_key) LEFT JOIN labels USING (doc_id)),
{I.sql_top("top", "boosted", 10, where="round(raw, 6) >= 0.1")} SELECT query_id, rank, doc_key, score FROM top""")
def tuned_search(spark, sf):
    index = lexical.clustered(_dated_documents(spark, sf))
    return _hits(
        hybrid.tuned_search(
            index, I.vector_queries(spark, sf), tuning.knobs(_KNOBS), 10,
            quality=_quality(spark, sf), as_of=AS_OF, vectors=I.vectors(spark, sf),
        )
    )


@query("tuning_resolve", """WITH saved AS (
  SELECT source, CASE WHEN count(*) > 45 THEN 100 + max(n_chars) END AS vector_topk,
         CASE WHEN min(lang) = 'de' THEN 'intersection' END AS search_mode FROM documents GROUP BY source)
SELECT doc_id, source AS index, coalesce(CASE WHEN lang = 'fr' THEN n_chars END, vector_topk, 200) AS vector_topk,
       coalesce(search_mode, 'union') AS search_mode, coalesce(CASE WHEN lang = 'de' THEN 'strict' END, 'flexible') AS mm
FROM documents LEFT JOIN saved USING (source)""")
def tuning_resolve(spark, sf):
    docs = I.table(spark, sf, "documents").withColumnRenamed("source", "index")
    calls = docs.select(
        "doc_id", "index",
        F.when(F.col("lang") == "fr", F.col("n_chars")).alias("vector_topk"),
        F.when(F.col("lang") == "de", F.lit("strict")).alias("mm"),
    )
    saved = docs.groupBy("index").agg(
        F.when(F.count(F.lit(1)) > 45, F.max("n_chars") + 100).alias("vector_topk"),
        F.when(F.min("lang") == "de", F.lit("intersection")).alias("search_mode"),
    )
    return tuning.resolve(calls, saved, {"vector_topk": 200, "search_mode": "union", "mm": "flexible"})


@query("fallback_search", f"""WITH {I.sql_hybrid("union", 4)},
n AS (SELECT query_id, count(*) AS n FROM lex_qt GROUP BY query_id),
strict AS (SELECT query_id, doc_key, raw FROM lex JOIN n USING (query_id) WHERE matched >= n),
{I.sql_top("first", "strict", 4)}
SELECT query_id, rank, doc_key, score FROM first
UNION ALL SELECT query_id, rank, doc_key, score FROM hyb WHERE query_id NOT IN (SELECT query_id FROM first)""")
def fallback_search(spark, sf):
    """All words required; queries without such a document fall back to hybrid search."""
    index = I.searchable(spark, sf)
    primary = _hits(lexical.lexical_search(index, I.queries(spark, sf), 4, D.HYBRID_WEIGHTS, min_match="strict"))
    return lookup.with_fallback(primary, _hybrid(spark, sf, "union", 4))


# -- ranking --------------------------------------------------------------------


@query("topk_per_query", _lexical_sql(D.LEXICAL_WEIGHTS, 4))
def topk_per_query(spark, sf):
    scores = lexical.lexical_scores(I.searchable(spark, sf), I.queries(spark, sf), D.LEXICAL_WEIGHTS, best=4)
    return _hits(ranking.top_k(scores.withColumn("score", ranking.rounded(F.col("score"))), 4))


@query("topk_deep", """SELECT event_type, rank, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank FROM events) WHERE rank <= 1500""")
def topk_deep(spark, sf):
    """A k beyond the window-group limit: hot groups are ranked in salted parts first."""
    events = I.table(spark, sf, "events")
    order = [F.col("value").desc(), F.col("event_id")]
    top = ranking.top_k(events, 1500, by=("event_type",), order=order, spread_by="event_id")
    return top.select("event_type", "rank", "event_id", "value")


@query("search_no_score", _hybrid_sql("union", 4).replace("rank, doc_key, score FROM hyb", "rank, doc_key FROM hyb"))
def search_no_score(spark, sf):
    return ranking.without_score(_hybrid(spark, sf, "union", 4))


@query("retriever_preset", _hybrid_sql("meaning_required", 5, alpha=0.25).replace("rank, doc_key, score FROM hyb", "rank, doc_key FROM hyb"))
def retriever_preset(spark, sf):
    retrieve = ranking.retriever(_hybrid, mode="meaning_required", k=5, alpha=0.25)
    return retrieve(spark, sf)
