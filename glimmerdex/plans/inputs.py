"""The given tables as index documents and queries, and the same in SQL.

Conventions: a document's original id is its doc_id, its metadata are lang, source
and n_chars; the vector of document d is vec_id = d, of query i vec_id = i.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmerdex import decisions as D
from glimmerdex.operators.documents import build_documents
from glimmerdex.operators.lexical import LexicalIndex, clustered
from glimmerdex.plans.sizing import few_splits

INDEX = "documents"
METADATA = ["lang", "source", "n_chars"]
PROMOTED = {"lang": "lang", "source": "source"}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows."""

    def keep(function: Query) -> Query:
        QUERIES[key] = function
        if sql is not None:
            CHECKS[key] = sql
        return function

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return build_documents(
        table(spark, sf, "documents"), INDEX, "doc_id", "text", METADATA, promote=tuple(PROMOTED)
    )


def searchable(spark: SparkSession, sf: str) -> LexicalIndex:
    """The documents as a search reads them: spread over the slots when they are few splits."""
    docs = documents(spark, sf)
    return clustered(docs) if few_splits(docs) else LexicalIndex(docs)


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that have a vector; unused columns are pruned away."""
    vecs = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    joined = table(spark, sf, "documents").join(vecs, "doc_id")
    return build_documents(joined, INDEX, "doc_id", "text", METADATA, embedding_col="embedding", promote=tuple(PROMOTED))


def queries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def vector_queries(spark: SparkSession, sf: str) -> DataFrame:
    vecs = table(spark, sf, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    return queries(spark, sf).join(vecs, "query_id", "left")


# -- the same in SQL ---------------------------------------------------------

URI = f"'{D.DEFAULT_BASE_URI}/{INDEX}/' || CAST(doc_id AS VARCHAR)"

IDX = f"""idx AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS ext_id, {URI} AS uri, md5({URI}) AS doc_key,
         substr(body, 1, 100) AS title, substr(body, 1, 200) AS description, body AS text, lang, source, n_chars
  FROM (SELECT *, coalesce(nullif(text, ''), ' ') AS body FROM documents))"""

ASKED = "q AS (SELECT item_id AS query_id, text AS query_text FROM benchmark)"


def sql_tokens(column: str) -> str:
    return rf"list_filter(string_split_regex(lower({column}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"


def sql_terms(name: str = "qt", source: str = "q") -> str:
    cleaned = "translate(query_text, '{}\"', '   ')"
    return f"{name} AS (SELECT DISTINCT query_id, term FROM (SELECT query_id, unnest({sql_tokens(cleaned)}) AS term FROM {source}))"


def sql_field_terms(fields: dict[str, str]) -> str:
    """ft, post, dl, fstat, df for fields given as name -> token list expression."""
    parts = " UNION ALL ".join(f"SELECT doc_key, '{f}' AS field, {e} AS terms FROM idx" for f, e in fields.items())
    return f"""ft AS ({parts}),
post AS (SELECT doc_key, field, term, count(*) AS tf FROM (SELECT doc_key, field, unnest(terms) AS term FROM ft) GROUP BY ALL),
dl AS (SELECT doc_key, field, len(terms) AS dl FROM ft),
fstat AS (SELECT field, count(*) AS n_docs, avg(dl) AS avgdl FROM dl GROUP BY field),
df AS (SELECT field, term, count(*) AS df FROM post GROUP BY ALL)"""


def plain_fields(names) -> dict[str, str]:
    return {f: sql_tokens(f) for f in names}


def sql_lexical(
    weights: dict[str, float], name: str = "lex", source: str = "q", where: str = "true",
    fields: dict[str, str] | None = None,
) -> str:
    """CTEs up to <name>(query_id, doc_key, raw, matched), every match."""
    weight = " ".join(f"WHEN '{f}' THEN CAST({w} AS DOUBLE)" for f, w in weights.items())
    return f"""{sql_terms(f"{name}_qt", source)},
{sql_field_terms(fields or plain_fields(weights))},
{name}_s AS (
  SELECT query_id, doc_key, term,
    max((CASE field {weight} END) * ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * CAST({D.BM25_K1 + 1.0} AS DOUBLE)
      / (tf + CAST({D.BM25_K1} AS DOUBLE) * (CAST({1.0 - D.BM25_B} AS DOUBLE) + CAST({D.BM25_B} AS DOUBLE) * dl / avgdl))) AS s
  FROM {name}_qt JOIN post USING (term) JOIN dl USING (doc_key, field) JOIN df USING (field, term) JOIN fstat USING (field)
  WHERE doc_key IN (SELECT doc_key FROM idx WHERE {where})
  GROUP BY ALL),
{name} AS (SELECT query_id, doc_key, sum(s) AS raw, count(*) AS matched FROM {name}_s GROUP BY ALL)"""


def sql_top(name: str, source: str, k: int, score: str = "round(raw, 6)", by: str = "query_id", where: str = "true") -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY score DESC, doc_key) AS rank
    FROM (SELECT *, {score} AS score FROM {source} WHERE {where})) WHERE rank <= {k})"""


def sql_vectors(name: str = "vec", where: str = "true") -> str:
    """<name>(query_id, doc_key, raw) for every pair with a vector."""
    return f"""{name} AS (
  SELECT qe.vec_id AS query_id, idx.doc_key,
         (1 + list_cosine_similarity(CAST(qe.embedding AS DOUBLE[]), CAST(de.embedding AS DOUBLE[]))) / 2 AS raw
  FROM benchmark JOIN embeddings qe ON qe.vec_id = benchmark.item_id
  CROSS JOIN idx JOIN embeddings de ON de.vec_id = idx.doc_id WHERE {where})"""


SQL_JOIN = {"union": "FULL", "keywords_required": "LEFT", "meaning_required": "RIGHT", "intersection": "INNER"}


def sql_pools(
    mode: str, pool: int, where: str = "true", weights: dict[str, float] | None = None, norm_k: float | None = None,
    matched: str = "true", fields: dict[str, str] | None = None, vector_topk: int | None = None,
) -> str:
    """CTEs up to pools(query_id, doc_key, lex, sem)."""
    scaled = f"raw / (raw + CAST({norm_k} AS DOUBLE))" if norm_k else "raw / max(raw) OVER (PARTITION BY query_id)"
    return f"""{sql_lexical(weights or D.HYBRID_WEIGHTS, where=where, fields=fields)},
{sql_top("lex_top", "lex", pool, where=matched)},
{sql_vectors(where=where)},
{sql_top("vec_top", "vec", vector_topk or pool)},
pools AS (
  SELECT coalesce(l.query_id, v.query_id) AS query_id, coalesce(l.doc_key, v.doc_key) AS doc_key,
         coalesce(l.lex, 0) AS lex, coalesce(v.raw, 0) AS sem
  FROM (SELECT query_id, doc_key, {scaled} AS lex FROM lex_top) l
  {SQL_JOIN[mode]} JOIN vec_top v ON l.query_id = v.query_id AND l.doc_key = v.doc_key)"""


def sql_hybrid(mode: str, k: int, alpha: float = 0.5, pool: int | None = None, where: str = "true") -> str:
    """CTEs up to hyb(query_id, doc_key, score, rank)."""
    mixed = f"round(CAST({alpha} AS DOUBLE) * lex + CAST({1 - alpha} AS DOUBLE) * sem, 6)"
    return f"{IDX}, {ASKED},\n{sql_pools(mode, D.pool_size(k, pool), where)},\n{sql_top('hyb', 'pools', k, mixed)}"
