"""Registered queries: facets, highlighting, context, prompts, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from glimmerdex import decisions as D
from glimmerdex.functions.text import highlight
from glimmerdex.operators import evaluate, facets, lexical, rag, shaping
from glimmerdex.operators.ranking import most_rows
from glimmerdex.plans import inputs as I
from glimmerdex.plans import search
from glimmerdex.plans.inputs import query


@query("facet_counts", f"""WITH {I.IDX}, m AS (SELECT * FROM idx WHERE length(text) > 500),
c AS (SELECT 'lang' AS field, lang AS value, count(*) AS count FROM m WHERE lang IS NOT NULL GROUP BY lang
  UNION ALL SELECT 'source', source, count(*) FROM m WHERE source IS NOT NULL GROUP BY source)
SELECT field, position, value, count FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY count DESC, value) AS position FROM c)
WHERE position <= 10""")
def facet_counts(spark, sf):
    matches = I.documents(spark, sf).filter(F.length("text") > 500).drop("lang")
    return facets.facet_counts(matches, ["lang", "source"], 10).select("field", "position", "value", "count")


@query("facet_counts_of_search", f"""WITH {I.IDX}, {I.ASKED}, {I.sql_lexical(D.LEXICAL_WEIGHTS)}, {I.sql_top("top", "lex", 10)}
SELECT 'source' AS field, source AS value, count(*) AS count FROM top JOIN idx USING (doc_key) GROUP BY source""")
def facet_counts_of_search(spark, sf):
    """Facets over the result rows of a search."""
    index = I.searchable(spark, sf)
    hits = lexical.lexical_search(index, I.queries(spark, sf), 10)
    asked = I.queries(spark, sf)
    found = shaping.attach_documents(hits, I.documents(spark, sf), ["source"], most_rows(asked, 10))
    return facets.facet_counts(found, ["source"])


# Words and gaps of a text, in SQL.
_PIECES = r"regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}]+')"


@query("highlight", f"""WITH {I.IDX}, {I.ASKED}, {I.sql_lexical(D.LEXICAL_WEIGHTS)}, {I.sql_top("top", "lex", 3)},
terms AS (SELECT query_id, list(term) AS terms FROM lex_qt GROUP BY query_id),
cut AS (SELECT query_id, rank, doc_key, terms, {_PIECES} AS pieces FROM top JOIN idx USING (doc_key) JOIN terms USING (query_id)),
spot AS (SELECT *, coalesce(list_position(list_transform(pieces, lambda p: list_contains(terms, lower(p))), true), 0) AS first FROM cut)
SELECT query_id, rank, doc_key, array_to_string(list_transform(list_slice(pieces, greatest(first - 10, 1), greatest(first - 10, 1) + 39),
  lambda p: CASE WHEN list_contains(terms, lower(p)) THEN '<em>' || p || '</em>' ELSE p END), '') AS snippet FROM spot""")
def highlighted(spark, sf):
    index, asked = I.searchable(spark, sf), I.queries(spark, sf)
    hits = lexical.lexical_search(index, asked, 3).select("query_id", "rank", "doc_key")
    # At most the distinct words of one query per group.
    terms = lexical.query_terms(asked).groupBy("query_id").agg(F.collect_list("term").alias("terms"))
    rows = shaping.attach_documents(hits, I.documents(spark, sf), ["text"], most_rows(asked, 3)).join(terms, "query_id")
    return rows.select("query_id", "rank", "doc_key", highlight("text", "terms").alias("snippet"))


_WORDS = r"array_to_string(list_slice(list_filter(string_split_regex(text, '\s+'), lambda t: t <> ''), 1, 1500), ' ')"
_CONTEXT_SQL = f"""{I.sql_hybrid("union", 3)},
context AS (SELECT query_id, string_agg(title || ' - ' || description || ' - ' || {_WORDS} || ' - ', '' ORDER BY rank) AS context
  FROM hyb JOIN idx USING (doc_key) GROUP BY query_id)"""


def _context(spark, sf):
    hits = search._hybrid(spark, sf, "union", D.RAG_DOCS)
    return rag.rag_context(hits, I.documents(spark, sf), n_queries=I.queries(spark, sf).count())


@query("rag_context", f"WITH {_CONTEXT_SQL} SELECT query_id, context FROM context")
def rag_context(spark, sf):
    return _context(spark, sf)


@query("rag_prompt", f"""WITH {_CONTEXT_SQL}, own AS (SELECT doc_id FROM labels WHERE toxic = 1)
SELECT q.query_id, query_text,
  CASE WHEN own.doc_id IS NULL THEN '{rag.GROUNDED_BEFORE}' || query_text || '{rag.GROUNDED_AFTER}' END AS instruction,
  CASE WHEN own.doc_id IS NULL THEN context ELSE 'given: ' || query_text END AS context
FROM q LEFT JOIN own ON own.doc_id = q.query_id LEFT JOIN context c ON c.query_id = q.query_id""".replace("'. Say", "''. Say").replace("question: '", "question: ''"))
def rag_prompt(spark, sf):
    """Some queries bring their own context, the others get a built one."""
    own = I.table(spark, sf, "labels").filter("toxic = 1").select(F.col("doc_id").alias("query_id"), F.lit(True).alias("own"))
    asked = I.queries(spark, sf).join(own, "query_id", "left")
    asked = asked.withColumn("context", F.when(F.col("own"), F.concat(F.lit("given: "), F.col("query_text")))).drop("own")
    return rag.rag_prompt(asked, _context(spark, sf))


def _echo_model(prompts: list[dict]) -> list[str]:
    """A stand-in for a user's language model."""
    return [f"  {p['query_id']}: {len(p['context'])} characters of context \n" for p in prompts]


@query("answer_udf", "SELECT item_id AS query_id, item_id || ': ' || length(text) || ' characters of context' AS answer FROM benchmark")
def answer_udf(spark, sf):
    asked = I.queries(spark, sf).withColumn("context", F.col("query_text"))
    none = spark.createDataFrame([], "query_id long, context string")
    return rag.answer(rag.rag_prompt(asked, none), _echo_model).select("query_id", "answer")


@query("known_items", f"WITH {I.IDX}, {I.ASKED} SELECT query_id, doc_key FROM q JOIN idx ON instr(idx.text, q.query_text) > 0")
def known_items(spark, sf):
    return evaluate.known_items(I.searchable(spark, sf).documents, I.queries(spark, sf))


@query("known_items_short", f"""WITH {I.IDX}, p AS (
  SELECT item_id, n, array_to_string(string_split(text, ' ')[1:n], ' ') AS passage FROM benchmark, (SELECT unnest([1, 2, 3]) AS n))
SELECT item_id * 10 + n AS query_id, doc_key FROM p JOIN idx ON instr(idx.text, p.passage) > 0""")
def known_items_short(spark, sf):
    """Passages of one, two and three words, which occur inside longer words too."""
    asked = I.table(spark, sf, "benchmark").withColumn("n", F.explode(F.array(*map(F.lit, (1, 2, 3)))))
    passage = F.array_join(F.slice(F.split("text", " "), F.lit(1), F.col("n")), " ")
    passages = asked.select((F.col("item_id") * 10 + F.col("n")).alias("query_id"), passage.alias("query_text"))
    return evaluate.known_items(I.documents(spark, sf), passages)


@query("retrieval_modes", f"""WITH {search.MODES_SQL},
truth AS (SELECT query_id, doc_key FROM q JOIN idx ON instr(idx.text, q.query_text) > 0),
best AS (SELECT mode, query_id, min(rank) AS best FROM top JOIN truth USING (query_id, doc_key) GROUP BY ALL),
n AS (SELECT count(DISTINCT query_id) AS n_queries FROM truth)
SELECT mode, n_queries, round(coalesce(hits, 0) / n_queries, 6) AS hit_at_k, round(coalesce(total, 0) / n_queries, 6) AS mrr
FROM (SELECT DISTINCT mode FROM top) CROSS JOIN n
LEFT JOIN (SELECT mode, count(*) AS hits, sum(1.0::DOUBLE / best) AS total FROM best GROUP BY mode) USING (mode)""")
def retrieval_modes(spark, sf):
    """Hit rate and mean reciprocal rank of known passages for every matching mode."""
    truth = evaluate.known_items(I.documents(spark, sf), I.queries(spark, sf))
    return evaluate.retrieval_eval(search.swept_modes(spark, sf), truth, ["mode"])


@query("retrieval_eval", f"""WITH {search.SWEEP_SQL},
truth AS (SELECT query_id, doc_key FROM q JOIN idx ON instr(idx.text, q.query_text) > 0),
best AS (SELECT alpha, query_id, min(rank) AS best FROM top JOIN truth USING (query_id, doc_key) GROUP BY ALL),
n AS (SELECT count(DISTINCT query_id) AS n_queries FROM truth)
SELECT alpha, n_queries, round(coalesce(hits, 0) / n_queries, 6) AS hit_at_k, round(coalesce(total, 0) / n_queries, 6) AS mrr
FROM (SELECT DISTINCT alpha FROM top) CROSS JOIN n
LEFT JOIN (SELECT alpha, count(*) AS hits, sum(1.0::DOUBLE / best) AS total FROM best GROUP BY alpha) USING (alpha)""")
def retrieval_eval(spark, sf):
    """Hit rate and mean reciprocal rank of known passages for every balance."""
    truth = evaluate.known_items(I.searchable(spark, sf).documents, I.queries(spark, sf))
    return evaluate.retrieval_eval(search.swept(spark, sf), truth, ["alpha"])
