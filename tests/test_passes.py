"""Query tables too large to broadcast: documents are not copied, and light terms are added up for few of them."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glimmerdex.operators import lexical, matching
from glimmerdex.operators.ranking import rounded, top_k
from glimmerdex.plans import sizing

WORDS = [f"w{i}" for i in range(40)]
DOCS = [(f"k{i % 95:03d}", " ".join(WORDS[(i * j * j) % (1 + j)] for j in range(1, 30))) for i in range(100)]
DOCS += [(None, "w1 w2 w2 w3"), ("tie-a", "w5 w39"), ("tie-b", "w5 w39")]
ASKED = [(i % 33, " ".join(WORDS[(i + 3 * j) % 40] for j in range(6))) for i in range(36)] + [(99, "none of these"), (None, "w1 w2")]


@pytest.mark.parametrize("min_match", [None, "balanced"])
def test_documents_are_not_copied_for_blocks_of_queries(spark, monkeypatch, min_match):
    docs = spark.createDataFrame(DOCS, "doc_key string, text string").repartition(3)
    asked = spark.createDataFrame(ASKED, "query_id long, query_text string")

    def best(by_blocks):
        scores = lexical.lexical_scores(docs, asked, {"text": 2.0}, min_match=min_match, best=5 if by_blocks else None)
        return top_k(scores.withColumn("score", rounded(F.col("score"))), 5)

    def rows(df):
        return sorted(map(tuple, df.select("query_id", "rank", "doc_key", "score").collect()), key=repr)

    want = rows(best(False))
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 60)
    monkeypatch.setattr(matching, "CELL_TERMS", 50)
    monkeypatch.setattr(matching, "PASS_TERMS", 50, raising=False)
    monkeypatch.setattr(matching, "COPIED", -1, raising=False)
    found = best(True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" not in plan and plan.count("MapInArrow") > 2
    assert rows(found) == want


def test_light_terms_are_added_up_where_they_matter(monkeypatch):
    monkeypatch.setattr(matching, "DOCS_AT_ONCE", 50)
    rng = np.random.default_rng(3)
    n_docs, n_terms, n_queries = 600, 60, 30
    table = np.where(rng.random((n_docs, n_terms)) < 0.5, rng.random((n_docs, n_terms)), 0.0)
    table[rng.random((n_docs, n_terms)) < 0.05] *= 100.0
    asked = [(q, t, 1 + (q + t) % 2) for q in range(n_queries) for t in rng.choice(n_terms, 6, replace=False).tolist()]
    asked.append((n_queries, n_terms, 1))  # a term that no document has
    columns = [pa.array(c, k) for c, k in zip(zip(*asked, strict=True), (pa.int64(), pa.int32(), pa.int64()), strict=True)]
    best = matching.BestMatches(matching.Asked(pa.table(columns, names=["query_id", "term_no", "times"])), 4)
    closed, add = [], matching.BestMatches._add_by_heavy
    monkeypatch.setattr(matching.BestMatches, "_add_by_heavy", lambda *a: closed.append(add(*a)) or closed[-1])
    documents, terms = np.nonzero(table)
    best.add_batch(pa.array([f"d{i:03d}" for i in range(n_docs)]), np.bincount(documents, minlength=n_docs), terms, table[documents, terms])
    got = sorted((r["query_id"], -round(r["score"], 6), r["doc_key"]) for r in best.rows().to_pylist())
    times = np.zeros((n_queries, n_terms))
    for q, t, n in asked[:-1]:
        times[q, t] = n
    sums = np.round(times @ table.T, 6)
    want = [(q, -s, f"d{d:03d}") for q in range(n_queries) for s, d in sorted(zip(sums[q], range(n_docs)), key=lambda x: (-x[0], x[1]))[:4]]
    assert [(q, d) for q, _, d in got] == [(q, d) for q, _, d in want]
    assert np.allclose([s for _, s, _ in got], [s for _, s, _ in want])
    assert any(not open_.all() for open_ in closed)
