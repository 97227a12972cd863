"""Keyword scores by blocks against the same sums as rows."""

import re

import pytest
from pyspark.sql import functions as F

from glimmerdex.operators import lexical, matching
from glimmerdex.operators.ranking import rounded, top_k
from glimmerdex.plans import sizing

WORDS = [f"w{i}" for i in range(40)]
DOCS = [(f"k{i % 95:03d}", " ".join(WORDS[(i * j * j) % (1 + j)] for j in range(1, 30))) for i in range(100)]
DOCS += [(None, "w1 w2 w2 w3"), ("tie-a", "w5 w39"), ("tie-b", "w5 w39")]
ASKED = [(i % 33, " ".join(WORDS[(i + 3 * j) % 40] for j in range(6))) for i in range(36)] + [(99, "none of these"), (None, "w1 w2")]


@pytest.fixture
def tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_key string, text string").repartition(3)
    return docs, spark.createDataFrame(ASKED, "query_id long, query_text string")


def best(tables, min_match, by_blocks):
    scores = lexical.lexical_scores(*tables, {"text": 2.0}, min_match=min_match, best=5 if by_blocks else None)
    top = top_k(scores.withColumn("score", rounded(F.col("score"))), 5)
    return sorted(map(tuple, top.select("query_id", "rank", "doc_key", "score").collect()), key=repr)


@pytest.mark.parametrize("min_match", [None, "balanced", "2<-25%"])
@pytest.mark.parametrize("cells", [False, True])
def test_blocks_give_the_same_rows(tables, monkeypatch, min_match, cells):
    want = best(tables, min_match, False)
    monkeypatch.setattr(matching, "DOCS_AT_ONCE", 7)
    monkeypatch.setattr(matching, "DENSE", 3)
    monkeypatch.setattr(matching, "ADDED_AT_ONCE", 10)
    if cells:
        monkeypatch.setattr(matching, "MAX_KEPT", 40)
    assert want and best(tables, min_match, True) == want


def test_pairs_of_queries_and_documents_are_not_rows(tables):
    plan = lexical.lexical_search(*tables, 5, {"text": 1.0})._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and not re.search(r"keys=\[query_id#\w+, doc_key", plan)


def test_many_queries_of_few_words_meet_in_cells(tables, monkeypatch):
    """More query terms than may be broadcast, of a vocabulary that may: no row per pair either."""
    want = best(tables, None, False)
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 60)
    monkeypatch.setattr(matching, "CELL_TERMS", 50)
    plan = lexical.lexical_search(*tables, 5, {"text": 1.0})._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    assert best(tables, None, True) == want


@pytest.mark.parametrize("where", [None, "doc_key < 'k050'"])
def test_postings_are_not_rows(tables, monkeypatch, where):
    """Texts are cut into words once, and a document's counts are one row; repeated and null keys and filters as before."""
    kept, write = [], sizing.written
    monkeypatch.setattr(sizing, "written", lambda df, name: kept.append((name, write(df, name))) or kept[-1][1])
    found = lexical.lexical_search(*tables, 5, {"text": 2.0}, where=where)
    assert [name for name, _ in kept] == ["matches"] and kept[0][1].count() == len(DOCS)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan and "split" not in plan
    rows = sorted(map(tuple, found.select("query_id", "rank", "doc_key", "score").collect()), key=repr)
    scores = lexical.lexical_scores(*tables, {"text": 2.0}, where=where).withColumn("score", rounded(F.col("score")))
    scored = top_k(scores, 5).select("query_id", "rank", "doc_key", "score")
    assert rows == sorted(map(tuple, scored.collect()), key=repr) and rows
