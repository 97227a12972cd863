import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from glimmerdex.operators import embed, enrich, evaluate, facets, rag


@pytest.fixture(scope="module")
def docs(spark):
    rows = [("a", "A", "da", "one two  three\nfour"), ("b", "B", None, "five"), ("c", "C", "dc", "six seven")]
    return spark.createDataFrame(rows, "doc_key string, title string, description string, text string")


def test_context_follows_rank(spark, docs):
    hits = spark.createDataFrame([(0, 2, "a"), (0, 1, "b"), (0, 4, "c"), (1, 1, "c")], "query_id long, rank int, doc_key string")
    for bound in (None, 2):
        got = {r["query_id"]: r["context"] for r in rag.rag_context(hits, docs, 0, 3, bound).collect()}
        assert got == {0: "B -  - five - A - da - one two three - ", 1: "C - dc - six seven - "}


def test_context_of_multi_valued_fields(spark, docs):
    hits = spark.createDataFrame([(0, 1, "c")], "query_id long, rank int, doc_key string")
    split = docs.withColumn("text", F.split("text", " "))
    assert rag.rag_context(hits, split).first()["context"] == "C - dc - six seven - "


def test_prompt_rules(spark):
    asked = spark.createDataFrame([(0, "q0", None), (1, "q1", "own"), (2, "q2", None)], "query_id long, query_text string, context string")
    contexts = spark.createDataFrame([(0, "built"), (1, "unused"), (2, "")], "query_id long, context string")
    got = {r["query_id"]: (r["instruction"], r["context"]) for r in rag.rag_prompt(asked, contexts).collect()}
    assert got[0] == (f"{rag.GROUNDED_BEFORE}q0{rag.GROUNDED_AFTER}", "built")
    assert got[1] == (None, "own") and got[2] == (None, None)
    own = {r["query_id"]: r["instruction"] for r in rag.rag_prompt(asked, contexts, "In German").collect()}
    assert set(own.values()) == {"In German"}


def test_answers_are_trimmed_and_counted(spark):
    asked = spark.createDataFrame([(i, f"q{i}") for i in range(120)], "query_id long, query_text string")
    none = spark.createDataFrame([], "query_id long, context string")
    prompts = rag.rag_prompt(asked, none)
    sizes = rag.answer(prompts, lambda rows: [f" {len(rows)} {r['context']}\n" for r in rows], batch=50).collect()
    assert all(int(r["answer"].split()[0]) <= 50 and r["answer"].endswith("None") for r in sizes)
    with pytest.raises(PythonException, match="answers for"):
        rag.answer(prompts, lambda rows: ["one"]).collect()


def test_facets(spark):
    rows = [("x", 1), ("x", 2), ("y", 2), (None, 3)]
    docs = spark.createDataFrame(rows, "lang string, n int").withColumn("meta", F.create_map(F.lit("tag"), F.col("lang")))
    got = {(r["field"], r["value"]): (r["count"], r["position"]) for r in facets.facet_counts(docs, ["lang", "n", "Tag"], 2).collect()}
    assert got == {
        ("lang", "x"): (2, 1), ("lang", "y"): (1, 2), ("n", "2"): (2, 1), ("n", "1"): (1, 2), ("Tag", "x"): (2, 1), ("Tag", "y"): (1, 2),
    }


def test_hash_embedding_against_counting(spark):
    import numpy as np
    import xxhash

    texts = ["Red cat, red dog", "é ü é", "", None, "one " * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for row in embed.hash_embed(docs, 32).collect():
        sums = np.zeros(32)
        for token in (texts[row["id"]] or "").lower().replace(",", " ").split():
            # Fixed value: the seed of the engine's hash function.
            value = xxhash.xxh64(token.encode(), seed=42).intdigest()
            value -= (value >> 63) << 64
            sums[value % 32] += 1 if (value >> 32) % 2 == 0 else -1
        if not sums.any():
            assert row["embedding"] is None
        else:
            assert row["embedding"] == pytest.approx(sums / np.linalg.norm(sums), abs=1e-6)


def test_model_hook(spark):
    seen = lambda texts, is_query: [[float(len(texts)), float(len(t)), float(is_query)] for t in texts]
    docs = spark.createDataFrame([(i, "x" * i) for i in range(120)], "id int, text string").coalesce(1)
    rows = embed.embed_documents(docs, seen).collect()
    assert [r["embedding"][1] for r in rows] == [float(r["id"]) for r in rows]
    assert {r["embedding"][0] for r in rows} <= {50.0, 20.0}
    assert embed.embed_documents(docs.limit(0), seen).count() == 0
    queries = docs.withColumnRenamed("text", "query_text")
    assert embed.embed_queries(queries, seen).first()["query_vec"][2] == 1.0
    with pytest.raises(PythonException, match="vectors for"):
        embed.embed_documents(docs, lambda texts, is_query: [[1.0]]).collect()


def test_enrichment(spark, shuffled_joins):
    docs = spark.createDataFrame(
        [("a", "the cat and the dog"), ("b", "le chat et les chiens"), ("c", "12345"), ("d", "good bad good")], "doc_key string, text string"
    )
    assert {r["doc_key"]: r["language"] for r in enrich.language(docs).collect()} == {"a": "en", "b": "fr", "c": None, "d": None}
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -1.0)], "term string, weight double")
    mood = {r["doc_key"]: r["sentiment"] for r in enrich.sentiment(docs, lexicon).collect()}
    assert mood == {"a": None, "b": None, "c": None, "d": pytest.approx(1 / 3)}


def test_known_items_and_evaluation(spark, shuffled_joins):
    docs = spark.createDataFrame(
        [("a", "xx the quick brown fox jumps yy"), ("b", "xthe quick brown fox jumpsy"), ("c", "the quick fox")], "doc_key string, text string"
    )
    passages = spark.createDataFrame([(0, "the quick brown fox jumps"), (1, "quick fox the"), (2, "fox")], "query_id long, query_text string")
    truth = evaluate.known_items(docs, passages)
    assert sorted((r["query_id"], r["doc_key"]) for r in truth.collect()) == [(0, "a"), (0, "b"), (2, "a"), (2, "b"), (2, "c")]
    truth = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (2, "a"), (3, "a")], "query_id long, doc_key string")
    hits = spark.createDataFrame(
        [("m", 0, 2, "b"), ("m", 0, 4, "a"), ("m", 1, 1, "c"), ("m", 2, 11, "a"), ("n", 9, 1, "a")], "mode string, query_id long, rank int, doc_key string"
    )
    got = {r["mode"]: (r["n_queries"], r["hit_at_k"], r["mrr"]) for r in evaluate.retrieval_eval(hits, truth, ["mode"]).collect()}
    assert got == {"m": (4, 0.5, 0.375), "n": (4, 0.0, 0.0)}


@pytest.mark.parametrize("small", [True, False])
def test_words_are_cut_into_n_grams_once(spark, monkeypatch, request, small):
    """However often a word occurs, or looked up in the tasks where passages may be broadcast; short passages occur inside words, and repeated passages and rows stay."""
    if not small:
        request.getfixturevalue("shuffled_joins")
    texts = ["xthe fox", "the fox", "Fox the", "a b", "ΟΔΟΣ x", "fox foxes", "--", "σοφός"] + ["the same words again"] * 40
    docs = spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(texts)], "doc_key string, text string")
    asked = ["the", "he fo", "fo", "--", "Fox", "e s", "same words again", "fo", "ΟΣ", "w", ""]
    passages = spark.createDataFrame(list(enumerate(asked)) + [(2, "fo")], "query_id long, query_text string")
    cut, grams = [], evaluate._grams
    monkeypatch.setattr(evaluate, "_grams", lambda words, size: cut.append(words.count()) or grams(words, size))
    found = sorted((r["query_id"], r["doc_key"]) for r in evaluate.known_items(docs, passages).collect())
    want = [(i, f"k{j}") for i, p in [*enumerate(asked), (2, "fo")] for j, t in enumerate(texts) if p and p in t]
    assert found == sorted(want)
    words = {w for t in texts for w in t.lower().split() if w != "--"}
    assert set(cut) == (set() if small else {len(words)})
