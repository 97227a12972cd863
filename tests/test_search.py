import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from glimmerdex import decisions as D
from glimmerdex.operators import bounded, hybrid, lexical, lookup, ranking, tuning, vector
from glimmerdex.sources.index_store import open_lexical, publish_lexical

WORDS = "the a of red green blue cat dog bird runs sleeps sings fast slow rare unique".split()


def corpus(n=60, seed=3):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(draw.choices(WORDS, weights=range(len(WORDS), 0, -1), k=draw.randint(0, 30)))
        rows.append((f"k{i:03d}", " ".join(text.split()[:3]), " ".join(text.split()[:6]), text, "even" if i % 2 == 0 else "odd"))
    # Copies give exact ties; an empty text and a null title must not disturb.
    rows += [(f"t{i}", "red cat", "red cat", "red cat sleeps", "odd") for i in range(5)]
    rows += [("e0", None, "", "", "odd")]
    return rows


ASKED = [(0, "red cat"), (1, 'the {rare} "unique" bird'), (2, "nowhere"), (3, ""), (4, '{}"'), (5, "the the of a dog sleeps")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_key string, title string, description string, text string, parity string")


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame(ASKED, "query_id long, query_text string")


def brute_lexical(weights, k, keep=lambda row: True, need=lambda n: 1):
    rows = corpus()
    fields = {"title": 1, "description": 2, "text": 3}
    counts = {f: {r[0]: Counter((r[c] or "").split()) for r in rows} for f, c in fields.items()}
    stats = {}
    for f in weights:
        lengths = [sum(c.values()) for c in counts[f].values()]
        df = Counter(t for c in counts[f].values() for t in c)
        stats[f] = (len(rows), sum(lengths) / len(rows), df)
    result = {}
    for query_id, text in ASKED:
        for sign in '{}"':
            text = text.replace(sign, " ")
        terms = set(text.split())
        hits = []
        for row in filter(keep, rows):
            total, matched = 0.0, 0
            for term in terms:
                best = 0.0
                for f, w in weights.items():
                    n, mean, df = stats[f]
                    tf, dl = counts[f][row[0]][term], sum(counts[f][row[0]].values())
                    if tf:
                        idf = math.log(1 + (n - df[term] + 0.5) / (df[term] + 0.5))
                        best = max(best, w * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean)))
                total += best
                matched += best > 0
            if matched and matched >= need(len(terms)):
                hits.append((-round(total, 6), row[0]))
        result[query_id] = [(key, -score) for score, key in sorted(hits)[:k]]
    return {q: h for q, h in result.items() if h}


def listed(hits):
    found = {}
    for r in hits.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["doc_key"], r["score"]))
    return found


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [k for k, _ in got[q]] == [k for k, _ in want[q]], q
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=2e-6)


def test_lexical_against_brute_force(docs, asked):
    same(listed(lexical.lexical_search(docs, asked, 7)), brute_lexical(D.LEXICAL_WEIGHTS, 7))


def test_lexical_without_broadcast(docs, asked, shuffled_joins):
    plan = lexical.lexical_search(docs, asked, 7)
    assert "SortMergeJoin" in plan._jdf.queryExecution().toString()  # the vocabulary is not broadcast
    same(listed(plan), brute_lexical(D.LEXICAL_WEIGHTS, 7))
    some = lexical.lexical_search(docs, asked, 7, min_match="strict", where="parity = 'odd'")
    same(listed(some), brute_lexical(D.LEXICAL_WEIGHTS, 7, lambda r: r[4] == "odd", lambda n: n))


def test_filter_keeps_whole_index_statistics(docs, asked):
    got = listed(lexical.lexical_search(docs, asked, 5, where="parity = 'even'"))
    same(got, brute_lexical(D.LEXICAL_WEIGHTS, 5, lambda r: r[4] == "even"))


def test_many_splits_give_the_same_rows(spark, docs, asked, tmp_path, monkeypatch):
    path = str(tmp_path / "docs")
    docs.repartition(8).write.parquet(path)
    many = spark.read.parquet(path)
    monkeypatch.setattr(lexical, "few_splits", lambda df: False)
    same(listed(lexical.lexical_search(many, asked, 7)), brute_lexical(D.LEXICAL_WEIGHTS, 7))


def test_published_tables(spark, docs, asked, tmp_path):
    index = publish_lexical(docs, str(tmp_path / "p"), "published_test", ["title", "description", "text"], 4)
    hits = lexical.lexical_search(index, asked, 7)
    same(listed(hits), brute_lexical(D.LEXICAL_WEIGHTS, 7))
    same(listed(lexical.lexical_search(index, asked, 7, where="parity = 'odd'")), brute_lexical(D.LEXICAL_WEIGHTS, 7, lambda r: r[4] == "odd"))
    same(listed(lexical.lexical_search(index, asked, 7, {"text": 1.0}, "parity = 'odd'")), brute_lexical({"text": 1.0}, 7, lambda r: r[4] == "odd"))
    spark.sql("DROP TABLE published_test_documents")
    spark.sql("DROP TABLE published_test_postings")
    again = open_lexical(spark, str(tmp_path / "p"), "published_test", 4)
    same(listed(lexical.lexical_search(again, asked, 7)), brute_lexical(D.LEXICAL_WEIGHTS, 7))


@pytest.mark.parametrize("shard", [1_000_000, 20])
def test_bounds_leave_no_result_out(spark, docs, asked, tmp_path, monkeypatch, shard):
    monkeypatch.setattr(bounded, "BLOCK", 4)
    monkeypatch.setattr(bounded, "SHARD", shard)
    fields = ["title", "description", "text"]
    settled = (D.LEXICAL_WEIGHTS, {"text": 1.0})
    index = publish_lexical(docs, str(tmp_path / "b"), f"bounds_{shard}", fields, 4, settled, by_bounds=True)
    for weights in settled:
        for k in (1, 7, 500):
            same(listed(lexical.lexical_search(index, asked, k, weights)), brute_lexical(weights, k))
    assert all(blocks is not None for _, _, blocks in index.weighted)
    done = bounded.work(*index.by_weight(D.LEXICAL_WEIGHTS), lexical.query_terms(asked), 1).first()
    assert 0 < done["scored"] < done["matching"]


@pytest.mark.parametrize(
    "spec, needs",
    [
        ("flexible", [1, 1, 1, 1, 1]), ("balanced", [1, 1, 2, 2, 5]), ("strict", [1, 2, 3, 4, 10]), (2, [1, 2, 2, 2, 2]),
        ("-1", [1, 1, 2, 3, 9]), ("75%", [1, 1, 2, 3, 7]), ("-25%", [1, 2, 3, 3, 8]), ("2<-25%", [1, 2, 3, 3, 8]), ("2<-25% 9<-3", [1, 2, 3, 3, 7]),
    ],
)
def test_required_terms(spark, spec, needs):
    rows = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 10)], "n int")
    got = [r["r"] for r in rows.select("n", lexical.required_terms(F.col("n"), spec).alias("r")).orderBy("n").collect()]
    assert got == needs


def test_min_match(docs, asked):
    got = listed(lexical.lexical_search(docs, asked, 9, min_match="strict"))
    same(got, brute_lexical(D.LEXICAL_WEIGHTS, 9, need=lambda n: n))


def test_folded_field(spark):
    docs = spark.createDataFrame([("a", "Crème brûlée"), ("b", "other")], "doc_key string, text string")
    asked = spark.createDataFrame([(0, "creme")], "query_id long, query_text string")
    assert lexical.lexical_search(docs, asked, 5, {"text": 1.0}).count() == 0
    assert [r["doc_key"] for r in lexical.lexical_search(docs, asked, 5, {"text": 1.0, "text_t": 0.5}).collect()] == ["a"]
    with pytest.raises(ValueError):
        lexical.lexical_search(docs, asked, 5, {"text": 0.0})


# -- vectors ---------------------------------------------------------------------


def vector_rows(n=200, dim=8, seed=5):
    draw = np.random.default_rng(seed)
    rows = [(f"v{i:03d}", draw.standard_normal(dim).astype(np.float32).tolist(), "even" if i % 2 == 0 else "odd") for i in range(n)]
    rows += [(f"copy{i}", rows[7][1], "odd") for i in range(4)]
    rows += [("zero", [0.0] * dim, "odd"), ("none", None, "odd"), ("nan", [float("nan")] * dim, "odd")]
    return rows


def query_rows(n=9, dim=8, seed=6):
    draw = np.random.default_rng(seed)
    rows = [(i, draw.standard_normal(dim).astype(np.float32).tolist()) for i in range(n)]
    return rows + [(n, vector_rows()[7][1]), (n + 1, None)]


def brute_knn(k, keep=lambda row: True):
    found = {}
    for query_id, q in query_rows():
        if q is None:
            continue
        hits = []
        for row in filter(keep, vector_rows()):
            v = row[1]
            if v is None or len(v) != len(q):
                continue
            norm = math.sqrt(sum(x * x for x in v)) * math.sqrt(sum(x * x for x in q))
            if not norm > 0:
                continue
            hits.append((-round((1 + sum(a * b for a, b in zip(v, q)) / norm) / 2, 6), row[0]))
        found[query_id] = [(key, -score) for score, key in sorted(hits)[:k]]
    return found


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(vector_rows(), "doc_key string, embedding array<float>, parity string").repartition(5)


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(query_rows(), "query_id long, query_vec array<float>")


@pytest.mark.parametrize("by_cells", [False, True])
def test_knn_against_brute_force(vectors, points, by_cells, monkeypatch):
    monkeypatch.setattr(vector, "CELL_DOCS", 30)
    monkeypatch.setattr(vector, "CELL_QUERIES", 4)
    same(listed(vector.knn_search(vectors, points, 6, by_cells=by_cells)), brute_knn(6))
    got = listed(vector.knn_search(vectors, points, 6, where="parity = 'odd'", by_cells=by_cells))
    same(got, brute_knn(6, lambda r: r[2] == "odd"))


def test_knn_over_small_arrow_batches(spark, vectors, points):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        same(listed(vector.knn_search(vectors, points, 25)), brute_knn(25))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_large_query_tables_use_cells(vectors, points, monkeypatch):
    monkeypatch.setattr(vector, "MAX_QUERY_ROWS", 3)
    same(listed(vector.knn_search(vectors, points, 3)), brute_knn(3))


def test_vector_checks(spark, vectors, docs, points, asked):
    with pytest.raises(ValueError, match="keyword"):
        vector.knn_search(docs, points, 3)
    with pytest.raises(ValueError, match="keyword"):
        hybrid.hybrid_search(docs, asked, 3)
    mixed = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "query_id long, query_vec array<double>")
    with pytest.raises(ValueError, match="dimensions"):
        vector.knn_search(vectors, mixed, 3)
    short = vectors.union(spark.createDataFrame([("short", [1.0, 2.0], "odd")], vectors.schema))
    with pytest.raises(Exception, match="has 2"):
        vector.knn_search(short, points, 3).collect()


def test_approximate_search(vectors, points, monkeypatch):
    monkeypatch.setattr(vector, "CELL_DOCS", 20)
    exact = brute_knn(5)
    got = listed(vector.knn_approx(vectors, points, 5, tables=12, bits=3))
    truth = {(q, k) for q, hits in exact.items() for k, _ in hits}
    found = {(q, k) for q, hits in got.items() for k, _ in hits}
    assert len(truth & found) / len(truth) > 0.8
    # Scores are exact: all candidates of one bucket table give the exact result.
    same(listed(vector.knn_approx(vectors, points, 5, tables=1, bits=0)), exact)
    odd = listed(vector.knn_approx(vectors, points, 5, where="parity = 'odd'", tables=1, bits=0))
    same(odd, brute_knn(5, lambda r: r[2] == "odd"))


# -- fusion -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def both(spark, docs, asked):
    draw = np.random.default_rng(1)
    rows = [(r[0], draw.standard_normal(4).tolist() if i % 3 else None) for i, r in enumerate(corpus())]
    vecs = spark.createDataFrame(rows, "doc_key string, embedding array<float>")
    points = spark.createDataFrame([(q, draw.standard_normal(4).tolist()) for q, _ in ASKED], "query_id long, query_vec array<double>")
    return docs.join(vecs, "doc_key"), asked.join(points, "query_id")


def pairs(hits):
    return {(r["query_id"], r["doc_key"]) for r in hits.collect()}


def test_modes_are_joins_of_the_pools(both):
    docs, asked = both
    lex, vec = hybrid.hybrid_pools(docs, asked, 10)
    left, right = pairs(lex), pairs(vec)
    run = {m: pairs(hybrid.hybrid_search(docs, asked, 100, m, pool=10)) for m in D.MODES}
    assert run["union"] == left | right
    assert run["keywords_required"] == left
    assert run["meaning_required"] == right
    assert run["intersection"] == left & right and run["intersection"]


def test_ends_of_the_alpha_range(both):
    docs, asked = both
    order = lambda hits: [(r["query_id"], r["rank"], r["doc_key"]) for r in hits.orderBy("query_id", "rank").collect()]
    meaning = hybrid.hybrid_search(docs, asked, 5, "meaning_required", alpha=0.0)
    assert order(meaning) == order(vector.knn_search(docs, asked, 5))
    words = hybrid.hybrid_search(docs, asked, 5, "keywords_required", alpha=1.0)
    assert order(words) == order(lexical.lexical_leg(docs, asked, 5).filter("rank <= 5"))


def test_sweep_agrees_with_single_runs(both):
    docs, asked = both
    swept = hybrid.alpha_sweep(docs, asked, [0.2, 0.9], 5)
    for alpha in (0.2, 0.9):
        same(listed(swept.filter(F.col("alpha") == alpha)), listed(hybrid.hybrid_search(docs, asked, 5, alpha=alpha)))


def test_hybrid_is_tuned_search_with_equal_weights(both):
    docs, asked = both
    knobs = tuning.knobs({"lexical_weight": 0.3, "vector_weight": 0.7, "mm": None})
    tuned = hybrid.tuned_search(docs, asked, knobs, 5)
    same(listed(tuned), listed(hybrid.hybrid_search(docs, asked, 5, alpha=0.3)))


def test_wrong_options_fail_before_any_work(both):
    docs, asked = both
    with pytest.raises(ValueError, match="mode"):
        hybrid.hybrid_search(docs, asked, 5, "both")
    with pytest.raises(ValueError, match="alpha"):
        hybrid.hybrid_search(docs, asked, 5, alpha=1.5)
    with pytest.raises(ValueError, match="unknown"):
        tuning.knobs({"fw_titel": 1})


def test_boosts(spark):
    hits = spark.createDataFrame([(0, "a", 1.0), (0, "b", 1.0), (0, "c", 1.0)], "query_id long, doc_key string, score double")
    quality = spark.createDataFrame([("a", 1)], "doc_key string, quality int")
    boosted = {r["doc_key"]: r["score"] for r in hybrid.quality_boost(hits, quality, 0.5).collect()}
    assert boosted == {"a": 1.5, "b": 1.0, "c": 1.0}
    dated = spark.createDataFrame([("a", "2025-01-01"), ("b", "2024-12-02"), ("c", None)], "doc_key string, d string")
    dated = dated.withColumn("timestamp", F.col("d").cast("timestamp_ntz"))
    fresh = {r["doc_key"]: r["score"] for r in hybrid.freshness_boost(hits, dated, 1.0, "2025-01-01").collect()}
    assert fresh == pytest.approx({"a": 2.0, "b": 1 + math.exp(-1), "c": 1.0})


def test_knob_order():
    assert tuning.knobs()["lexical_weight"] == 0.5
    assert tuning.knobs(saved={"lexical_weight": 0.2})["lexical_weight"] == 0.2
    settled = tuning.knobs({"lexical_weight": 0.9, "fw_uri": 2.0}, {"lexical_weight": 0.2})
    assert settled["lexical_weight"] == 0.9
    assert settled["weights"] == {"title": 100.0, "uri": 2.0, "text": 1.0}


def test_fallback(spark):
    row = "query_id long, doc_key string"
    primary = spark.createDataFrame([(0, "a")], row)
    secondary = spark.createDataFrame([(0, "b"), (1, "c"), (1, "d")], row)
    assert pairs(lookup.with_fallback(primary, secondary)) == {(0, "a"), (1, "c"), (1, "d")}


def test_deep_top_k_is_whole(spark):
    rows = spark.range(5000).select(F.lit(0).alias("query_id"), F.col("id").cast("string").alias("doc_key"), (F.col("id") % 50).cast("double").alias("score"))
    top = ranking.top_k(rows, 1200)
    assert "_salt" in top._jdf.queryExecution().toString()
    want = sorted(((-(i % 50), str(i)) for i in range(5000)))[:1200]
    assert [r["doc_key"] for r in top.orderBy("rank").collect()] == [k for _, k in want]


def test_vector_work_grows_with_the_queries_not_their_square():
    import time

    import pyarrow as pa

    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((4000, 32))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    keys = pa.array([f"{i:032d}" for i in range(len(vectors))])

    def seconds(n):
        queries = rng.standard_normal((n, 32))
        queries /= np.linalg.norm(queries, axis=1)[:, None]
        best = vector.Best(queries, 10)
        best.add(vectors[:2000], keys[:2000])
        start = time.process_time()
        best.add(vectors[2000:], keys[2000:])
        return time.process_time() - start

    seconds(500)
    assert seconds(16000) < 2.5 * 16 * max(seconds(1000), 0.02)
