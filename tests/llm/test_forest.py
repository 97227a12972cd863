"""The hash-prefix forest against brute force."""

import numpy as np
import pytest

from glimmerdex.llm import forest


def brute(rows, k):
    """(query, [(vec_id, score)]) over all usable rows, for ids divisible by 50."""
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable.setdefault((i, tuple(np.float32(x) for x in v)), np.array(v, dtype=np.float32).astype(float))
    out = {}
    for (i, _), q in usable.items():
        if i % 50 == 0:
            scored = [
                (-float(np.einsum("j,j->", v, q) / (np.sqrt((v * v).sum()) * np.sqrt((q * q).sum()))), j)
                for (j, _), v in usable.items()
                if j != i and len(v) == len(q)
            ]
            out[i] = [(j, -s) for s, j in sorted((round(s, 12), j) for s, j in scored)[:k]]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows], "vec_id long, embedding array<float>, score double, shard int")


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((60, 24))
    return [(i, (centres[i % 60] + 0.4 * rng.standard_normal(24)).astype(np.float32).tolist()) for i in range(3000)]


def test_recall(spark, clustered, monkeypatch):
    monkeypatch.setattr(forest, "SHARD_ROWS", 500)
    monkeypatch.setattr(forest, "QUERY_BLOCK", 25)
    got, want = found(forest.nearest(table(spark, clustered), lambda i: i % 50 == 0)), brute(clustered, 5)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    exact = dict(clustered)
    for q, answers in got.items():
        a = np.array(exact[q], dtype=np.float32).astype(float)
        for i, score in answers:
            b = np.array(exact[i], dtype=np.float32).astype(float)
            assert abs(score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_hot_vectors_ties_and_unusable_rows(spark, shuffled_joins):
    rng = np.random.default_rng(5)
    hot = rng.standard_normal(8).astype(np.float32).tolist()
    rows = [(i, hot) for i in range(0, 400)] + [(1000 + i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(60)]
    rows += [(50, hot), (50, hot), (None, hot), (5000, None), (5050, []), (5100, [0.0] * 8), (5150, [None] + [1.0] * 7)]
    rows += [(5200, [float("nan")] + [1.0] * 7), (5250, [float("inf")] + [1.0] * 7), (6000, [1.0, 2.0]), (6001, [2.0, 1.0])]
    got = found(forest.nearest(table(spark, rows), lambda i: i % 50 == 0, share=1.0))
    want = brute(rows, 5)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items() if v}
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[50]] == [0, 1, 2, 3, 4]
    assert [i for i, _ in got[6000]] == [6001]


def test_descent_and_ascent():
    rng = np.random.default_rng(7)
    vectors = rng.standard_normal((300, 16))
    tree = forest.Forest(vectors)
    codes = forest.strings(vectors[:20])
    assert (tree.depth(codes) == forest.BITS).all()
    for wanted in (1, 30, 300, 1000):
        met = tree.candidates(codes, wanted)
        assert (met.sum(1) >= min(wanted, 300)).all() and met[np.arange(20), np.arange(20)].all()
    # candidates of the deeper level stay when the search ascends
    assert (tree.candidates(codes, 30) <= tree.candidates(codes, 200)).all()
