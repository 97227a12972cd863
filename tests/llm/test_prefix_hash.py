"""Prefix hashes, fingerprints and neighbours against plain string work."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from glimmerdex.llm import prefix_hash as P
from glimmerdex.llm.catalog import QUERIES


def prints(*texts):
    return P.fingerprints(P.Prefixes(list(texts)))


def prose(rng, n):
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöü\U0001f600") for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    return " ".join(rng.choice(words) for _ in range(n))


def test_every_span_and_extension(monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 64)
    monkeypatch.setattr(P, "MODULI", [])
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab\0\U0001f600") for _ in range(n)) for n in (0, 1, 63, 64, 65, 400, 130)] + ["ab" * 100, "ab" * 90]
    whole, hashed = "".join(texts), P.Prefixes(texts)
    pairs = np.array([(rng.randrange(len(whole)), rng.randrange(len(whole))) for _ in range(4000)])
    most = len(whole) - pairs.max(axis=1)
    size = np.array([rng.randrange(m + 1) for m in most]) % 7
    same = hashed.equal(pairs[:, 0], pairs[:, 1], size)
    assert same.tolist() == [whole[a : a + n] == whole[b : b + n] for (a, b), n in zip(pairs.tolist(), size.tolist(), strict=True)]
    want = [next((k for k in range(m) if whole[a + k] != whole[b + k]), m) for (a, b), m in zip(pairs.tolist(), most.tolist(), strict=True)]
    assert hashed.extension(pairs[:, 0], pairs[:, 1], most).tolist() == want


def test_fingerprints_do_not_depend_on_company():
    rng = random.Random(2)
    texts = [prose(rng, n) for n in (0, 1, 5, 40, 3000, 30000)] + ["", "x", "x" * 100_000, "ab " * 50_000]
    together = [f.text() for f in prints(*texts)]
    assert together == [prints(t)[0].text() for t in texts] and together[0] == together[6]
    assert len(set(together)) == len(texts) - 1
    for f in prints(*texts):
        again = P.Fingerprint.read(f.text())
        assert (again.n, again.rank, again.places) == (f.n, f.rank, f.places) and len(f.places) <= P.PLACES + 1


@pytest.mark.parametrize("n", [20, 300, 8000])
def test_likeness(n):
    rng = random.Random(n)
    a, b = prose(rng, n), prose(rng, n)
    quarter = len(a) // 4
    changed, moved = P.edited(a, b), b[:quarter] + a[quarter:]
    inserted = a[: len(a) // 3] + "something new" + a[len(a) // 3 :]
    fa, fb, fc, fm, fi = prints(a, b, changed, moved, inserted)
    assert P.likeness(fa, fa) == 1.0 and P.likeness(fa, fb) < 0.1
    assert 0.55 < P.likeness(fa, fc) <= 0.85 and 0.5 < P.likeness(fa, fm) <= 0.85
    assert P.likeness(fa, fi) > (0.7 if n > 20 else 0.5)
    for x in (fb, fc, fm, fi):
        assert abs(P.likeness(fa, x) - P.likeness(x, fa)) < 0.2


def test_likeness_of_odd_texts():
    empty, one, other, long, longer, half = prints("", "x", "y", "ab" * 5000, "ab" * 6000, "abcd")
    assert P.likeness(empty, empty) == 1.0 and P.likeness(empty, one) == P.likeness(one, empty) == P.likeness(one, other) == 0.0
    assert 0 <= P.likeness(long, longer) <= 1 and 0 <= P.likeness(half, long) <= 1
    assert P.likeness(*prints("abcd", "abcx")) == 0.75


def in_order(docs):
    return sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0))


def check(rows, docs):
    """Rows of documents with distinct ids against slicing strings."""
    docs, got = in_order(docs), {r["doc_id"]: r for r in rows}
    assert len(rows) == len(got) == len(docs)
    texts = [t or "" for _, t in docs]
    for k, (i, _) in enumerate(docs):
        text, following = texts[k], texts[(k + 1) % len(docs)]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        fa, fb, fc = prints(text, following, changed)
        first = next((j for j, (x, y) in enumerate(zip(text, changed, strict=False)) if x != y), min(len(text), len(changed)))
        want = (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), fa.text(), fc.text(), P.likeness(fa, fc), P.likeness(fa, fb), first)
        assert tuple(got[i]) == want


@pytest.mark.parametrize("task", [32 << 20, 2000])
def test_neighbours(spark, monkeypatch, task):
    """Ranges of few bytes make neighbours of most documents stand in another task."""
    monkeypatch.setattr(P, "BYTES_A_TASK", task)
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.choice([0, 1, 3, 30, 200]))) for i in rng.sample(range(-500, 500), 150)] + [(None, "first of all, without a number"), (900, None)]
    rows = spark.createDataFrame([(t, i, "x") for i, t in docs], "text string, doc_id long, h string").repartition(5)
    check(P.document_fingerprints(rows).collect(), docs)


def test_few_and_repeated_documents(spark):
    of = lambda rows: P.document_fingerprints(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert of([]) == []
    alone = of([("a", "a single text of this table")])
    assert [r["near_next"] for r in alone] == [1.0]
    twice = of([("a", "the same text again")] * 7 + [("b", None), ("b", "other text")])
    assert len(twice) == 9 and [r["near_next"] for r in twice].count(1.0) >= 6
    assert len({r["fingerprint"] for r in twice}) == 3


def test_query(spark):
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    rows = QUERIES["op13_fingerprints"](spark, "/root/testdata/sf0.001").collect()
    check(rows, docs)
    assert np.median([r["near_edited"] for r in rows]) > 0.6 > 0.1 > np.median([r["near_next"] for r in rows])
