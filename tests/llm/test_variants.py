"""Spelling variants against comparing all pairs of words."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from glimmerdex.llm import variants
from glimmerdex.llm.catalog import QUERIES


def slips(docs):
    out = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return out


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def by_hand(counts, times=5):
    near = {w: [] for w in counts}
    words = sorted(counts)
    for k, a in enumerate(words):
        for b in words[:k]:
            if abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    root = {}
    for w in counts:
        root[w] = w
        while form[root[w]] is not None:
            root[w] = form[root[w]]
    return {(w, form[w], root[w], counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts}


def edits(rng, word, alphabet):
    at, kind = rng.randrange(len(word)), rng.randrange(3)
    return word[:at] + ("" if kind == 0 else rng.choice(alphabet)) + word[at + (kind < 2) :]


def family(seed, alphabet="abä\U0001f600z"):
    """Words on few letters, so that many are near each other, with repeated letters and shared beginnings."""
    rng = random.Random(seed)
    words = {"aaaaaa", "aaaaaaa", "aaaaaaaa", "prefix" * 4, "prefix" * 4 + "x", "y" + "prefix" * 4, "k" * 3000, "k" * 2999}
    for _ in range(12):
        base = "".join(rng.choice(alphabet) for _ in range(rng.randrange(6, 12)))
        for _ in range(40):
            words.add(base)
            base = (edits(rng, base, alphabet) if rng.random() < 0.8 else base[:-1]) or "abaz"
    words |= {"common" + "".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)}
    return {w: rng.choice([5, 5, 6, 30, 31, 200, 1200]) for w in words if w}


@pytest.mark.parametrize("crowd", [256, 4])
def test_as_by_hand(spark, monkeypatch, shuffled_joins, crowd):
    monkeypatch.setattr(variants, "CROWD", crowd)
    counts = family(1)
    rows = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = [tuple(r) for r in variants.variants(rows).collect()]
    assert len(got) == len(counts) and set(got) == by_hand(counts)
    assert len({r[2] for r in got if r[1]}) > 3 and any(r[1] and r[1] != r[2] for r in got)


def test_blocks_of_a_large_group(monkeypatch):
    monkeypatch.setattr(variants, "CELLS", 600)
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice([6, 7]))) for _ in range(150)})
    size = len(words)
    near, best = variants.compared(words, np.arange(size)[::-1].copy(), np.array([0]), np.array([size]), np.array([0]), np.array([7]), 7)
    for i, w in enumerate(words):
        others = [j for j, o in enumerate(words) if max(len(w), len(o)) == 7 and one_edit(w, o)]
        assert near[i] == len(others) and best[i] == min((size - 1 - j for j in others), default=variants.NONE)


def test_words_of_texts(spark):
    docs = [(i, t) for i in [*range(300), None, -4] for t in ("Straße naïve × ÷x, ABC-defĀghi", None, "", "word1word")]
    rows = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, word string")
    assert {r["word"]: r["count"] for r in variants.slipped(rows).groupBy("word").count().collect()} == dict(slips(docs))


def test_query(spark):
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    counts = {w: n for w, n in slips(docs).items() if len(w) >= 6 and n >= 5}
    got = [tuple(r) for r in QUERIES["op11_variants"](spark, "/root/testdata/sf0.001").collect()]
    assert len(got) == len(counts) > 100 and set(got) == by_hand(counts)


def test_empty_tables(spark):
    for rows in ([], [(1, None), (None, "")], [(1, "once only words")]):
        words = variants.vocabulary(variants.slipped(spark.createDataFrame(rows, "doc_id long, text string")))
        assert variants.variants(words).count() == 0
