"""Phrase counts and scores against counting by hand."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from glimmerdex.llm import phrases


def by_hand(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    known, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 5):
                    if i + k <= len(words):
                        known[lang, tuple(words[i : i + k])] += 1
    known = {p: n for p, n in known.items() if n >= least}
    out = []
    for (lang, words), a in known.items():
        if len(words) < 2:
            continue
        inside = any(
            g == lang and len(w) > len(words) and 100 * n >= 80 * a and any(w[i : i + len(words)] == words for i in range(len(w)))
            for (g, w), n in known.items()
        )
        if not inside:
            cuts = [(2_000_000 * a // (known[lang, words[:k]] + known[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.append((lang, " ".join(words), a, known[lang, words[:k]], known[lang, words[k:]], sizes[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranked, seen = set(), Counter()
    for lang, *rest in out:
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.add((lang, seen[lang], *rest))
    return ranked


def corpus(seed):
    """Common words, set phrases inside each other, a passage that many texts hold, and pieces that end everywhere."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["Ärger", "œuf", "the", "THE", "of\x00x", "\x1cword"]
    fixed = ["New  York city", "new york", "one two three four five", "one two three four", "a a a a a a"]
    rows = []
    for _ in range(400):
        parts = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words[:12] + words[-6:]) if rng.random() < 0.8 else rng.choice(words) for _ in range(rng.randrange(40))]
        text = "".join(p + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", " ! "]) for p in parts)
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), text))
    return rows + [("en", "the same long passage of many texts again and again")] * 300 + [("en", None), (None, ""), ("en", " .,\t"), ("x", "once only")]


@pytest.mark.parametrize("group", [1_000_000, 400, 60])
def test_as_by_hand(spark, monkeypatch, group):
    """Few suffixes a task make almost every prefix a hot one."""
    monkeypatch.setattr(phrases, "GROUP", group)
    rows = corpus(3)
    docs = spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, n int, phrase string").repartition(3)
    want = by_hand(rows, 8, 40)
    assert {tuple(r) for r in phrases.collocations(docs, least=8, top=40).collect()} == want and len(want) > 50


def test_hot_prefixes_are_told(spark):
    docs = spark.createDataFrame([("en", "a b c d. a b x y. a q. z z")] * 50, "lang string, text string")
    rows = docs.selectExpr("lang", "cast(text as binary) text")
    told = {(r["words"], r["phrase"]): r["n"] for r in phrases.leading(rows, 0.15).collect()}
    assert told[0, ""] == 600 and told[1, "a"] == 150 and told[2, "a b"] == 100
    assert all(n >= 90 for n in told.values())


def test_quicksort_counts_every_prefix(monkeypatch):
    monkeypatch.setattr(phrases, "SMALL", 8)
    rng = np.random.default_rng(5)
    columns = np.minimum(rng.geometric(0.3, (4, 3000)), 6)
    for d in range(1, 4):
        columns[d][(columns[d - 1] == 0) | (columns[d] == 6)] = 0
    n = rng.integers(1, 4, 3000)
    want = Counter()
    for suffix, w in zip(columns.T.tolist(), n.tolist(), strict=True):
        for k in range(1, 5):
            if suffix[k - 1]:
                want[tuple(suffix[:k])] += w
    for whole in (1, 3):
        at, length, total = phrases.frequent(columns, n, 40, whole)
        got = [(tuple(columns[:k, i].tolist()), t) for i, k, t in zip(at.tolist(), length.tolist(), total.tolist(), strict=True)]
        assert sorted(got) == sorted((p, t) for p, t in want.items() if t >= 40 or len(p) < whole)


def test_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None)] * 3, "lang string, text string")).count() == 0
