"""Decontamination against overlaying every text and item by hand."""

import itertools
import random

import numpy as np
import pytest

from glimmerdex.llm import decontaminate as D


def test_masks_find_every_placement_of_substitutions():
    for lost in itertools.combinations(range(D.WINDOW), D.SUBSTITUTED):
        assert any(
            not {at + m for m in mask} & set(lost) for mask in D.MASKS for at in range(D.WINDOW - mask[-1])
        ), lost


@pytest.mark.parametrize("tokens", range(1, D.WINDOW))
def test_runs_find_every_placement_in_short_items(tokens):
    (run,) = D.masks_for(tokens)
    for lost in itertools.combinations(range(tokens), D.allowed(tokens)):
        assert any(not {at + m for m in run} & set(lost) for at in range(tokens - run[-1]))


def by_hand(text, item):
    text, item = text.split(), item.split()
    window = min(len(item), D.WINDOW)
    spare = D.SUBSTITUTED if len(item) >= D.WINDOW else D.allowed(len(item))
    if not item or (len(item) < D.LEAST and len(text) != len(item)):
        return False
    return any(
        sum(a == b for a, b in zip(text[i : i + window], item[j : j + window], strict=True)) >= window - spare
        for i in range(len(text) - window + 1)
        for j in range(len(item) - window + 1)
    )


def cases(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "of", "the"] + [f"w{i}" for i in range(40)])
    items = [[word() for _ in range(n)] for n in [0, 1, 2, 3, 4, 5, 6, 8, 9, 10, 12, 13, 14, 15, 20, 30, 45] * 2]
    texts = [[word() for _ in range(rng.randrange(60))] for _ in range(40)]
    for item in items:
        for lost in (0, 1, 2, 3, 5):
            copy = list(item)
            for i in rng.sample(range(len(copy)), min(lost, len(copy))):
                copy[i] = "changed"
            cut = rng.randrange(len(copy) + 1) if lost == 5 else 0
            texts.append([word() for _ in range(rng.randrange(6))] + copy[cut:] + [word() for _ in range(rng.randrange(6))])
            texts.append(copy)
    return [" ".join(t) for t in texts], [" ".join(i) for i in items]


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 400])
def test_same_overlaps_as_by_hand(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(D, "BLOCK_BYTES", block_bytes)
    texts, items = cases(2)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = D.contaminated(docs, bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert len(got) == len(found)
    want = {(d, i) for d, t in enumerate(texts) for i, item in enumerate(items) if by_hand(t, item)}
    assert got == want and len(want) > 100


def test_places_and_marks_of_punctuation(spark):
    item = "Alpha, beta gamma; delta: epsilon zeta eta theta iota kappa lambda mu nu xi"
    text = "Before! ALPHA beta (gamma) delta epsilon ZETA other theta iota kappa lambda mu nu xi after"
    (hit,) = D.contaminated(
        spark.createDataFrame([(7, text)], "doc_id long, text string"),
        spark.createDataFrame([(3, item)], "item_id long, text string"),
    ).collect()
    assert hit.asDict() == {"doc_id": 7, "item_id": 3, "start": 1, "end": 15, "agreeing": 13, "item_tokens": 14}


def test_token_hashes_do_not_depend_on_the_place():
    tokens, bounds = D.token_hashes(["aa bb cc", "", "bb", "cc é aa"])
    assert bounds.tolist() == [0, 3, 3, 4, 7]
    assert tokens[1] == tokens[3] and tokens[0] == tokens[6] and tokens[2] == tokens[4]
    assert len(np.unique(tokens)) == 4
