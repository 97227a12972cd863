"""Fingerprints and their links against brute force."""

import random
import re

import numpy as np
import xxhash

from glimmerdex.llm import simhash
from glimmerdex.llm.components import components


def by_hand(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints):
    """The smallest id reachable over links of two bits or fewer."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], dtype=np.uint64)
    parent = dict(zip(ids, ids, strict=True))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values[:k] ^ values[k]) <= 2):
            a, b = find(ids[j]), find(i)
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


TEXTS = [None, "", " \n\t ", "one", "One TWO", "ÄÖ É \x1c x", "a b c", "A  b\nc", "w " * 30000, "x" * 200000]


def test_fingerprints(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    got = {r["doc_id"]: r["fp"] % (1 << 64) for r in simhash.fingerprints(rows).collect()}
    assert got == {i: by_hand(t) for i, t in enumerate(TEXTS)}


def planted(seed):
    """Fingerprints with exact copies, chains of small steps and a full ball around one value."""
    rng = random.Random(seed)
    values = [rng.getrandbits(64) for _ in range(300)]
    chain = [values[0]]
    for _ in range(120):
        flips = rng.sample(range(64), 2)
        chain.append(chain[-1] ^ (1 << flips[0]) ^ (1 << flips[1]))
    ball = [values[1]] + [values[1] ^ (1 << b) for b in range(64)]
    near = [v ^ (1 << rng.randrange(64)) for v in values[2:80]] + [v ^ 7 << rng.randrange(60) for v in values[80:160]]
    copies = [values[5]] * 200
    everything = values + chain + ball + near + copies + [0, 0, 1]
    rng.shuffle(everything)
    return dict(enumerate(everything))


def test_links_lose_no_connection(spark, monkeypatch, shuffled_joins):
    prints = planted(4)
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *_: docs)
    got = simhash.near_duplicates(spark.createDataFrame(signed, "doc_id long, fp long"))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == grouped(prints)


def test_long_chain_of_a_graph(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 2000), (2000, 1500)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 2000: 1000, 1500: 1000}
