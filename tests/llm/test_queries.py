"""Every registered query on the smallest tables: against its SQL where it has one, else against brute force."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from compare import database, difference
from tokenizers import Tokenizer

import corpus_pipeline
from glimmerdex.llm import bpe, decontaminate, simhash, token_file
from glimmerdex.llm.catalog import CHECKS, QUERIES
from test_duplicates import by_hand as fingerprint
from test_duplicates import grouped
from test_forest import brute
from test_overlaps import by_hand as overlap
from test_scans import PII
from test_scans import by_hand as matches

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


@pytest.fixture(scope="module")
def rows(spark):
    kept = {}

    def of(name):
        if name not in kept:
            kept[name] = QUERIES[name](spark, SF).collect()
        return kept[name]

    return of


@pytest.mark.parametrize("key", sorted(CHECKS))
def test_same_rows_as_sql(spark, key):
    assert difference(QUERIES[key](spark, SF).toPandas(), database(SF).execute(CHECKS[key]).df()) is None


def test_names():
    assert [k.split("_")[0] for k in sorted(QUERIES, key=lambda k: int(k[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 11)] + ["op11", "op12", "op13"]


def test_token_file(rows, texts):
    library, start = Tokenizer.from_file(public_tokenizers.path(token_file.VOCABULARY)), 0
    got = {r["doc_id"]: r for r in rows("op2_token_file")}
    assert set(got) == set(texts)
    for i in sorted(texts):
        ids = library.encode(texts[i] or "", add_special_tokens=False).ids + [0]
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_codec(rows, texts):
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    for r in rows("op9_bpe_codec"):
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        assert tuple(r)[1:] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest())


def test_simhash(rows, texts):
    prints = {i: fingerprint(t) for i, t in texts.items()}
    want = {(i, f"{prints[i]:016x}", c) for i, c in grouped(prints).items()}
    assert {tuple(r) for r in rows("op3_simhash")} == want and len(want) == len(texts)


def test_personal_data(rows, texts):
    for r in rows("op7_pii"):
        want = matches(texts[r["doc_id"]], PII)
        shown = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert r["spans"].startswith(shown)
        assert [r[f"n_{k}"] for k in PII] == [sum(w[0] == k for w in want) for k in PII]


def test_decontamination(spark, rows, texts):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    plain = {r["doc_id"]: r["t"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", decontaminate.normal("text").alias("t")).collect()}
    items = {r["item_id"]: r["t"] for r in bench.select("item_id", decontaminate.normal("text").alias("t")).collect()}
    want = {(d, i) for d, t in plain.items() for i, item in items.items() if len(set(t.split()) & set(item.split())) > 8 and overlap(t, item)}
    assert {(r["doc_id"], r["item_id"]) for r in rows("op4_decontaminate")} == want


def test_nearest(rows):
    vectors = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    want, hits = brute(vectors, 5), 0
    got = {}
    for r in rows("op1_forest"):
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert set(got) == set(want)
    for q, answers in want.items():
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        hits += len({i for i, _ in answers} & set(got[q].values()))
    assert hits >= 0.9 * 5 * len(want)


def test_quality(rows, texts):
    got = rows("op6_quality")
    assert {r["doc_id"] for r in got} == set(texts)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.7)


def test_pipeline(spark, texts):
    """The stages one after another, each decision taken again by hand on what the stage got."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    start = docs.filter("doc_id % 2 = 0")  # each stage is handed a part that the ones before did not shape
    kept = {r["doc_id"] for r in stage["simhash_near_dedup"](spark, start, SF).collect()}
    prints = {i: fingerprint(t) for i, t in texts.items() if i % 2 == 0}
    assert kept == {i for i, c in grouped(prints).items() if i == c}
    clean = {r["doc_id"] for r in stage["benchmark_decontamination"](spark, docs, SF).collect()}
    bad = {r["doc_id"] for r in QUERIES["op4_decontaminate"](spark, SF).collect()}
    assert bad and clean == set(texts) - bad
    last = {r["doc_id"]: r for r in stage["bpe_codec"](spark, docs, SF).collect()}
    assert {i: r["n_tokens"] for i, r in last.items()} == {r["doc_id"]: r["n_tokens"] for r in QUERIES["op9_bpe_codec"](spark, SF).collect()}
    whole = corpus_pipeline.run(spark, SF).toPandas()
    assert 0 < len(whole) < len(texts) and set(whole["doc_id"]) <= clean
    found = [i for i in whole["doc_id"] if matches(texts[i], PII)]
    assert found and not any(m[0] == "email" for i in found for m in matches(whole.set_index("doc_id").loc[i, "decoded"], PII))
    assert simhash.RADIUS == 2
