"""Token ids against the tokenizers library, and the ORC files that hold them."""

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from glimmerdex.llm import bpe, chunks, token_file
from glimmerdex.llm.merge_table import word_encoder

WORDS = public_tokenizers.path(bpe.VOCABULARY)
BYTES = public_tokenizers.path(token_file.VOCABULARY)
LIBRARY = {WORDS: Tokenizer.from_file(WORDS), BYTES: Tokenizer.from_file(BYTES)}

_random = random.Random(3)
ODD = [
    "",
    " ",
    "   ",
    "a  b",
    "a   b",
    "a \nb",
    "a\n b",
    "a\n \nb",
    "  a",
    "a  ",
    "a   ",
    "x  <|endoftext|> y",
    " <|endoftext|>  q <|startoftext|>",
    "a   b",
    "\x00 a\x00b  c",
    "a\x1c \x1cb",
    "Hello World's don't 123 ΣΑΣ İstanbul ñ é",
    "日本語テキスト 😀👍🏽 ｆｕｌｌ ①②",
    "a" * 5000,
    "</w> x</w>y w> </w",
    "​­ zero width﻿",
    "é ́x ŉ ﬁ ß ẞ ǅ",
] + ["".join(_random.choice("ab \n\tÉé'1.<>|Ⅷ　Σ") for _ in range(200)) for _ in range(60)]


@pytest.mark.parametrize("path, encode", [(WORDS, bpe.encode_texts), (BYTES, token_file.encode_texts)])
def test_same_ids_as_the_library(path, encode):
    for text, ids in zip(ODD, encode(ODD, path), strict=True):
        assert ids.tolist() == LIBRARY[path].encode(text, add_special_tokens=False).ids, text


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_same_ids_for_any_text(text):
    for path, encode in ((WORDS, bpe.encode_texts), (BYTES, token_file.encode_texts)):
        assert encode([text], path)[0].tolist() == LIBRARY[path].encode(text, add_special_tokens=False).ids


def test_borders_hold_exactly_when_merging_keeps_them():
    table = word_encoder(WORDS).table
    merged = np.flatnonzero(table.rank >= 0)
    rng = np.random.default_rng(1)
    left, right = rng.choice(merged, 4000), rng.choice(merged, 4000)
    open_ = np.array([not table.token[i].endswith("</w>") and table.token[j].endswith("</w>") for i, j in zip(left, right, strict=True)])
    left, right = left[open_], right[open_]
    held = table.borders_hold(left, right)
    text = {i: t for t, i in table.id.items()}
    exact = [table.merge(text[i] + text[j]) == [i, j] for i, j in zip(left.tolist(), right.tolist(), strict=True)]
    assert held.tolist() == exact and 0 < sum(exact) < len(exact)
    assert table.sound.all()


def test_only_failing_words_are_merged():
    encoder = word_encoder(WORDS)
    words = ["the", "tionthati", "reoush", "hanon"]
    ids, failed = encoder.table.encode_words(words)
    assert failed == 1  # reoush
    assert ids == [LIBRARY[WORDS].encode(w, add_special_tokens=False).ids for w in words]


def test_cache_empties_without_changing_results(monkeypatch):
    monkeypatch.setattr(chunks, "CACHE_PIECES", 5)
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(700)]
    for path, encode in ((WORDS, bpe.encode_texts), (BYTES, token_file.encode_texts)):
        assert [i.tolist() for i in encode(texts, path)] == [LIBRARY[path].encode(t, add_special_tokens=False).ids for t in texts]


def test_decoding(spark):
    rows = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    for r in bpe.encode(rows, WORDS).collect():
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["n_tokens"]
        assert r["decoded"] == LIBRARY[WORDS].decode(ids, skip_special_tokens=False)


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(1000 + i, f"text number {i}") for i in range(5000)]
    random.Random(5).shuffle(docs)
    folder = str(tmp_path_factory.mktemp("tokens") / "orc")
    token_file.write_tokens(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), folder, BYTES)
    return dict(docs), folder


def test_file_round_trip(spark, files):
    docs, folder = files
    start = 0
    rows = sorted(token_file.read_tokens(spark, folder).collect(), key=lambda r: r["doc_id"])
    sums = {r["doc_id"]: r["ids_crc32"] for r in token_file.checksums(token_file.read_tokens(spark, folder)).collect()}
    assert [r["doc_id"] for r in rows] == sorted(docs)
    for r in rows:
        ids = LIBRARY[BYTES].encode(docs[r["doc_id"]], add_special_tokens=False).ids + [0]
        assert (r["start"], r["n_tokens"], list(r["ids"])) == (start, len(ids), ids)
        assert sums[r["doc_id"]] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


def test_files_are_sorted_and_can_be_pruned(spark, files):
    _, folder = files
    ranges = []
    for name in sorted(glob.glob(f"{folder}/*.orc")):
        ids = orc.ORCFile(name).read(["doc_id"])["doc_id"].to_pylist()
        assert ids == sorted(ids)
        ranges += [(min(ids), max(ids))] if ids else []
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    wanted = spark.read.orc(folder).filter(F.col("doc_id") == 1234)
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,1234)]" in wanted._jdf.queryExecution().executedPlan().toString()
    assert wanted.count() == 1
