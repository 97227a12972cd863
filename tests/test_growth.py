"""What a task holds does not grow with the input."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from glimmerdex.operators import bounded, embed, lexical
from glimmerdex.plans import sizing
from glimmerdex.plans.catalog import QUERIES
from glimmerdex.sources.index_store import publish_lexical
from glimmerdex.streaming import ingest

SF = "/root/testdata/sf0.001"
FIELDS = ["title", "description", "text"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def files(spark, tmp_path):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[(i * j) % (j + 7)] for j in range(1, 25)) + f" only{i}" for i in range(120)]
    rows = [(f"k{i % 110:03d}", t[:20], t[:40], t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_key string, title string, description string, text string").write.parquet(str(tmp_path / "docs"))
    return spark.read.parquet(str(tmp_path / "docs"))


def test_all_postings_are_counted_in_parts_of_bounded_size(spark, files, monkeypatch):
    want = sorted(map(tuple, lexical.postings(files, FIELDS).collect()))
    monkeypatch.setattr(sizing, "TEXT_PER_TASK", 100)
    rows = lexical.postings(files, FIELDS)
    found = re.findall(r"Exchange hashpartitioning\(([^)]*), (\d+)\)", plan_of(rows))
    assert [re.sub(r"#\d+", "", keys) for keys, _ in found] == ["doc_key"] and int(found[0][1]) > 12
    assert sorted(map(tuple, rows.collect())) == want


def test_published_weights_of_rare_terms(spark, files, tmp_path, monkeypatch):
    """Too many terms to broadcast: the frequent ones are, and all have the weights they had."""
    def weights(name):
        index = publish_lexical(files, str(tmp_path / name), f"rare_{name}", FIELDS, 4)
        return sorted((r["doc_key"], r["term"], round(r["weight_0"], 9)) for r in index.rows.collect())

    want = weights("all")
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 100)
    assert len(want) > 1000 and weights("some") == want
    assert len(spark.table("rare_some_postings").inputFiles()) > len(spark.table("rare_all_postings").inputFiles())


def test_bounded_sums_never_become_rows_of_all_pairs(spark, files, tmp_path, monkeypatch):
    monkeypatch.setattr(bounded, "BLOCK", 4)
    monkeypatch.setattr(bounded, "MATRIX_CELLS", 1000)
    weights, files = {"text": 1.0}, files.dropDuplicates(["doc_key"])
    index = publish_lexical(files, str(tmp_path / "b"), "growth_bounds", FIELDS, 4, (weights,), by_bounds=True)
    asked = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 30}" for j in range(6))) for i in range(20)], "query_id long, query_text string")
    sums = []
    monkeypatch.setattr(bounded, "written", lambda df, name: sums.append((name, plan_of(df))) or sizing.written(df, name))
    got = lexical.lexical_search(index, asked, 3, weights).collect()
    assert "MapInArrow" in dict(sums)["sums"]
    want = lexical.lexical_scores(index, asked, weights).withColumn("score", F.round("score", 6))
    want = lexical.top_k(want, 3).collect()
    key = lambda rows: sorted((r["query_id"], r["rank"], r["doc_key"], r["score"]) for r in rows)
    assert key(got) == key(want)


def test_embedding_counts_parts_of_a_batch(spark, monkeypatch):
    texts = ["", "one", "two two three"] + [" ".join(f"t{i * j}" for j in range(i)) for i in range(40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    hashes = {}
    for r in rows.select("id", F.explode(F.split("text", " ")).alias("t")).filter("t <> ''").select("id", F.xxhash64("t").alias("h")).collect():
        hashes.setdefault(r["id"], []).append(r["h"])
    monkeypatch.setattr(embed, "TOKENS_AT_ONCE", 16)
    made = embed.hash_embed(rows, 32)
    assert "as smallint" in plan_of(made)  # two bytes a token go to Python
    for r in made.collect():
        sums = np.zeros(32)
        for h in hashes.get(r["id"], []):
            sums[h % 32] += 1 - 2 * ((h >> 32) % 2)
        if not sums.any():
            assert r["embedding"] is None
        else:
            assert np.allclose(r["embedding"], sums / math.sqrt((sums * sums).sum()), atol=1e-6)


def test_queue_files_grow_in_number(spark, monkeypatch):
    seen = []
    stream = ingest.file_stream
    monkeypatch.setattr(ingest, "file_stream", lambda s, path, schema, files_per_trigger: seen.append((len(s.read.parquet(path).inputFiles()), files_per_trigger)) or stream(s, path, schema, files_per_trigger))
    monkeypatch.setattr(sizing, "TEXT_PER_TASK", 30_000)
    rows = QUERIES["stream_ingest"](spark, SF).count()
    assert seen[0][0] > 4 and seen[0][1] * 2 >= seen[0][0] and rows > 0
