"""Blocks of postings by term: what is shuffled and written of a posting is a few bytes."""

import re
import time

import pytest
from pyspark.sql import functions as F

from glimmerdex.operators import bounded
from glimmerdex.plans import sizing


@pytest.mark.parametrize("shard", [1_000_000, 10])
def test_blocks_hold_every_posting_once(spark, tmp_path, monkeypatch, shard):
    for name, value in (("BLOCK", 4), ("SHARD", shard), ("GROUP", 100), ("PACKED", 50)):
        monkeypatch.setattr(bounded, name, value, raising=False)
    rows = [(None if i == 5 else f"k{i % 38:02d}", f"wört{j}", float((i * j) % 7 + 1) / 3) for i in range(40) for j in range(i % 12)]
    spark.createDataFrame(rows, "doc_key string, term string, weight double").write.parquet(str(tmp_path / "rows"))
    made = bounded.blocks(spark.read.parquet(str(tmp_path / "rows")))
    plan = made._jdf.queryExecution().executedPlan().toString()
    by_term = [e for e in re.findall(r"Exchange \w+partitioning\(([^)]*)\)", plan) if "doc_key" not in e]
    assert len(by_term) == 1 and by_term[0].startswith("target")  # packs of postings, not postings
    made = sizing.written(made, "blocks").collect()
    keys = {(r["shard"], r["block"] + i): k for r in made if r["keys"] is not None for i, k in enumerate(r["keys"])}
    assert len(keys) == len({r[0] for r in rows}) == len(set(keys.values()))
    blocks = [r for r in made if r["term"] is not None]
    got = [(keys[d["part"], d["at"]], r["term"], round(d["weight"], 5)) for r in blocks for d in r["docs"]]
    assert sorted(got, key=repr) == sorted(((k, t, round(w, 5)) for k, t, w in rows), key=repr)
    assert all(len(r["docs"]) <= 4 and r["top"] >= r["docs"][0]["weight"] == max(d["weight"] for d in r["docs"]) for r in blocks)
    by_shard = {}
    for r in sorted(blocks, key=lambda r: r["block"]):
        by_shard.setdefault((r["term"], r["shard"]), []).append(r)
    for some in by_shard.values():
        assert [r["block"] for r in some] == list(range(len(some)))
        assert [len(r["docs"]) for r in some[:-1]] == [4] * (len(some) - 1)
        tops = [r["top"] for r in some]
        assert tops == sorted(tops, reverse=True)
    assert (len({s for _, s in by_shard}) > 1) == (shard == 10)


def test_written_tables_leave_no_shuffle_files(spark):
    def files():
        found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before = files()
    rows = sizing.written(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "sums")
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before and rows.count() == 7
