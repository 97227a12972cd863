"""Queries take every row of their tables."""

from pyspark.sql import functions as F

from glimmerdex.plans.catalog import QUERIES


def test_short_passages_of_every_item(spark, tmp_path):
    texts = [f"a{i}x b{i} c{i} d{i}" for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items = [(i, " ".join(t.split()[:4])) for i, t in enumerate(texts)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = QUERIES["known_items_short"](spark, str(tmp_path)).select("query_id").collect()
    assert sorted(r["query_id"] for r in found) == [i * 10 + n for i in range(20) for n in (1, 2, 3)]
