"""Retrieval quality against known items."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glimmerdex.functions.text import tokens
from glimmerdex.plans.sizing import in_small_batches, is_small, keyed_join, written

GRAM = 6  # characters of a passage without inner words that are looked up
DOCS_AT_ONCE = 512
WORDS_KEPT = 500_000  # words a task remembers what it found for


def retrieval_eval(hits: DataFrame, truth: DataFrame, by: list[str], k: int = 10) -> DataFrame:
    """(…by, n_queries, hit_at_k, mrr) for a truth table (query_id, doc_key).

    A query counts with the best rank of any of its true documents.
    """
    known = written(truth.select("query_id", "doc_key"), "truth").select("query_id", "doc_key", F.lit(True).alias("_true"))
    rank = F.when(F.col("_true") & (F.col("rank") <= k), F.col("rank"))
    best = (
        hits.join(known, ["query_id", "doc_key"], "left")
        .groupBy(*by, "query_id")
        .agg(F.min(rank).alias("_best"))
        .groupBy(*by)
        .agg(F.count("_best").alias("_hits"), F.coalesce(F.sum(1.0 / F.col("_best")), F.lit(0.0)).alias("_sum"))
    )
    rows = best.withColumn("n_queries", known.agg(F.count_distinct("query_id")).scalar())
    return rows.select(
        *by,
        "n_queries",
        F.round(F.col("_hits") / F.col("n_queries"), 6).alias("hit_at_k"),
        F.round(F.col("_sum") / F.col("n_queries"), 6).alias("mrr"),
    )


def _folded(word: Column) -> Column:
    return F.translate(word, "ς", "σ")  # the one letter whose lower case depends on what follows


def _beginnings(short: DataFrame) -> list[tuple[int, DataFrame]]:
    """Passages without inner words with what to look up: the begin of their longest word, by its length up to
    GRAM, or with 0 the first character of one that has no words."""
    longest = F.array_max(F.transform(tokens("_passage"), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    size = F.least(F.coalesce(F.length(longest), F.lit(0)), F.lit(GRAM))
    key = F.when(longest.isNull(), F.substr("_passage", F.lit(1), F.lit(1))).otherwise(F.substr(_folded(longest), F.lit(1), F.lit(GRAM)))
    keyed = short.withColumn("_begin", key).withColumn("_size", size)
    sizes = [r["_size"] for r in keyed.select("_size").distinct().collect()]  # at most GRAM + 1
    return [(n, keyed.filter(F.col("_size") == n).drop("_size")) for n in sorted(sizes)]


def _characters(documents: DataFrame) -> DataFrame:
    """(doc_key, _begin): the distinct characters of a document."""
    return documents.select("doc_key", F.explode(F.array_distinct(F.split("text", ""))).alias("_begin"))


def _grams(words: DataFrame, size: int) -> DataFrame:
    """(_word, _begin): the character n-grams of each word, repeats included."""
    long_enough = words.filter(F.length("_word") >= size)
    places = long_enough.select("_word", F.explode(F.sequence(F.lit(1), F.length("_word") - size + 1)).alias("_at"))
    return places.select("_word", F.substr(_folded(F.col("_word")), F.col("_at"), F.lit(size)).alias("_begin"))


def _met_in_tasks(documents: DataFrame, anchors: DataFrame, begins: list[tuple[int, DataFrame]]) -> DataFrame:
    """The same as `_holding` for passages that may be broadcast: nothing is shuffled, and a task looks up each word once."""
    wanted = anchors.select("query_id", "_passage", F.col("_word").alias("_begin"), F.lit(None).cast("int").alias("_size"))
    for size, some in begins:
        wanted = wanted.unionByName(some.select("query_id", "_passage", "_begin", F.lit(size).alias("_size")))
    table = wanted.toArrow()
    of_size: dict[int | None, dict[str, list[int]]] = {}
    for number, (begin, size) in enumerate(zip(table["_begin"].to_pylist(), table["_size"].to_pylist(), strict=True)):
        of_size.setdefault(size, {}).setdefault(begin, []).append(number)
    shared = documents.sparkSession.sparkContext.broadcast((of_size.pop(None, {}), sorted(of_size.items())))

    def look_up(word: str, inner: dict[str, list[int]], sizes: list[tuple[int, dict[str, list[int]]]]) -> list[int]:
        folded, found = word.replace("ς", "σ"), list(inner.get(word, ()))
        for n, begins in sizes:
            places = len(folded) - n + 1
            if len(begins) < places:
                met = [begin for begin in begins if begin in folded]
            else:
                met = begins.keys() & {folded[i : i + n] for i in range(places)}
            for begin in met:
                found += begins[begin]
        return found

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        inner, sizes = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                rows = batch.slice(at, DOCS_AT_ONCE)
                words = rows.column("_words").flatten().dictionary_encode()
                if len(known) > WORDS_KEPT:
                    known.clear()
                names = words.dictionary.to_pylist()
                for name in names:
                    if name not in known:
                        known[name] = look_up(name, inner, sizes)
                n = np.array([len(known[name]) for name in names], np.int64)
                numbers = np.fromiter(chain.from_iterable(known[name] for name in names), np.int64, int(n.sum()))
                lengths = pc.list_value_length(rows.column("_words")).to_numpy(zero_copy_only=False)
                document = np.repeat(np.arange(rows.num_rows), lengths)
                place = words.indices.to_numpy()
                document, place = document[n[place] > 0], place[n[place] > 0]
                entry = np.arange(n[place].sum()) + np.repeat((np.cumsum(n) - n)[place] - (np.cumsum(n[place]) - n[place]), n[place])
                found = np.unique(np.repeat(document, n[place]) * table_rows + numbers[entry])
                keys = rows.column("doc_key").take(pa.array(found // table_rows))
                yield pa.RecordBatch.from_arrays([keys, pa.array((found % table_rows).astype(np.int32))], names=["doc_key", "_no"])

    table_rows = max(table.num_rows, 1)
    numbered = table.drop_columns(["_begin", "_size"]).append_column("_no", pa.array(np.arange(table.num_rows), pa.int32()))
    words = documents.select("doc_key", F.array_distinct(tokens("text")).alias("_words"))
    kind = words.schema["doc_key"].dataType.simpleString()
    met = in_small_batches(words).mapInArrow(meet, f"doc_key {kind}, _no int")
    return met.join(F.broadcast(documents.sparkSession.createDataFrame(numbered)), "_no").select("doc_key", "query_id", "_passage")


def _holding(documents: DataFrame, anchors: DataFrame, begins: list[tuple[int, DataFrame]]) -> DataFrame:
    """(doc_key, query_id, _passage): documents with the inner word of a passage, or with a word that holds its begin.

    Texts are cut into words once. Begins are looked up in the distinct words of all documents, each of which is cut
    into n-grams once however often it occurs. Documents then meet the words found, and one with several of them is a candidate once."""
    words = F.array_distinct(tokens("text")).alias("_words")
    rows = written(documents.select("doc_key", F.monotonically_increasing_id().alias("_row"), words), "words")
    vocabulary = written(rows.select(F.explode("_words").alias("_word")).distinct(), "vocabulary")
    passage = ["query_id", "_passage", "_word"]
    pairs = anchors.groupBy(*passage).agg(F.count(F.lit(1)).alias("_times"))
    for size, wanted in begins:
        wanted = wanted.groupBy("query_id", "_passage", "_begin").agg(F.count(F.lit(1)).alias("_times"))
        met = keyed_join(_grams(vocabulary, size), wanted, ["_begin"], "_word")
        pairs = pairs.unionByName(met.select(*passage, "_times"))
    pairs = written(pairs.distinct(), "passage-words")
    met = keyed_join(rows.select("doc_key", "_row", F.explode("_words").alias("_word")), pairs, ["_word"], "doc_key")
    met = met.drop("_word").distinct()
    again = F.explode(F.array_repeat(F.lit(0), F.col("_times").cast("int"))).alias("_again")
    return met.select("doc_key", "query_id", "_passage", again).drop("_again")


def known_items(documents: DataFrame, passages: DataFrame) -> DataFrame:
    """(query_id, doc_key) where a passage occurs word for word in a document.

    The inner words of a passage (all but the first and last, which may be cut) must be
    words of the document, so its longest inner word is an equi-join key. A passage
    without inner words is met by the begin of its longest word instead, an n-gram of a
    word of the document. Only keys travel to that join; texts are attached to the
    candidates, which are then checked on the whole text. An empty passage is no item.
    """
    words = tokens("query_text")
    inner = F.transform(F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0))), lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))
    asked = passages.filter(F.length("query_text") > 0).select(
        "query_id", F.col("query_text").alias("_passage"), F.array_max(inner)["w"].alias("_word")
    )
    anchors = asked.filter(F.col("_word").isNotNull())
    begins = _beginnings(asked.filter(F.col("_word").isNull()).drop("_word"))
    in_words = [(size, wanted) for size, wanted in begins if size]
    if in_words:
        candidates = (_met_in_tasks if is_small(asked) else _holding)(documents, anchors, in_words)
    else:
        found = documents.select("doc_key", F.explode(F.array_distinct(tokens("text"))).alias("_word"))
        candidates = keyed_join(found, anchors, ["_word"], "doc_key").select("doc_key", "query_id", "_passage")
    for _, wanted in begins[: len(begins) - len(in_words)]:
        met = keyed_join(_characters(documents), wanted, ["_begin"], "doc_key").select("doc_key", "query_id", "_passage")
        candidates = candidates.unionByName(met)
    met = written(candidates, "candidates")
    texts = keyed_join(met, documents.select("doc_key", "text"), ["doc_key"], "query_id") if not is_small(met) else (
        documents.select("doc_key", "text").join(F.broadcast(met), "doc_key")
    )
    return texts.filter(F.contains("text", "_passage")).select("query_id", "doc_key")
