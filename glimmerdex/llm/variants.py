"""Spelling variants by dense prefix-suffix tiling (operator 11).

Two words are near when they differ by one inserted, deleted or replaced code point, which
is when the lengths of their common prefix and suffix together reach the longer length
minus one. Near words also share a part of known place: if the change lies in a span of
the longer word, they agree before that span and after it. So every word is put into a
group for each half of its own length, and of the next longer one, by what it has outside
that half. A group of more than CROWD words is dealt again by halves of its span, which
agree on more and more, down to spans of one code point, whose groups the alphabet bounds.
A pair meets in several groups and counts in the one whose span has its place of change.

A task lays the words of its groups in padded matrices of code points and compares block
with block. It gives per word and group the number of near words and the best of them,
never the pairs.

Defined results: null texts have no words; a null id is written as an empty text before
the colon; repeated rows count again; ties between forms go to the smallest word in
code-point order; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmerdex.llm.registry import in_small_batches, pick, query, table, take_over
from glimmerdex.plans.sizing import keyed_join, written

LETTERS = "[a-zÀ-ÿ]+"
SLIP = 199  # one word in so many loses a letter
LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5  # a form is so many times as frequent
CROWD = 256
CELLS = 1 << 22
NONE = 1 << 62


def slipped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every run of letters as (word), A-Z in lower case, one in SLIP without one of its letters, by a hash of id and run."""
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = pick(docs, id=id_col, text=text_col).select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run")
    )
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = "CAST(h % length(run) AS INT)"
    return hashed.select(F.expr(f"IF(h % {SLIP} = 0, concat(left(run, {at}), substring(run, {at} + 2)), run)").alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counted = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _halved(rows: DataFrame) -> DataFrame:
    """Each row for both halves of its span, with the key of the words that agree outside of it."""
    half = F.explode(F.expr("array(struct(lo, lo + (hi - lo) div 2 AS hi), struct(lo + (hi - lo) div 2 AS lo, hi))"))
    key = F.expr("concat_ws('|', long, lo, hi, left(word, lo), right(word, long - hi))")
    spans = rows.select("word", "n", "long", half.alias("half")).select("word", "n", "long", F.expr("INT(half.lo)").alias("lo"), F.expr("INT(half.hi)").alias("hi"))
    return spans.withColumn("key", key)


def groups(words: DataFrame) -> DataFrame:
    """(key, long, lo, hi, word, n): the groups in which all near words of (word, n) meet."""
    longer = words.select("word", "n", F.explode(F.expr("array(length(word), length(word) + 1)")).alias("long"))
    open_ = _halved(longer.withColumn("lo", F.lit(0)).withColumn("hi", F.col("long")))
    ready = None
    while True:
        open_ = written(open_, "spans")
        sizes = open_.filter("hi - lo > 1").groupBy("key").agg(F.count("*").alias("members")).filter(F.col("members") > CROWD)
        crowded = written(sizes.select("key"), "crowded")
        if not crowded.limit(1).count():
            return open_ if ready is None else ready.unionByName(open_)
        settled = keyed_join(open_, crowded, ["key"], "word", "left_anti")
        ready = settled if ready is None else ready.unionByName(settled)
        open_ = _halved(keyed_join(open_, crowded, ["key"], "word", "left_semi"))


def matrix(words: list[str], width: int, right: bool = False) -> np.ndarray:
    """The code points of the words, padded with zeros to one width."""
    padded = "".join([w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words])
    return np.frombuffer(padded.encode("utf-32-le"), dtype="<u4").reshape(len(words), width)


def compared(words: list[str], order: np.ndarray, starts: np.ndarray, ends: np.ndarray, lo: np.ndarray, hi: np.ndarray, long: int) -> tuple[np.ndarray, np.ndarray]:
    """(near words, the best one's order or NONE) per word of groups given by where they start and end.

    All groups have words of `long` or one less code points; groups of one size are compared in one go, large
    ones block by block. `order` has the place of each word when the best one comes first."""
    near, best = np.zeros(len(words), dtype=np.int64), np.full(len(words), NONE, dtype=np.int64)
    left, right = matrix(words, long), matrix(words, long, right=True)
    full = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) == long
    sizes = ends - starts
    for size in np.unique(sizes[sizes > 1]).tolist():
        alike = np.flatnonzero(sizes == size)
        block = max(1, min(size, CELLS // (size * long)))  # rows of a group against all of it
        at_once = max(1, CELLS // (block * size * long))
        for g in range(0, len(alike), at_once):
            some = alike[g : g + at_once]
            members = starts[some][:, None] + np.arange(size)
            for b in range(0, size, block):
                mine = members[:, b : b + block]
                prefix = (left[mine][:, :, None, :] != left[members][:, None, :, :]).argmax(axis=-1)
                suffix = (right[mine][:, :, None, ::-1] != right[members][:, None, :, ::-1]).argmax(axis=-1)
                hit = (prefix + suffix >= long - 1) & (full[mine][:, :, None] | full[members][:, None, :])
                hit &= (prefix >= lo[some][:, None, None]) & (prefix < hi[some][:, None, None])
                hit &= mine[:, :, None] != members[:, None, :]
                near[mine] = hit.sum(axis=2)
                best[mine] = np.where(hit, order[members][:, None, :], NONE).min(axis=2)
    return near, best


TILES = "word string, near bigint, best_n bigint, best string"


def tiled(grouped: DataFrame) -> DataFrame:
    """Per word and group in which it has near words: their number, and the most frequent of them with its count."""

    def results(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        key, long = rows["key"], rows["long"].to_numpy()
        first = np.flatnonzero(np.concatenate([[True], pc.not_equal(key[1:], key[:-1]).to_numpy()]))
        last = np.append(first[1:], len(rows))
        words, n = rows["word"].to_pylist(), rows["n"].to_numpy()
        order = np.empty(len(words), dtype=np.int64)
        sorted_ = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
        order[sorted_] = np.arange(len(words))
        lo, hi = rows["lo"].to_numpy(), rows["hi"].to_numpy()
        for length in np.unique(long[first]).tolist():
            mine = np.flatnonzero((long[first] == length) & (last - first > 1))
            if not len(mine):
                continue
            at = np.concatenate([np.arange(first[g], last[g]) for g in mine])
            sizes = last[mine] - first[mine]
            ends = np.cumsum(sizes)
            near, best = compared([words[i] for i in at], order[at], ends - sizes, ends, lo[first[mine]], hi[first[mine]], length)
            hit = np.flatnonzero(near)
            chosen = [sorted_[o] for o in best[hit]]
            if len(hit):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([words[i] for i in at[hit]], pa.string()), pa.array(near[hit]),
                        pa.array(n[chosen]), pa.array([words[i] for i in chosen], pa.string()),
                    ],
                    names=["word", "near", "best_n", "best"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("variants")
        kept = None  # the last group may go on in the next batch
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if kept is None else pa.concat_tables([kept, rows])
            if not len(rows):
                continue
            same = pc.equal(rows["key"], rows["key"][len(rows) - 1]).to_numpy()
            cut = int(np.flatnonzero(same)[0])
            kept = rows.slice(cut)
            if cut:
                yield from results(rows.slice(0, cut).combine_chunks())
        if kept is not None:
            yield from results(kept.combine_chunks())

    columns = grouped.select("key", "long", "lo", "hi", "word", "n")
    return in_small_batches(columns).repartition("key").sortWithinPartitions("key").mapInArrow(run, TILES)


def forms(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n) of (word, n): the most frequent near word, where it is `times` as frequent."""
    met = tiled(groups(words)).groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    )
    fits = -F.col("first.less") >= times * F.col("n")
    return words.join(met, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("first.best")).alias("form"), F.when(fits, -F.col("first.less")).alias("form_n"),
    )


def rooted(found: DataFrame) -> DataFrame:
    """The rows of `forms` with the last word that following forms leads to. Counts grow on the way, so no way is a ring;
    every round follows twice as many forms at once."""
    steps = written(found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "steps")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = written(
            keyed_join(steps, further, ["root"], "word", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "steps",
        )
        moved = steps.filter("moved").limit(1).count()
        steps = steps.select("word", "root")
        if not moved:
            return found.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the distinct words (word, n)."""
    return rooted(written(forms(words, times), "forms")).select("word", "form", "root", "n", "n_near", "form_n")


@query("op11_variants")
def op11_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants(written(vocabulary(slipped(table(spark, sf, "documents"))), "vocabulary"))
