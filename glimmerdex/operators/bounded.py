"""Keyword search over published weights that leaves out what cannot reach the top k. Exact.

Once the field weights are settled, every posting has one weight. A published index keeps
them twice: by document, and by term in blocks of falling weight with the block's greatest
one. A search then goes in four steps, each a join against measured, small tables:

1. The first block of every query term gives some documents, and the k-th best sum of
   what is known of them is a bound: k documents have at least that.
2. The bound is shared out among the terms, as evenly as their greatest weights allow. A
   document whose weights all stay within these shares cannot reach the bound.
3. Blocks are read as far as they hold weights beyond the share of their term, and summed
   per document. The k-th best sum is a better bound, and what a document can add to its
   sum is known: the shares of the terms it was not read for.
4. Documents that could still reach the bound get their weights from the rows of their
   own, and the best k of them are the result.

Bounds are compared with a margin wider than the rounding of scores, so ties stay. Blocks name
a document by two small numbers and round weights to four bytes, which every bound allows for;
keys are listed once beside them, and results are summed from the rows by document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glimmerdex.operators.matching import numbered
from glimmerdex.operators.ranking import rounded, top_k
from glimmerdex.plans.sizing import broadcast_if_small, in_small_batches, written

BLOCK = 128
SHARD = 1_000_000  # postings of a term that are put in order together
GROUP = 1_000_000  # postings that a task puts in order at once
PACKED = 500_000  # postings that are packed at once
MARGIN = 1e-4
ROUNDING = 1e-6  # more than the part by which a weight in four bytes differs
MATRIX_CELLS = 4_000_000  # terms x documents that a task adds up at once
PART = 0.15  # of the bound that is shared out: less means more read by term and fewer documents to complete


_PACKS = """target int, part int, first int, n int, lengths binary, names binary, counts binary, shards binary,
    docs binary, weights binary, keys array<string>"""
_BLOCKS = "term string, shard int, block int, top double, docs array<struct<part:int,at:int,weight:float>>, keys array<string>"
_REF = ["part", "at"]  # the task that packed a document, and its place there


def blocks(weighted: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """(term, shard, block, top, docs, keys) of (term, doc_key, weight): BLOCK postings a row, of falling weight, and
    rows without a term that list the keys of documents by their places.

    Postings lie by document, as tables bucketed by key do, and are packed there: what goes to the same terms is one
    row, with a few bytes a posting. A term with more than SHARD postings, by `counts` (term, df), is put in order by
    parts, so that none is one task's work."""
    if counts is None:
        counts = weighted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    large = counts.groupBy("term").agg(F.sum("df").alias("n")).filter(F.col("n") > SHARD)
    shards = {r["term"]: -(-r["n"] // SHARD) for r in large.collect()}  # a row per SHARD postings at most
    targets = max(1, -(-weighted.count() // GROUP))
    shared = weighted.sparkSession.sparkContext.broadcast(shards)
    documents = weighted.groupBy("doc_key").agg(F.collect_list(F.struct("term", F.col("weight").cast("float").alias("weight"))).alias("matches"))
    documents = in_small_batches(documents.sortWithinPartitions("doc_key"))  # the same places however often a task is run

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, held, n = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch.column("matches").flatten())
            if n >= PACKED:
                yield from _packs(pa.Table.from_batches(held), part, first, shared.value, targets)
                first, held, n = first + sum(b.num_rows for b in held), [], 0
        if held:
            yield from _packs(pa.Table.from_batches(held), part, first, shared.value, targets)

    return documents.mapInArrow(pack, _PACKS).groupBy("target").applyInArrow(_in_order, _BLOCKS)


def _small(values: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes as the greatest needs."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _whole(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64)


def _packs(table: pa.Table, part: int, first: int, shards: dict[str, int], targets: int) -> Iterator[pa.RecordBatch]:
    """The keys of some documents, and their postings, a row per group of terms that are put in order together."""
    names = [f.split()[0] for f in _PACKS.replace("\n", " ").split(",")]
    keys = pa.array([table["doc_key"].to_pylist()], pa.list_(pa.string()))
    empty = [pa.array([b""], pa.binary())] * 6
    yield pa.RecordBatch.from_arrays([pa.array([x], pa.int32()) for x in (part % targets, part, first, 0)] + empty + [keys], names=names)
    matches = table["matches"].combine_chunks()
    pairs = matches.flatten()
    if not len(pairs):
        return
    coded = pairs.field("term").dictionary_encode()
    code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
    weights = pairs.field("weight").to_numpy(zero_copy_only=False)
    docs = np.repeat(np.arange(len(matches)) + first, pc.list_value_length(matches).to_numpy(zero_copy_only=False))
    parts = np.array([shards.get(w, 1) for w in words], np.int64)
    most = int(parts.max())
    found, place, counts = np.unique(code * most + docs % parts[code], return_inverse=True, return_counts=True)
    word, shard = found // most, found % most
    hashed = np.array([zlib.crc32(w.encode()) for w in words], np.int64)
    target = (hashed[word] + shard * 40_503) % targets  # shards of a term go to different groups
    order = np.argsort(target, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    sorted_ = np.argsort(rank[place], kind="stable")
    docs, weights = docs[sorted_], weights[sorted_]
    target, word, shard, counts = target[order], word[order], shard[order], counts[order]
    text = [words[w].encode() for w in word]
    lengths = np.array([len(t) for t in text], np.int64)
    ends = np.cumsum(counts)
    cuts = np.append(np.flatnonzero(np.append(True, target[1:] != target[:-1])), len(target))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        of = slice(ends[a] - counts[a], ends[b - 1])
        packed = [_small(lengths[a:b]).tobytes(), b"".join(text[a:b]), _small(counts[a:b]).tobytes(), _small(shard[a:b]).tobytes()]
        packed += [_small(docs[of]).tobytes(), weights[of].astype(np.float32).tobytes()]
        numbers = [pa.array([x], pa.int32()) for x in (int(target[a]), part, first, b - a)]
        none = pa.array([None], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays(numbers + [pa.array([x], pa.binary()) for x in packed] + [none], names=names)


def _in_order(packs: pa.Table) -> pa.Table:
    """The blocks of the terms of some packs, and the lists of keys among them."""
    listed = packs.filter(pc.equal(packs["n"], 0))
    docs_type = pa.list_(pa.struct([("part", pa.int32()), ("at", pa.int32()), ("weight", pa.float32())]))
    key_rows = [pa.nulls(len(listed), pa.string()), listed["part"], listed["first"], pa.nulls(len(listed), pa.float64())]
    names = ["term", "shard", "block", "top", "docs", "keys"]
    tables = [pa.table([*key_rows, pa.nulls(len(listed), docs_type), listed["keys"]], names=names)]
    rows = packs.filter(pc.greater(packs["n"], 0)).drop_columns(["keys"]).to_pylist()
    if rows:
        lengths = np.concatenate([_whole(r["lengths"], r["n"]) for r in rows])
        counts = np.concatenate([_whole(r["counts"], r["n"]) for r in rows])
        shard = np.repeat(np.concatenate([_whole(r["shards"], r["n"]) for r in rows]), counts)
        weight = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in rows])
        sizes = [len(r["weights"]) // 4 for r in rows]
        at = np.concatenate([_whole(r["docs"], n) for r, n in zip(rows, sizes, strict=True)])
        part = np.repeat([r["part"] for r in rows], sizes)
        offsets = pa.py_buffer(np.append(0, np.cumsum(lengths)).astype(np.int64))
        text = pa.Array.from_buffers(pa.large_utf8(), len(lengths), [None, offsets, pa.py_buffer(b"".join(r["names"] for r in rows))])
        coded = text.dictionary_encode()
        words = coded.dictionary
        by_name = pc.sort_indices(words).to_numpy()
        rank = np.empty_like(by_name)
        rank[by_name] = np.arange(len(by_name))
        term = np.repeat(rank[coded.indices.to_numpy()].astype(np.int64), counts)
        order = np.lexsort((at, part, -weight, shard, term))
        term, shard, part, at, weight = (x[order] for x in (term, shard, part, at, weight))
        new = np.append(True, (term[1:] != term[:-1]) | (shard[1:] != shard[:-1]))
        place = np.arange(len(term)) - np.maximum.accumulate(np.where(new, np.arange(len(term)), 0))
        starts = np.flatnonzero(place % BLOCK == 0)
        docs = pa.StructArray.from_arrays([pa.array(part, pa.int32()), pa.array(at, pa.int32()), pa.array(weight, pa.float32())], names=[*_REF, "weight"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(term)), pa.int32()), docs)
        columns = [words.take(pa.array(by_name)).take(pa.array(term[starts])).cast(pa.string()), pa.array(shard[starts], pa.int32())]
        columns += [pa.array(place[starts] // BLOCK, pa.int32()), pa.array(weight[starts].astype(np.float64) * (1 + ROUNDING))]
        tables.append(pa.table([*columns, lists, pa.nulls(len(starts), pa.list_(pa.string()))], names=names))
    return pa.concat_tables([t.cast(tables[0].schema) for t in tables])


def _opened(rows: DataFrame) -> DataFrame:
    """The postings of blocks, with the columns beside them."""
    others = [c for c in rows.columns if c not in ("docs", "shard", "block", "top", "most", "keys")]
    return rows.select(*others, F.explode("docs").alias("_doc")).select(*others, "_doc.part", "_doc.at", "_doc.weight")


def _named(by_term: DataFrame, able: DataFrame) -> DataFrame:
    """(query_id, doc_key) of documents given by their places."""
    listed = by_term.filter("keys IS NOT NULL").select(F.col("shard").alias("part"), "block", F.posexplode("keys").alias("pos", "doc_key"))
    listed = listed.select("part", (F.col("block") + F.col("pos")).alias("at"), "doc_key")
    return listed.join(broadcast_if_small(able.select("query_id", *_REF)), _REF).select("query_id", "doc_key")


def parts(by_term: DataFrame, by_document: DataFrame, terms: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """What is scored for the distinct (query_id, term): the postings read by term, (query_id, part, at, weight, share),
    and all the postings of the documents that could still win, (query_id, doc_key, weight, share)."""
    wanted = F.broadcast(terms.select("term").distinct())
    tops = by_term.select("term", "top").join(wanted, "term").groupBy("term").agg(F.max("top").alias("most"))
    asked = written(terms.join(F.broadcast(tops), "term"), "asked")  # a row per query and term that the index has

    first = by_term.filter("block = 0 AND shard = 0").join(F.broadcast(asked), "term")
    bound = _kth(_opened(first).groupBy("query_id", *_REF).agg(F.sum("weight").alias("weight")), k)
    # Of shares that add up to the bound, the even one is the greatest of what each term and the greater ones could have.
    mine, together = Window.partitionBy("query_id").orderBy("most", "term"), Window.partitionBy("query_id")
    smaller = F.coalesce(F.sum("most").over(mine.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.count(F.lit(1)).over(together) - F.row_number().over(mine) + 1
    even = F.max("fits").over(together)
    shared = asked.join(F.broadcast(bound), "query_id", "left").withColumn("fits", (F.col("bound") - smaller) / left)
    shared = shared.withColumn("share", F.when(even.isNull(), 0.0).otherwise(F.least("most", even * PART)))
    shared = written(shared.select("query_id", "term", "share"), "shared")

    opened = by_term.join(F.broadcast(shared), "term").filter(F.col("top") > F.col("share"))
    read = _opened(opened).filter(F.col("weight") > F.col("share"))
    sums = written(_sums(by_term, shared, bound, k), "sums")
    could = F.col("most") >= F.coalesce("bound", F.lit(0.0))
    able = sums.join(F.broadcast(_kth(sums.drop("most"), k)), "query_id", "left").filter(could)
    pairs = written(_named(by_term, written(able.select("query_id", *_REF), "able")), "pairs")

    pairs, shared = broadcast_if_small(pairs).alias("pairs"), F.broadcast(shared).alias("shared")
    rows = by_document.alias("rows").join(pairs, F.col("rows.doc_key").eqNullSafe(F.col("pairs.doc_key")))
    same = F.col("pairs.query_id").eqNullSafe(F.col("shared.query_id")) & (F.col("rows.term") == F.col("shared.term"))
    return read, rows.join(shared, same).select("pairs.query_id", "rows.doc_key", "rows.weight", "shared.share")


class _Shares:
    """The query terms with their shares, by query, and the bounds known so far."""

    def __init__(self, table: pa.Table):
        coded = table["query_id"].combine_chunks().dictionary_encode(null_encoding="encode")
        rows = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(rows, kind="stable")
        self.ids = coded.dictionary
        self.cuts = np.searchsorted(rows[order], np.arange(len(self.ids) + 1))
        self.terms, self.shares = table["term_no"].to_numpy()[order], table["share"].to_numpy()[order]
        self.n_terms = int(self.terms.max()) + 1 if len(rows) else 0
        self.bounds = np.zeros(len(self.ids))
        self.bounds[rows] = table["bound"].to_numpy()


def _sums(by_term: DataFrame, shared: DataFrame, bound: DataFrame, k: int) -> DataFrame:
    """(query_id, part, at, weight, most) of the documents that could still win: what was read of them adds up to
    `weight` at least, and with the shares of the other terms they have `most` at most.

    Every posting is shuffled once, whatever the number of queries, and the sums are made for a block of documents
    and a query at a time. The k-th best of a task is a bound as well, so few of the sums become rows.
    """
    numbers = F.broadcast(numbered(shared))
    least = shared.groupBy("term").agg(F.min("share").alias("least")).join(numbers, "term")
    opened = by_term.join(F.broadcast(least), "term").filter(F.col("top") > F.col("least"))
    postings = _opened(opened.drop("term")).filter(F.col("weight") > F.col("least")).select(*_REF, "term_no", "weight")
    documents = postings.groupBy(*_REF).agg(F.collect_list(F.struct("term_no", "weight")).alias("matches"))
    asked = shared.join(numbers, "term").join(F.broadcast(bound), "query_id", "left")
    asked = asked.select("query_id", "term_no", "share", F.coalesce("bound", F.lit(0.0)).alias("bound"))
    shares = by_term.sparkSession.sparkContext.broadcast(_Shares(asked.toArrow()))
    schema = T.StructType([shared.schema["query_id"]]).add("part", T.IntegerType()).add("at", T.IntegerType())
    schema = schema.add("weight", T.DoubleType()).add("most", T.DoubleType())

    def able(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shares.value
        bounds, best = asked.bounds.copy(), [np.zeros(0)] * len(asked.ids)
        for batch in batches:
            for first, documents, terms, weights, n in _doc_blocks(batch.column("matches"), asked.n_terms):
                for q, found in enumerate(_query_sums(asked, documents, terms, weights, n)):
                    at, weight, most = found
                    weight, most = weight * (1 - ROUNDING), most * (1 + ROUNDING)
                    best[q] = np.concatenate([best[q], weight])
                    if len(best[q]) >= k:
                        best[q] = np.partition(best[q], len(best[q]) - k)[len(best[q]) - k :]
                        bounds[q] = max(bounds[q], best[q][0] - MARGIN)
                    kept = most >= bounds[q]
                    if kept.any():
                        ids = asked.ids.take(pa.array(np.full(kept.sum(), q)))
                        refs = [batch.column(c).take(pa.array(at[kept] + first)) for c in _REF]
                        yield pa.record_batch([ids, *refs, weight[kept], most[kept]], names=schema.names)

    return documents.mapInArrow(able, schema)


def _doc_blocks(matches: pa.ListArray, n_terms: int) -> Iterator[tuple]:
    """(first, documents, terms, weights, n) for blocks of documents whose matrix of weights is of bounded size."""
    lengths = pc.list_value_length(matches).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    pairs = matches.flatten()
    terms = pairs.field("term_no").to_numpy(zero_copy_only=False)
    weights = pairs.field("weight").to_numpy(zero_copy_only=False)
    step = max(16, min(1024, MATRIX_CELLS // max(n_terms, 1)))
    for first in range(0, len(matches), step):
        last = min(first + step, len(matches))
        part = slice(starts[first], starts[last])
        yield first, np.repeat(np.arange(last - first), lengths[first:last]), terms[part], weights[part], last - first


def _query_sums(asked: _Shares, documents: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int) -> Iterator[tuple]:
    """Per query (documents, weight, most) of a block. Repeated postings of a document and term have columns of their own."""
    order = np.lexsort((documents, terms))
    documents, terms, weights = documents[order], terms[order], weights[order]
    new = np.concatenate([[True], (terms[1:] != terms[:-1]) | (documents[1:] != documents[:-1])])
    place = np.arange(len(terms))
    again = place - np.maximum.accumulate(np.where(new, place, 0))
    columns, column = np.unique(again * n + documents, return_inverse=True)
    found, row = np.unique(terms, return_inverse=True)
    matrix = np.zeros((len(found), len(columns)))
    matrix[row, column] = weights
    at = np.full(asked.n_terms, -1)
    at[found] = np.arange(len(found))
    for q in range(len(asked.ids)):
        part = slice(asked.cuts[q], asked.cuts[q + 1])
        rows, share = at[asked.terms[part]], asked.shares[part]
        mine, together = matrix[rows[rows >= 0]], share.sum()
        share = share[rows >= 0]
        read = mine > share[:, None]
        weight = np.bincount(columns % n, (mine * read).sum(axis=0), n)
        seen = np.bincount(columns % n, share @ read, n)
        some = np.nonzero(np.bincount(columns % n, read.any(axis=0), n))[0]
        yield some, weight[some], (weight + together - seen)[some]


def _kth(sums: DataFrame, k: int) -> DataFrame:
    """(query_id, bound): what at least k documents have, less the margins; queries with fewer have none."""
    best = top_k(sums.withColumnRenamed("weight", "score"), k, order=[F.desc("score")], spread_by="at")
    full = best.groupBy("query_id").agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k)
    return full.select("query_id", (F.col("bound") * (1 - 2 * ROUNDING) - MARGIN).alias("bound"))


def search(by_term: DataFrame, by_document: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """The best k documents per query with their rounded and their raw score."""
    _, rows = parts(by_term, by_document, terms, k)
    scores = rows.groupBy("query_id", "doc_key").agg(F.sum("weight").alias("raw"))
    return top_k(scores.withColumn("score", rounded(F.col("raw"))), k)


def work(by_term: DataFrame, by_document: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """(matching, scored): how many postings the queries match, and how many of them a search scores."""
    read, rows = parts(by_term, by_document, terms, k)
    more = rows.filter(F.col("weight") <= F.col("share"))
    asked = F.broadcast(terms.groupBy("term").agg(F.count(F.lit(1)).alias("queries")))
    matched = by_term.select("term", F.size("docs").alias("n")).join(asked, "term").select(F.lit("matching").alias("what"), (F.col("n") * F.col("queries")).alias("n"))
    scored = read.select(F.lit("scored").alias("what"), F.lit(1).alias("n")).unionByName(more.select(F.lit("scored").alias("what"), F.lit(1).alias("n")))
    count = lambda what: F.coalesce(F.sum(F.when(F.col("what") == what, F.col("n"))), F.lit(0)).alias(what)
    return matched.unionByName(scored).agg(count("matching"), count("scored"))
