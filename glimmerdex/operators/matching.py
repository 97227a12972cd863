"""Keyword scores by blocks: sums per query and document that never become rows.

A frequent word matches most queries with most documents, so their pairs are many times
the input. A task takes documents with their weighted terms in Arrow batches, adds the
weights up for a block of queries and a block of documents at a time, and keeps the best
per query: only (tasks x queries x size) rows are shuffled.

Documents without published weights are read and cut into words once. What they have of the
query terms is counted in the tasks and kept as one row of lists per document, of which
both the statistics and the weights are made, so no posting becomes a row either.

Query tables too large to broadcast are broadcast in parts, each of which reads the documents
where they lie; only small document tables are copied to cells instead. Once the best of a query
are known, most documents are left by their heavy terms: what the light ones could add is bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glimmerdex import decisions as D
from glimmerdex.operators.vector import CELL_DOCS, HALF_STEP, MAX_KEPT, QUERIES_AT_ONCE, Best
from glimmerdex.plans import sizing

DOCS_AT_ONCE = 1024
DENSE = 16  # a term in more than one of so many documents of a block is added up by a matrix product
LIGHT = 0.875  # the part of the postings of a block that is left out at first
CELL_TERMS = 1_000_000  # rows of queries and terms in a cell
COPIED = 16 << 20  # bytes in files of documents that are copied to cells
PASS_TERMS = 2_000_000  # rows of queries and terms broadcast at once
PASS_DOCS = 500_000  # documents that a task reads for them
TASKS_PER_SLOT = 4
ADDED_AT_ONCE = 2_000_000


def vocabulary(terms: DataFrame) -> pa.Array:
    """The distinct terms of a measured, small table."""
    return terms.select("term").distinct().toArrow()["term"].combine_chunks()


def numbered(terms: DataFrame, found: pa.Array | None = None) -> DataFrame:
    """(term, term_no) of the distinct terms of a measured, small table; to be broadcast."""
    found = vocabulary(terms) if found is None else found
    table = pa.table({"term": found, "term_no": pa.array(np.arange(len(found)), pa.int32())})
    return terms.sparkSession.createDataFrame(table)


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(values, pa.int32()))


def counted(tokens: DataFrame, fields: list[str], known: pa.Array) -> DataFrame:
    """(doc_key, kept, dl_<field>…, term_no, tf_<field>…): per document, in lists, which of the known terms it has and how often.

    `tokens` is (doc_key, kept, terms_<field>…). The table is written, so that texts are cut into words once."""
    counts = [f"tf_{f}" for f in fields]
    schema = T.StructType([tokens.schema["doc_key"], tokens.schema["kept"]])
    for f in fields:
        schema = schema.add(f"dl_{f}", T.IntegerType())
    for c in ("term_no", *counts):
        schema = schema.add(c, T.ArrayType(T.IntegerType()))
    shared = tokens.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value_set = shared.value
        n_terms = max(len(value_set), 1)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                rows = batch.slice(at, DOCS_AT_ONCE)
                sizes, met = [], []
                for f in fields:
                    words = rows.column(f"terms_{f}")
                    sizes.append(pc.list_value_length(words).to_numpy(zero_copy_only=False))
                    term = pc.fill_null(pc.index_in(words.flatten(), value_set=value_set), -1).to_numpy().astype(np.int64)
                    cells = np.repeat(np.arange(rows.num_rows) * n_terms, sizes[-1]) + term
                    met.append(cells[term >= 0])
                pairs = np.unique(np.concatenate(met))
                found = np.bincount(pairs // n_terms, minlength=rows.num_rows)
                tfs = [np.bincount(np.searchsorted(pairs, m), minlength=len(pairs)) for m in met]
                columns = [rows.column("doc_key"), rows.column("kept"), *[pa.array(n, pa.int32()) for n in sizes]]
                yield pa.RecordBatch.from_arrays(
                    columns + [_lists(values, found) for values in (pairs % n_terms, *tfs)], names=schema.names
                )

    return sizing.written(sizing.in_small_batches(tokens).mapInArrow(count, schema), "matches")


class Weights:
    """The weight of a posting: its best weighted field counts (BM25 with the statistics of the whole index)."""

    def __init__(self, counts: DataFrame, weights: dict[str, float], n_terms: int):
        self.fields = list(weights)
        self.weights = np.array(list(weights.values()), dtype=np.float64)
        stats = _statistics(counts, self.fields, n_terms).toArrow()  # a row per field and known term, and one per field
        field, term, n, length = (stats[c].to_numpy() for c in ("field", "term_no", "n", "length"))
        self.rarity, self.mean = np.zeros((len(weights), n_terms)), np.zeros(len(weights))
        for i in range(len(weights)):
            whole, some = (field == i) & (term < 0), (field == i) & (term >= 0)
            if not whole.any():
                continue
            n_docs = n[whole][0]
            self.mean[i] = length[whole][0] / n_docs
            self.rarity[i, term[some]] = np.log(1.0 + (n_docs - n[some] + 0.5) / (n[some] + 0.5))

    def of(self, terms: np.ndarray, tfs: list[np.ndarray], lengths: list[np.ndarray]) -> np.ndarray:
        best = np.zeros(len(terms))
        for i, (tf, dl) in enumerate(zip(tfs, lengths, strict=True)):
            has = tf > 0
            n = tf[has].astype(np.float64)
            length = (1.0 - D.BM25_B) + D.BM25_B * dl[has] / self.mean[i]
            score = self.rarity[i, terms[has]] * n * (D.BM25_K1 + 1.0) / (n + D.BM25_K1 * length)
            best[has] = np.maximum(best[has], self.weights[i] * score)
        return best


def _statistics(counts: DataFrame, fields: list[str], n_terms: int) -> DataFrame:
    """(field, term_no, n, length): in how many documents a field, by its place, has a term; with term -1 all documents and their lengths."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n_docs, lengths = np.zeros((len(fields), n_terms), np.int64), 0, np.zeros(len(fields), np.int64)
        for batch in batches:
            n_docs += batch.num_rows
            terms = batch.column("term_no").flatten().to_numpy()
            for i, f in enumerate(fields):
                lengths[i] += pc.sum(batch.column(f"dl_{f}").cast(pa.int64()), min_count=0).as_py()
                found[i] += np.bincount(terms[batch.column(f"tf_{f}").flatten().to_numpy() > 0], minlength=n_terms)
        field, term = np.nonzero(found)
        if n_docs:
            places = np.arange(len(fields))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(places, field), pa.int32()),
                    pa.array(np.append(np.full(len(fields), -1), term), pa.int32()),
                    pa.array(np.append(np.full(len(fields), n_docs), found[field, term])),
                    pa.array(np.append(lengths, np.zeros(len(term), np.int64))),
                ],
                names=["field", "term_no", "n", "length"],
            )

    parts = counts.drop("doc_key", "kept").mapInArrow(add, "field int, term_no int, n bigint, length bigint")
    return parts.groupBy("field", "term_no").agg(F.sum("n").alias("n"), F.sum("length").alias("length"))


class Asked:
    """The query terms of a table (query_id, term_no, times[, needed]), in blocks of queries."""

    def __init__(self, table: pa.Table):
        coded = table["query_id"].combine_chunks().dictionary_encode(null_encoding="encode")
        rows = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(rows, kind="stable")
        self.ids = coded.dictionary
        self.rows = rows[order]
        self.terms = table["term_no"].to_numpy()[order]
        self.times = table["times"].to_numpy()[order].astype(np.float64)
        self.needed = None
        if "needed" in table.column_names:
            self.needed = np.zeros(len(self.ids))
            self.needed[rows] = table["needed"].to_numpy()
        starts = np.arange(0, len(self.ids) + QUERIES_AT_ONCE, QUERIES_AT_ONCE)
        self.cuts = np.searchsorted(self.rows, starts)
        self.n_terms = int(self.terms.max()) + 1 if len(self.terms) else 0


@dataclass
class _Postings:
    """The postings of a block of documents, in the order of terms: a matrix of the frequent ones, and lists of the others."""

    found: np.ndarray
    starts: np.ndarray
    counts: np.ndarray
    documents: np.ndarray
    weights: np.ndarray
    dense: np.ndarray
    sums: np.ndarray
    numbers: np.ndarray | None
    n_docs: int

    @classmethod
    def of(cls, terms: np.ndarray, documents: np.ndarray, weights: np.ndarray, n_docs: int, count: bool = False) -> _Postings:
        found, starts, counts = np.unique(terms, return_index=True, return_counts=True)
        dense = counts * DENSE > n_docs
        row = np.repeat(np.where(dense, np.cumsum(dense) - 1, -1), counts)
        cells = (row * n_docs + documents)[row >= 0]
        shape, size = (int(dense.sum()), n_docs), int(dense.sum()) * n_docs
        sums = np.bincount(cells, weights[row >= 0], size).reshape(shape)
        numbers = np.bincount(cells, None, size).astype(np.float64).reshape(shape) if count else None
        return cls(found, starts, counts, documents, weights, dense, sums, numbers, n_docs)

    def split(self) -> tuple[_Postings, _Postings]:
        """The heaviest postings, and the others."""
        terms = np.repeat(self.found, self.counts)
        last = int(LIGHT * (len(terms) - 1))
        is_heavy = self.weights > np.partition(self.weights, last)[last]
        return tuple(_Postings.of(terms[m], self.documents[m], self.weights[m], self.n_docs) for m in (is_heavy, ~is_heavy))

    def scores(self, query: np.ndarray, times: np.ndarray, place: np.ndarray, n_queries: int) -> np.ndarray:
        """The sums for queries and documents, given the places of the query terms."""
        return self._summed(self.sums, self.weights, query, times, place, n_queries)

    def matched(self, query: np.ndarray, times: np.ndarray, place: np.ndarray, n_queries: int) -> np.ndarray:
        return self._summed(self.numbers, np.ones(len(self.weights)), query, times, place, n_queries)

    def _summed(self, sums, weights, query, times, place, n_queries) -> np.ndarray:
        thick = self.dense[place]
        matrix = np.zeros((n_queries, len(sums)))
        matrix[query[thick], (np.cumsum(self.dense) - 1)[place[thick]]] = times[thick]
        rare = (query[~thick], times[~thick], self.starts[place[~thick]], self.counts[place[~thick]])
        return _added(matrix @ sums, rare, self.documents, weights)

    @cached_property
    def greatest(self) -> np.ndarray:
        """Per term the most that a document has of it."""
        best = np.zeros(len(self.found))
        np.maximum.at(best, self.cells[0] // self.n_docs, self.cells[1])
        return best

    @cached_property
    def cells(self) -> tuple[np.ndarray, np.ndarray]:
        """(term's place x documents + document, sum), in order; a document may have a term in several rows."""
        cells = np.repeat(np.arange(len(self.found)), self.counts) * self.n_docs + self.documents
        cells, at = np.unique(cells, return_inverse=True)
        return cells, np.bincount(at, self.weights, len(cells))

    def weight(self, place: np.ndarray, document: np.ndarray) -> np.ndarray:
        """What documents have of the terms at these places, 0 if nothing."""
        cells, sums = self.cells
        wanted = place * self.n_docs + document
        at = np.minimum(np.searchsorted(cells, wanted), len(cells) - 1)
        return np.where(cells[at] == wanted, sums[at], 0.0)


class BestMatches(Best):
    """The best documents per query by the sum of the weights of their common terms."""

    def __init__(self, asked: Asked, pool: int):
        super().__init__(np.empty((len(asked.ids), 0)), pool)
        self.asked = asked
        self.place = np.full(asked.n_terms, -1, np.int64)  # of a term among those of a block of documents

    def add_batch(self, keys: pa.Array, lengths: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        """Documents with the number of their terms; terms and weights follow each other."""
        # Null keys come first in the order of results, as in Spark.
        names = pc.fill_null(pc.binary_join_element_wise("-", keys.cast(pa.string()), ""), "")
        names = np.array([k.encode() for k in names.to_pylist()], dtype="S")
        ends = np.cumsum(lengths)
        for first in range(0, len(names), DOCS_AT_ONCE):
            last = min(first + DOCS_AT_ONCE, len(names))
            part = slice(ends[first] - lengths[first], ends[last - 1])
            documents = np.repeat(np.arange(last - first), lengths[first:last])
            known = terms[part] < self.asked.n_terms
            self._add_documents(names[first:last], documents[known], terms[part][known], weights[part][known])

    def _add_documents(self, names: np.ndarray, documents: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        if not len(terms):
            return
        order = np.argsort(terms, kind="stable")
        postings = _Postings.of(terms[order], documents[order], weights[order], len(names), self.asked.needed is not None)
        heavy, light = postings.split() if self.asked.needed is None and np.isfinite(self.floor).any() else (None, None)
        for number in range(len(self.blocks)):
            part = slice(self.asked.cuts[number], self.asked.cuts[number + 1])
            n_queries = min(QUERIES_AT_ONCE, len(self.asked.ids) - number * QUERIES_AT_ONCE)
            query = self.asked.rows[part] - number * QUERIES_AT_ONCE
            open_ = np.ones(n_queries, bool)
            if heavy is not None:
                open_ = self._add_by_heavy(number, heavy, light, names, query, part)
            if not open_.any():
                continue
            place = self._placed(postings.found, self.asked.terms[part])
            met = (place >= 0) & open_[query]
            wanted = (query[met], self.asked.times[part][met], place[met], n_queries)
            scores = postings.scores(*wanted)
            missing = scores <= 0
            if self.asked.needed is not None:
                block = slice(number * QUERIES_AT_ONCE, number * QUERIES_AT_ONCE + n_queries)
                missing |= postings.matched(*wanted) < self.asked.needed[block][:, None] - 0.5
            scores[missing] = -np.inf
            self._keep(number, scores, names)

    def _placed(self, found: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """The place of terms among those found, -1 if they are not."""
        self.place[found] = np.arange(len(found))
        place = self.place[terms]
        self.place[found] = -1
        return place

    def _add_by_heavy(self, number: int, heavy: _Postings, light: _Postings, names: np.ndarray, query: np.ndarray, part: slice) -> np.ndarray:
        """Add the documents whose heavy terms, and the most that light ones could add, reach the best known of a query.

        Returns which queries of the block have to see all documents: their best are not known, or too low for this."""
        asked, times, start = self.asked.terms[part], self.asked.times[part], number * QUERIES_AT_ONCE
        floor = self.floor[start : start + QUERIES_AT_ONCE] - 2 * HALF_STEP
        place = self._placed(light.found, asked)
        met = place >= 0
        most = np.bincount(query[met], times[met] * light.greatest[place[met]], len(floor))
        least = floor - most - 2 * HALF_STEP
        open_ = ~(least > 0)
        closed = np.nonzero(~open_)[0]
        if not len(closed):
            return open_
        row = np.cumsum(~open_) - 1
        at = self._placed(heavy.found, asked)
        some = (at >= 0) & ~open_[query]
        scores = heavy.scores(row[query[some]], times[some], at[some], len(closed))
        pair, document = np.divmod(np.flatnonzero(scores >= least[closed][:, None]), len(names))
        if not len(pair):
            return open_
        ends = np.searchsorted(query, np.arange(len(floor) + 1))
        n = (ends[1:] - ends[:-1])[closed[pair]]
        entry = np.arange(n.sum()) + np.repeat(ends[closed[pair]] - (np.cumsum(n) - n), n)
        owner = np.repeat(np.arange(len(pair)), n)
        known = met[entry]
        entry, owner = entry[known], owner[known]
        more = np.bincount(owner, times[entry] * light.weight(place[entry], document[owner]), len(pair))
        total = scores[pair, document] + more
        good = total >= floor[closed[pair]]
        if good.any():
            self._merge(number, closed[pair[good]] + start, total[good], names[document[good]])
        return open_

    def rows(self) -> pa.Table:
        table = self.table(self.asked.ids)
        keys = table["doc_key"]
        keys = pc.if_else(pc.equal(keys, ""), pa.scalar(None, pa.string()), pc.utf8_slice_codeunits(keys, 1))
        return pa.table({"query_id": table["query_id"], "doc_key": keys, "score": table["raw"]})


def _added(scores: np.ndarray, rare: tuple, documents: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The scores of a block, with the weights of the terms that few of its documents have."""
    query, times, starts, counts = rare
    flat, ends = scores.reshape(-1), np.cumsum(counts)
    first = 0
    while first < len(query):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + ADDED_AT_ONCE, side="right")))
        n = counts[first:last]
        entry = np.arange(n.sum()) + np.repeat(starts[first:last] - (ends[first:last] - n - done), n)
        cells = np.repeat(query[first:last] * scores.shape[1], n) + documents[entry]
        np.add.at(flat, cells, np.repeat(times[first:last], n) * weights[entry])
        first = last
    return scores


Opened = Callable[[pa.ListArray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _weighted(matches: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many terms each document has, the terms and their weights."""
    pairs = matches.flatten()
    lengths = pc.list_value_length(matches).to_numpy(zero_copy_only=False)
    return lengths, pairs.field("term_no").to_numpy(zero_copy_only=False), pairs.field("weight").to_numpy(zero_copy_only=False)


def _weighed(matches: pa.ListArray, weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same from counts. Rows of one document with the same lengths are one posting per term."""
    rows = matches.flatten()
    document = np.repeat(np.arange(len(matches)), pc.list_value_length(matches).to_numpy(zero_copy_only=False))
    sizes = [rows.field(f"dl_{f}").to_numpy(zero_copy_only=False) for f in weights.fields]
    lists = rows.field("term_no")
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    terms = lists.flatten().to_numpy(zero_copy_only=False)
    tfs = [rows.field(f"tf_{f}").flatten().to_numpy(zero_copy_only=False) for f in weights.fields]
    if len(rows) > len(matches):
        row, same = np.unique(np.stack([document, *sizes]), axis=1, return_inverse=True)
        postings, place = np.unique(np.stack([np.repeat(same.reshape(-1), n), terms]), axis=1, return_inverse=True)
        tfs = [np.bincount(place.reshape(-1), tf, postings.shape[1]) for tf in tfs]
        document, sizes = row[0], list(row[1:])
        terms, n = postings[1], np.bincount(postings[0], minlength=len(document))
    found = weights.of(terms, tfs, [np.repeat(dl, n) for dl in sizes])
    return np.bincount(document, n, len(matches)).astype(np.int64), terms, found


def best_matches(weighted: DataFrame, asked: DataFrame, pool: int) -> DataFrame:
    """(query_id, doc_key, score): the best `pool` documents per query of every task, scores not rounded.

    `weighted` is (doc_key, term_no, weight), partitioned by doc_key; `asked` is (query_id, term_no, times[, needed]).
    Terms with a number of times count so often. Query tables too large to broadcast are in parts, or meet few documents in cells.
    """
    matches = weighted.groupBy("doc_key").agg(F.collect_list(F.struct("term_no", "weight")).alias("matches"))
    return _best(matches, asked, pool, lambda: _weighted)


def best_counted(counts: DataFrame, asked: DataFrame, pool: int, weights: dict[str, float], n_terms: int) -> DataFrame:
    """The same for documents whose terms were `counted`; a row per document is shuffled."""
    shared = counts.sparkSession.sparkContext.broadcast(Weights(counts, weights, n_terms))
    matching = counts.filter(F.col("kept") & (F.size("term_no") > 0))
    parts = F.collect_list(F.struct(*[c for c in counts.columns if c not in ("doc_key", "kept")]))
    return _best(matching.groupBy("doc_key").agg(parts.alias("matches")), asked, pool, lambda: partial(_weighed, weights=shared.value))


def _best(matches: DataFrame, asked: DataFrame, pool: int, opened: Callable[[], Opened]) -> DataFrame:
    schema = T.StructType([asked.schema["query_id"], T.StructField("doc_key", T.StringType()), T.StructField("score", T.DoubleType())])
    n_terms, size = sizing.measure(asked)
    n_queries = asked.select("query_id").distinct().count()
    if not sizing.within_bounds(n_terms, size) or n_queries * pool > MAX_KEPT:
        query_blocks = max(-(-n_terms // CELL_TERMS), -(-n_queries * pool // MAX_KEPT))
        kept = sizing.written(matches, "matches")
        if sizing.planned_bytes(kept) * query_blocks > COPIED:
            return _by_passes(kept, asked, pool, schema, n_terms, n_queries, opened)
        return _by_cells(kept, asked, pool, schema, query_blocks, opened)
    return _by_broadcast(matches, asked, pool, schema, opened)


def _by_broadcast(matches: DataFrame, asked: DataFrame, pool: int, schema: T.StructType, opened: Callable[[], Opened]) -> DataFrame:
    shared = matches.sparkSession.sparkContext.broadcast(Asked(asked.toArrow()))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, open_ = BestMatches(shared.value, pool), opened()
        for batch in batches:
            if batch.num_rows:
                found.add_batch(batch.column("doc_key"), *open_(batch.column("matches")))
        yield from found.rows().to_batches()

    return sizing.in_small_batches(matches).mapInArrow(best, schema)


def _by_passes(
    kept: DataFrame, asked: DataFrame, pool: int, schema: T.StructType, n_terms: int, n_queries: int, opened: Callable[[], Opened]
) -> DataFrame:
    """Parts of the queries are broadcast one after the other, and each reads the documents where they lie.

    Nothing is copied, and as few tasks as keep the slots busy read for a part, so few rows per query are shuffled."""
    parts = max(-(-n_terms // PASS_TERMS), -(-n_queries * pool // MAX_KEPT))
    slots = kept.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-TASKS_PER_SLOT * slots // parts), -(-kept.count() // PASS_DOCS))
    part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")
    dealt = sizing.written(asked.withColumn("part", part).repartition(parts, "part"), "asked")
    some = (dealt.filter(F.col("part") == i).drop("part") for i in range(parts))
    return reduce(DataFrame.unionByName, [_by_broadcast(kept.coalesce(tasks), a, pool, schema, opened) for a in some])


def _by_cells(
    kept: DataFrame, asked: DataFrame, pool: int, schema: T.StructType, query_blocks: int, opened: Callable[[], Opened]
) -> DataFrame:
    """Query blocks meet document blocks of bounded size."""
    doc_blocks = max(1, -(-kept.count() // CELL_DOCS))

    def block(col: str, n: int) -> Column:
        return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = kept.withColumn("d", block("doc_key", doc_blocks)).withColumn("q", every(query_blocks))
    right = asked.withColumn("q", block("query_id", query_blocks)).withColumn("d", every(doc_blocks))

    def best(docs: pa.Table, wanting: pa.Table) -> pa.Table:
        found = BestMatches(Asked(wanting), pool)
        if docs.num_rows and wanting.num_rows:
            for batch in docs.to_batches():
                found.add_batch(batch.column("doc_key"), *opened()(batch.column("matches")))
        return found.rows()

    return left.groupBy("q", "d").cogroup(right.groupBy("q", "d")).applyInArrow(best, schema)
