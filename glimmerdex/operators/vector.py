"""Vector search: exact by blocks, and approximate by random hyperplanes.

The exact search never forms query-document rows. A task takes its documents in
Arrow batches, multiplies each batch with the query matrix and keeps the best
`pool` per query, so only (tasks x queries x pool) rows are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glimmerdex import decisions as D
from glimmerdex.operators.filters import to_column
from glimmerdex.operators.ranking import rank_order, top_k
from glimmerdex.plans.sizing import broadcast_if_small

MAX_QUERY_ROWS = 50_000
MAX_QUERY_BYTES = 256 * 1024 * 1024
CELL_DOCS = 20_000
CELL_QUERIES = 5_000
CELLS_PER_STEP = 4_000_000
QUERIES_AT_ONCE = 500
MAX_KEPT = 5_000_000  # result rows a task may hold: queries x pool
HALF_STEP = 0.5 * 10**-D.SCORE_DIGITS


def check_vectors(documents: DataFrame, field: str = "embedding") -> None:
    """Vector and hybrid search demand an array column of numbers; checked on every call."""
    kind = documents.schema[field].dataType if field in documents.columns else None
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))):
        raise ValueError(
            f"{field!r} is not an array of numbers here, so only keyword search can be run"
        )


def with_vectors(documents: DataFrame, field: str, where=None) -> DataFrame:
    """(doc_key, vector) of the documents that have one and pass the filter."""
    predicate = to_column(where)
    rows = documents if predicate is None else documents.filter(predicate)
    return rows.filter(F.col(field).isNotNull()).select("doc_key", F.col(field).alias("vector"))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit rows in double precision; a zero or unusable vector becomes NaN and never matches."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    rows = values.reshape(len(column), -1) if len(column) else np.empty((0, 1))
    with np.errstate(invalid="ignore", divide="ignore"):
        return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


class Best:
    """The best `pool` documents per query seen so far, in the total result order.

    Queries stay in fixed blocks, and a batch of documents is merged into the rows of one
    block at a time, so the work grows with the queries and not with their square.
    """

    def __init__(self, queries: np.ndarray, pool: int):
        self.queries = queries
        self.pool = pool
        self.floor = np.full(len(queries), -np.inf)
        none = (np.empty(0, np.int64), np.empty(0), np.empty(0), np.empty(0, dtype="S1"))
        self.blocks = [none for _ in range(0, len(queries), QUERIES_AT_ONCE)]

    def add(self, vectors: np.ndarray, keys: pa.Array) -> None:
        if not len(vectors):
            return
        names = np.array([k.encode() for k in keys.to_pylist()])
        rows_at_once = max(1, CELLS_PER_STEP // QUERIES_AT_ONCE)
        for first in range(0, len(vectors), rows_at_once):
            part = slice(first, first + rows_at_once)
            for number in range(len(self.blocks)):
                self._add_to_block(number, vectors[part], names[part])

    def _add_to_block(self, number: int, vectors: np.ndarray, names: np.ndarray) -> None:
        start = number * QUERIES_AT_ONCE
        block = slice(start, start + QUERIES_AT_ONCE)
        scores = (1.0 + self.queries[block] @ vectors.T) / 2.0
        scores[np.isnan(scores)] = -np.inf
        self._keep(number, scores, names)

    def _keep(self, number: int, scores: np.ndarray, names: np.ndarray) -> None:
        """Merge what a block of queries scored with some documents; -inf is no match."""
        start = number * QUERIES_AT_ONCE
        block = slice(start, start + QUERIES_AT_ONCE)
        # A score up to one rounding step below the floor may tie with it once rounded.
        good = (scores >= (self.floor[block] - 2 * HALF_STEP)[:, None]) & np.isfinite(scores)
        if scores.shape[1] > self.pool and good.sum() > 4 * self.pool * len(scores):
            kth = np.partition(scores, -self.pool, axis=1)[:, -self.pool]
            good &= scores >= (kth - 2 * HALF_STEP)[:, None]
        row, column = np.nonzero(good)
        if len(row):
            self._merge(number, row + start, scores[row, column], names[column])

    def _merge(self, number: int, rows: np.ndarray, raw: np.ndarray, names: np.ndarray) -> None:
        seen_rows, _, seen_raw, seen_names = self.blocks[number]
        rows = np.concatenate([seen_rows, rows])
        raw = np.concatenate([seen_raw, raw])
        names = np.concatenate([seen_names, names])
        scores = np.round(raw, D.SCORE_DIGITS)
        order = np.lexsort((names, -scores, rows))
        rows, scores, raw, names = rows[order], scores[order], raw[order], names[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        kept = place < self.pool
        full = place == self.pool - 1
        self.floor[rows[full]] = scores[full]
        self.blocks[number] = (rows[kept], scores[kept], raw[kept], names[kept])

    def table(self, query_ids: pa.Array) -> pa.Table:
        rows, scores, raw, names = (
            (np.concatenate(parts) for parts in zip(*self.blocks, strict=True)) if self.blocks else (np.empty(0, t) for t in (np.int64, float, float, "S1"))
        )
        return pa.table(
            {
                "query_id": query_ids.take(pa.array(rows, pa.int64())),
                "doc_key": pa.array([k.decode() for k in names.tolist()], pa.string()),
                "score": pa.array(scores, pa.float64()),
                "raw": pa.array(raw, pa.float64()),
            }
        )


def _scored_schema(queries: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("doc_key", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("raw", T.DoubleType()),
        ]
    )


def _query_vectors(queries: DataFrame) -> DataFrame:
    return queries.filter(F.col("query_vec").isNotNull()).select(
        "query_id", F.col("query_vec").cast("array<double>").alias("vector")
    )


def _same_dimension(rows: DataFrame, dimension: int) -> DataFrame:
    """The rows as they are; a vector that cannot be compared with the queries is an error, not a missing result."""
    message = F.concat(F.lit(f"queries have {dimension} dimensions, but a document has "), F.size("vector").cast("string"))
    checked = F.when(F.size("vector") == dimension, F.col("vector")).otherwise(F.raise_error(message))
    return rows.withColumn("vector", checked) if dimension else rows.filter(F.lit(False))


def _extent(queries: DataFrame) -> tuple[int, int]:
    """Number of query vectors and their common dimension."""
    size = F.size("vector")
    row = queries.agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("low"), F.max(size).alias("high")).first()
    if row["low"] != row["high"]:
        raise ValueError(f"query vectors have {row['low']} to {row['high']} dimensions")
    return row["n"], row["high"] or 0


def _by_broadcast(documents: DataFrame, queries: DataFrame, pool: int) -> DataFrame:
    """The measured query table goes to every task; documents stay where they are."""
    spark = documents.sparkSession
    table = queries.toArrow()
    schema = _scored_schema(queries)
    shared = spark.sparkContext.broadcast((_matrix(table["vector"]), table["query_id"].combine_chunks()))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, ids = shared.value
        found = Best(matrix, pool)
        for batch in batches:
            if batch.num_rows:
                found.add(_matrix(batch.column("vector")), batch.column("doc_key"))
        yield from found.table(ids).to_batches()

    return documents.mapInArrow(best, schema)


def _by_cells(documents: DataFrame, queries: DataFrame, pool: int, n_docs: int, n_queries: int) -> DataFrame:
    """Query blocks meet document blocks of bounded size, for query tables too large to broadcast."""
    doc_blocks = max(1, -(-n_docs // CELL_DOCS))
    query_blocks = max(1, -(-n_queries // CELL_QUERIES))

    def block(col: str, n: int) -> Column:
        return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = documents.withColumn("d", block("doc_key", doc_blocks)).withColumn("q", every(query_blocks))
    right = queries.withColumn("q", block("query_id", query_blocks)).withColumn("d", every(doc_blocks))

    def best(docs: pa.Table, asked: pa.Table) -> pa.Table:
        found = Best(_matrix(asked["vector"]) if asked.num_rows else np.empty((0, 1)), pool)
        if docs.num_rows and asked.num_rows:
            found.add(_matrix(docs["vector"]), docs["doc_key"].combine_chunks())
        return found.table(asked["query_id"].combine_chunks())

    return left.groupBy("q", "d").cogroup(right.groupBy("q", "d")).applyInArrow(best, _scored_schema(queries))


def vector_pool(
    documents: DataFrame, queries: DataFrame, pool: int, field: str = "embedding", where=None, by_cells: bool | None = None
) -> DataFrame:
    """(query_id, doc_key, score, raw, rank): the `pool` nearest documents of each query vector.

    The raw score is (1 + cosine) / 2 in double precision. Ranks follow the rounded score,
    then the key, the same within a block as over all blocks.
    """
    check_vectors(documents, field)
    docs = with_vectors(documents, field, where)
    asked = _query_vectors(queries)
    n_queries, dimension = _extent(asked)
    if by_cells is None:
        too_wide = n_queries * dimension * 8 > MAX_QUERY_BYTES or n_queries * pool > MAX_KEPT
        by_cells = n_queries > MAX_QUERY_ROWS or too_wide
    docs = _same_dimension(docs, dimension)
    if by_cells:
        scored = _by_cells(docs, asked, pool, docs.count(), n_queries)
    else:
        scored = _by_broadcast(docs, asked, pool)
    return top_k(scored, pool)


def knn_search(
    documents: DataFrame, queries: DataFrame, k: int = D.DEFAULT_K, field: str = "embedding", where=None,
    pool: int | None = None, by_cells: bool | None = None,
) -> DataFrame:
    """(query_id, doc_key, score, rank): exact nearest documents; filters act before the top-k."""
    candidates = vector_pool(documents, queries, D.pool_size(k, pool), field, where, by_cells)
    return candidates.filter(F.col("rank") <= k).drop("raw")


def hyperplanes(dimension: int, tables: int, bits: int, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimension, tables * bits))


def signatures(rows: DataFrame, id_col: str, tables: int, bits: int, dimension: int, seed: int = 7) -> DataFrame:
    """(id, vector, bucket, table): one row per vector and hash table."""
    schema = T.StructType(
        [rows.schema[id_col], rows.schema["vector"], T.StructField("buckets", T.ArrayType(T.IntegerType()))]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = hyperplanes(dimension, tables, bits, seed)
        place = 1 << np.arange(bits)
        for batch in batches:
            if not batch.num_rows:
                continue
            side = (_matrix(batch.column("vector")) @ planes) > 0
            codes = (side.reshape(batch.num_rows, tables, bits) * place).sum(axis=2).astype(np.int32)
            offsets = pa.array(np.arange(0, (len(codes) + 1) * tables, tables, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("vector"), pa.ListArray.from_arrays(offsets, codes.ravel())],
                names=[id_col, "vector", "buckets"],
            )

    signed = rows.select(id_col, "vector").mapInArrow(sign, schema)
    return signed.select(id_col, "vector", F.posexplode("buckets").alias("table", "bucket"))


def knn_approx(
    documents: DataFrame, queries: DataFrame, k: int = D.DEFAULT_K, field: str = "embedding", where=None,
    tables: int = 8, bits: int = 6, seed: int = 7, stored: DataFrame | None = None,
) -> DataFrame:
    """Approximate nearest documents: those sharing a signature with the query in any hash table.

    Documents of a bucket and its queries meet in a cell, where exact scores keep
    the best k per query. A bucket larger than a cell is split by document, with
    its queries repeated, so copies filling one bucket spread over tasks. `stored`
    are signatures kept with the index; reading them partitioned by (table, bucket)
    leaves out the buckets no query falls in.
    """
    check_vectors(documents, field)
    asked = _query_vectors(queries)
    _, dimension = _extent(asked)
    if stored is None:
        docs = _same_dimension(with_vectors(documents, field, where), dimension)
        stored = signatures(docs, "doc_key", tables, bits, dimension, seed)
    elif where is not None:
        stored = stored.join(documents.filter(to_column(where)).select("doc_key"), "doc_key", "left_semi")
    asked = signatures(asked, "query_id", tables, bits, dimension, seed)

    def parts(side: DataFrame, cell: int, name: str) -> DataFrame:
        return side.groupBy("table", "bucket").agg(
            F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(cell)), F.lit(1)).cast("int").alias(name)
        )

    # At most tables x 2^bits rows.
    used = F.broadcast(asked.select("table", "bucket").distinct())
    wanted = stored.join(used, ["table", "bucket"], "left_semi")
    cells = parts(wanted, CELL_DOCS, "doc_parts").join(parts(asked, CELL_QUERIES, "query_parts"), ["table", "bucket"])
    cells = broadcast_if_small(cells)

    def part(col: str, n: str) -> Column:
        return F.pmod(F.xxhash64(col), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    keys = ["table", "bucket", "d", "q"]
    left = wanted.join(cells, ["table", "bucket"]).withColumn("d", part("doc_key", "doc_parts"))
    left = left.withColumn("q", every("query_parts")).select(*keys, "doc_key", "vector")
    right = asked.join(cells, ["table", "bucket"]).withColumn("q", part("query_id", "query_parts"))
    right = right.withColumn("d", every("doc_parts")).select(*keys, "query_id", "vector")

    def best(docs: pa.Table, wanting: pa.Table) -> pa.Table:
        found = Best(_matrix(wanting["vector"]) if wanting.num_rows else np.empty((0, 1)), k)
        if docs.num_rows and wanting.num_rows:
            found.add(_matrix(docs["vector"]), docs["doc_key"].combine_chunks())
        return found.table(wanting["query_id"].combine_chunks())

    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best, _scored_schema(queries))
    # A document met in several tables has the same score in each.
    distinct = scored.groupBy("query_id", "doc_key").agg(F.max("score").alias("score"))
    return top_k(distinct, k, order=rank_order())
