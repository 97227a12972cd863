"""Approximate nearest neighbours by a hash-prefix forest (operator 1).

A tree gives every vector a long string of hash bits, signs of random projections, and
keeps the strings in a sorted array. A query descends in each tree to its longest prefix
match, found beside the place where it would be inserted, and then ascends in all trees
at once: one bit less of the prefix widens its range in every array, until the ranges hold
enough different candidates. Those are compared by exact cosine in double precision.

Equal vectors have equal strings and tie, so they are one entry with its smallest ids: a
vector that a third of all rows share is one row of the index. Entries are dealt over
shards of about SHARD_ROWS, each with a forest of its own, and queries over blocks of
about QUERY_BLOCK; a task holds one shard and one block. Every entry is indexed. A query
looks at SHARE of each shard, a share that recall needs where vectors are spread evenly
in all directions; it is a parameter.

Defined results: vectors that are null, empty or zero, or that hold null or non-finite
components take no part, nor do rows without an id; vectors of different lengths are
never compared; repeated rows of one id and vector count once; ties go to the smaller
vec_id; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glimmerdex.llm.registry import pick, query, table
from glimmerdex.plans.sizing import keyed_join, written

TREES = 64
BITS = 32
SHARE = 0.55
SHARD_ROWS = 1024
QUERY_BLOCK = 8192
MOST_TASKS = 4096
SEED = 11


@lru_cache(maxsize=4)
def planes(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, TREES * BITS)).astype(np.float32)


def strings(vectors: np.ndarray) -> np.ndarray:
    """A hash string per vector and tree, as an integer whose high bits come first."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    bits = (unit.astype(np.float32) @ planes(vectors.shape[1]) > 0).reshape(len(vectors), TREES, BITS)
    return np.packbits(bits, axis=2).view(">u4").astype(np.uint64)[:, :, 0]


class Forest:
    """The sorted arrays of one shard."""

    def __init__(self, vectors: np.ndarray):
        codes = strings(vectors)
        self.rows = len(vectors)
        self.order = np.argsort(codes, axis=0, kind="stable").T
        self.sorted = [codes[self.order[t], t] for t in range(TREES)]

    def depth(self, codes: np.ndarray) -> np.ndarray:
        """The length of the longest prefix that a query shares with any entry in any tree."""
        deepest = np.zeros(len(codes), dtype=np.int64)
        for t, tree in enumerate(self.sorted):
            at = np.searchsorted(tree, codes[:, t])
            for side in (np.maximum(at - 1, 0), np.minimum(at, self.rows - 1)):
                apart = tree[side] ^ codes[:, t]
                same = np.where(apart == 0, BITS, BITS - 1 - np.floor(np.log2(np.maximum(apart, 1).astype(np.float64))).astype(np.int64))
                deepest = np.maximum(deepest, same)
        return deepest

    def candidates(self, codes: np.ndarray, wanted: int) -> np.ndarray:
        """Queries by entries: which entries a query has met once it has met `wanted` or all of them."""
        met = np.zeros((len(codes), self.rows), dtype=bool)
        depth = self.depth(codes)
        open_ = np.ones(len(codes), dtype=bool)
        for level in range(int(depth.max(initial=0)), -1, -1):
            now = np.flatnonzero(open_ & (depth >= level))
            rest = np.uint64((1 << (BITS - level)) - 1)
            for t, tree in enumerate(self.sorted):
                base = codes[now, t] & ~rest
                low = np.searchsorted(tree, base, "left")
                size = np.searchsorted(tree, base | rest, "right") - low
                ends = np.cumsum(size)
                places = np.repeat(low - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
                met[np.repeat(now, size), self.order[t][places]] = True
            open_[now[met[now].sum(axis=1) >= min(wanted, self.rows)]] = False
            if not open_.any():
                break
        return met


def best(queries: np.ndarray, entries: np.ndarray, first_id: np.ndarray, k: int, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, entry, cosine) of the k best entries found per query, ties to the smaller first id."""
    met = Forest(entries).candidates(strings(queries), max(k, int(np.ceil(share * len(entries)))))
    query_length, length = (np.sqrt(np.einsum("ij,ij->i", v, v)) for v in (queries, entries))
    out = []
    for q in range(len(queries)):
        c = np.flatnonzero(met[q])
        cosine = np.einsum("ij,j->i", entries[c], queries[q]) / (length[c] * query_length[q])
        top = np.lexsort((first_id[c], -cosine))[:k]
        out.append((np.full(len(top), q), c[top], cosine[top]))
    return tuple(np.concatenate(p) for p in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding as doubles) that can be compared."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.withColumn("embedding", F.col("embedding").cast("array<double>"))
    return rows.filter(
        F.col("vec_id").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0.0)
    )


def nearest(vectors: DataFrame, is_query, k: int = 5, share: float = SHARE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that is_query(vec_id) picks, without the row itself."""
    rows = usable(pick(vectors, vec_id=id_col, embedding=vector_col)).withColumn("vhash", F.xxhash64("embedding"))
    nth = Window.partitionBy("vhash", "embedding").orderBy("vec_id")
    members = (
        rows.withColumn("place", F.dense_rank().over(nth))
        .filter(F.col("place") <= k + 1)
        .groupBy("vhash", "embedding")
        .agg(F.array_sort(F.collect_set("vec_id")).alias("members"))
    )
    entries = written(members.withColumn("first_id", F.col("members")[0]).withColumn("dim", F.size("embedding")), "entries")
    asking = rows.filter(is_query(F.col("vec_id"))).select("vec_id", "vhash").distinct()
    asking = written(asking.withColumnRenamed("vec_id", "query_id"), "asking")
    asked = written(keyed_join(entries, asking.select("vhash").distinct(), ["vhash"], "first_id", "left_semi"), "asked")
    n, q = entries.count(), asked.count()
    shards, blocks = 1 + n // SHARD_ROWS, 1 + q // QUERY_BLOCK
    tasks = min(MOST_TASKS, shards * blocks)
    dealt = lambda count: F.pmod(F.xxhash64("first_id", "vhash"), F.lit(count))
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    key = ["dim", "shard", "block"]
    left = entries.withColumn("shard", dealt(shards).cast("int")).withColumn("block", each(blocks)).repartition(tasks, *key)
    right = asked.withColumn("block", dealt(blocks).cast("int")).withColumn("shard", each(shards)).repartition(tasks, *key)
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def matrix(side: pa.Table) -> np.ndarray:
        column = side["embedding"].combine_chunks()
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def search(index: pa.Table, queries: pa.Table) -> pa.Table:
        if not index.num_rows or not queries.num_rows:
            taken = (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        else:
            order = np.argsort(index["first_id"].to_numpy(), kind="stable")  # rows arrive in no order
            index = index.take(pa.array(order))
            taken = best(matrix(queries), matrix(index), index["first_id"].to_numpy(), k + 1, share)
        asked_rows, found_rows = queries.take(pa.array(taken[0], pa.int64())), index.take(pa.array(taken[1], pa.int64()))
        return pa.table(
            {
                "vhash": asked_rows["vhash"],
                "members": found_rows["members"],
                "score": pa.array(taken[2], pa.float64()),
            }
        )

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, f"vhash bigint, members array<{id_type}>, score double")
    top = Window.partitionBy("vhash").orderBy(F.desc("score"), F.col("members")[0])
    lists = (
        found.withColumn("place", F.row_number().over(top))
        .filter(F.col("place") <= k + 1)
        .groupBy("vhash")
        .agg(F.collect_list(F.struct("score", "members")).alias("found"))
    )
    pairs = (
        keyed_join(asking, written(lists, "neighbours"), ["vhash"], "query_id")
        .select("query_id", "vhash", F.explode("found").alias("f"))
        .select("query_id", "vhash", F.col("f.score").alias("score"), F.explode("f.members").alias("vec_id"))
        .filter("vec_id <> query_id")
    )
    last = Window.partitionBy("query_id", "vhash").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


@query("op1_forest")
def op1_forest(spark: SparkSession, sf: str) -> DataFrame:
    return nearest(table(spark, sf, "embeddings"), lambda i: i % 50 == 0)
