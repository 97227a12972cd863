"""Near duplicates by fingerprints and meet-in-the-middle ball hashing (operator 3).

A fingerprint has bit i set when bit i is set in over half of the XXH64 hashes of a text's
word shingles. Two fingerprints within radius 2 have a common variant within half of it,
so every distinct fingerprint emits itself and its 64 single-bit flips, and the shuffle on
variants brings all linked fingerprints together. Who met at a variant is kept as a bit
mask of the flips, an aggregate of fixed width that combines before the shuffle; at most
65 distinct fingerprints can meet at one. All that meet are within the radius of each
other, so linking each to the smallest loses no connection and lists no group's pairs.
The links are verified all the same.

Defined results: a null or blank text has fingerprint zero and is linked like any other;
copies share a fingerprint and are handled as one; repeated rows give repeated results.
Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmerdex.llm.components import components
from glimmerdex.llm.registry import in_small_batches, pick, query, table, take_over
from glimmerdex.plans.sizing import keyed_join, written

WORDS = 3
SEED = 42
RADIUS = 2
ROWS_PER_TASK = 1_000_000
TEXTS_AT_ONCE = 512


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """The signed 64-bit fingerprint of one text."""
    import xxhash

    found = (text or b"").lower().split()  # lower() of bytes changes A-Z only, split() cuts at the same six characters
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)], dtype="<u8"
    )
    set_bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("simhash")
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                rows = batch.slice(at, TEXTS_AT_ONCE)
                values = [fingerprint(t) for t in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(values, pa.int64())], names=["doc_id", "fp"])

    rows = in_small_batches(pick(docs, doc_id=id_col, text=text_col)).withColumn("text", F.col("text").cast("binary"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp bigint")


def links(distinct: DataFrame, rows: int) -> DataFrame:
    """(a, b) with a < b: links of distinct fingerprints that connect all within the radius."""
    tasks = max(distinct.sparkSession.sparkContext.defaultParallelism, 65 * rows // ROWS_PER_TASK)
    variants = distinct.repartition(tasks, "fp").select(
        "fp", F.explode(F.expr("concat(array(0L), transform(sequence(0, 63), i -> shiftleft(1L, i)))")).alias("flip")
    )
    met = (
        variants.groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
        .agg(F.bit_or("flip").alias("flips"), F.max((F.col("flip") == 0).cast("int")).alias("itself"))
        .filter((F.bit_count("flips") + F.col("itself")) > 1)
    )
    members = F.expr(
        """concat(if(itself = 1, array(variant), array()),
           transform(filter(sequence(0, 63), i -> (shiftright(flips, i) & 1L) = 1L), i -> variant ^ shiftleft(1L, i)))"""
    )
    return (
        met.select(members.alias("members"))
        .select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
        .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS))
        .distinct()
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id reachable over links, per row."""
    marked = written(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(links(distinct.select("fp"), distinct.count()))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = keyed_join(rooted, least, ["root"], "fp").select("fp", "component_id")
    return keyed_join(marked, written(named, "components"), ["fp"], "doc_id").select("doc_id", "fp", "component_id")


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
