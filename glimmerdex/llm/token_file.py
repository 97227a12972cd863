"""Token ids in ORC: run-length encoded integers, row indexes and Bloom filters (operator 2).

`write_tokens` deals documents by ranges of doc_id, encodes each range in order and writes
one ORC file per range: integer columns are run-length encoded, every stripe has row
indexes, and doc_id has a Bloom filter, so readers work on stripes in parallel and skip
those without a wanted id. Each row knows its range and the ids before it in that range;
`read_tokens` adds the ids of the ranges before, which is one number per file.

Defined results: a null text counts as empty and holds the end id alone. Rows of one
doc_id follow each other by a hash of the text, then by the text; null ids come first.
Other columns are not read, and an empty table gives an empty file set.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glimmerdex.llm.chunks import PieceCache
from glimmerdex.llm.registry import in_small_batches, pick, query, table, take_over
from glimmerdex.plans.sizing import broadcast_if_small, scratch_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
ORC = {
    "compression": "zstd",
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
TEXTS_AT_ONCE = 1024
PIECES_AT_ONCE = 64
PLAIN = "\0"  # begins a piece that no space stands before


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _encode(path: str, texts: list[str]) -> list[list[int]]:
    return [e.ids for e in _tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def _marks(path: str) -> tuple[str, ...]:
    return tuple(t.content for t in _tokenizer(path).get_added_tokens_decoder().values())


@lru_cache(maxsize=2)
def _bytes_of(path: str) -> np.ndarray:
    """How many bytes of text each token stands for: every character of a token is a byte, those of a mark are its own."""
    tokenizer = _tokenizer(path)
    size = np.zeros(tokenizer.get_vocab_size(), dtype=np.int64)
    for token, i in tokenizer.get_vocab().items():
        size[i] = len(token)
    for i, mark in tokenizer.get_added_tokens_decoder().items():
        size[i] = len(mark.content.encode("utf-8"))
    return size


def _open_ends(path: str, pieces: list[str]) -> tuple[list[bool], list[bool]]:
    """A piece begins at a lone space; a space between white space, or between it and a mark, belongs to a longer run."""
    marks = _marks(path)
    begins = [not p or (p[0] != PLAIN and (p[0].isspace() or p.startswith(marks))) for p in pieces]
    return begins, [not p or p[-1].isspace() for p in pieces]


def _encode_pieces(path: str, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool], list[bool]]:
    """How many ids each piece has, the ids, and which begins and ends are open. Pieces that nothing beside them changes go to the library many in one text,
    and the bytes their tokens stand for tell where each one ends."""
    begins, ends = _open_ends(path, pieces)
    plain = [p[:1] == PLAIN for p in pieces]
    alone = [k for k, (a, b, c) in enumerate(zip(begins, ends, plain, strict=True)) if a or b or c]
    together = [k for k, (a, b, c) in enumerate(zip(begins, ends, plain, strict=True)) if not (a or b or c)]
    sizes = np.zeros(len(pieces), dtype=np.int64)
    found = _encode(path, [pieces[k][1:] if plain[k] else " " + pieces[k] for k in alone])
    sizes[alone] = [len(i) for i in found]
    texts, cuts = [], [0]
    for at in range(0, len(together), PIECES_AT_ONCE):
        some = [pieces[k] for k in together[at : at + PIECES_AT_ONCE]]
        texts.append(" " + " ".join(some))
        cuts += [len(p) + 1 if p.isascii() else len(p.encode("utf-8")) + 1 for p in some]
    joined = np.fromiter(chain.from_iterable(_encode(path, texts)), dtype=np.uint32)
    at = np.searchsorted(np.cumsum(_bytes_of(path)[joined]), np.cumsum(cuts), "right")
    sizes[together] = np.diff(at)
    place = np.cumsum(sizes) - sizes
    flat = np.empty(int(sizes.sum()), dtype=np.uint32)
    mine = np.repeat(place[together] - at[:-1], sizes[together]) + np.arange(len(joined))
    flat[mine] = joined
    for k, ids in zip(alone, found, strict=True):
        flat[place[k] : place[k] + len(ids)] = ids
    return sizes, flat, begins, ends


@lru_cache(maxsize=2)
def _cache(path: str) -> PieceCache:
    return PieceCache(lambda pieces: _encode_pieces(path, pieces), times=3)


def encode_texts(texts: list[str | None] | pa.Array, path: str) -> list[np.ndarray]:
    """Ids per text, as the library encodes the whole text.

    Texts are cut at spaces; those where a cut would change tokens are encoded whole."""
    cache, out = _cache(path), []
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    for at in range(0, len(texts), TEXTS_AT_ONCE):
        group = pc.fill_null(texts.slice(at, TEXTS_AT_ONCE), "")
        odd = pc.match_substring(group, PLAIN).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.binary_join_element_wise(PLAIN, pc.if_else(pa.array(odd), "", group), ""), " ")
        pieces = cut.flatten().dictionary_encode()
        counts = np.append(0, np.cumsum(pc.list_value_length(cut).to_numpy()))
        ids, unsafe = cache.look_up_encoded(pieces.dictionary.to_pylist(), pieces.indices.to_numpy(), counts)
        whole = sorted({*unsafe, *np.flatnonzero(odd).tolist()})
        for i, found in zip(whole, _encode(path, [group[i].as_py() for i in whole]), strict=True):
            ids[i] = np.array(found, dtype=np.uint32)
        out += ids
    return out


def release() -> None:
    """Free the tokenizer and the cache of this process."""
    for kept in (_cache, _bytes_of, _marks, _tokenizer):
        kept.cache_clear()


def write_tokens(
    docs: DataFrame, folder: str, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write doc_id, part, part_start, n_tokens and ids in ascending doc_id order to ORC files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("token_file", release)
        part, written = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                rows = batch.slice(at, TEXTS_AT_ONCE)
                ids = [np.append(i, np.uint32(end_id)) for i in encode_texts(rows.column(1), path)]
                ends = np.cumsum([len(i) for i in ids], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(np.full(len(ids), part, dtype=np.int32)),
                        pa.array(written + np.concatenate([[0], ends[:-1]])),
                        pa.array(np.diff(ends, prepend=0)),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(np.concatenate(ids).astype(np.int32))
                        ),
                    ],
                    names=["doc_id", "part", "part_start", "n_tokens", "ids"],
                )
                written += int(ends[-1])

    rows = in_small_batches(pick(docs, doc_id=id_col, text=text_col))
    kind = rows.schema["doc_id"].dataType.simpleString()
    order = ["doc_id", F.xxhash64("text"), "text"]
    coded = (
        rows.repartitionByRange(*order[:2])
        .sortWithinPartitions(*order)
        .mapInArrow(run, f"doc_id {kind}, part int, part_start bigint, n_tokens bigint, ids array<int>")
    )
    coded.write.options(**ORC).orc(folder)


def read_tokens(spark: SparkSession, folder: str, id_type: T.DataType | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids from the files."""
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type or T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("part_start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )
    rows = spark.read.schema(schema).orc(folder)
    parts = rows.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = parts.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    return rows.join(broadcast_if_small(starts), "part").select(
        "doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids"
    )


def checksums(tokens: DataFrame) -> DataFrame:
    """Replaces ids by ids_crc32, the unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            bounds = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


@query("op2_token_file")
def op2_token_file(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf, "documents")
    folder = scratch_path(spark, "op2-tokens")
    write_tokens(docs, folder, public_tokenizers.path(VOCABULARY))
    return checksums(read_tokens(spark, folder, docs.schema["doc_id"].dataType))
