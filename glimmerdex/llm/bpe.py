"""Byte-pair encoding and decoding by speculation and verification (operator 9).

For every distinct word a greedy longest match proposes tokens. Vectorised checks then
test every adjacent pair: the proposal is the exact result when no pair would have
merged across its border. Only the words with a failing pair are merged step by step.
Words are proposed, checked and merged many at once; those met often are kept.

Defined results: a null text counts as empty and has no tokens; repeated rows and
equal ids stay as they are; other columns are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmerdex.llm.chunks import DOCUMENTS_AT_ONCE, PieceCache, in_groups
from glimmerdex.llm.merge_table import word_encoder
from glimmerdex.llm.registry import in_small_batches, pick, query, table, take_over

VOCABULARY = "word_bpe_49k.json"


@lru_cache(maxsize=2)
def _cache(path: str) -> PieceCache:
    return PieceCache(lambda words: (*word_encoder(path)(words), False, False))


@lru_cache(maxsize=2)
def _shown(path: str) -> pa.Array:
    return pa.array(word_encoder(path).table.token, pa.string())


def release() -> None:
    """Free the encoders and caches of this process."""
    for kept in (_cache, _shown, word_encoder):
        kept.cache_clear()


def encode_texts(texts: list[str | None], path: str) -> list[np.ndarray]:
    """Ids per text."""
    cache, words = _cache(path), word_encoder(path).words
    return [ids for group in in_groups(texts, DOCUMENTS_AT_ONCE) for ids in cache.look_up([words(t or "") for t in group])[0]]


def decode(ids: list[np.ndarray], path: str) -> pa.Array:
    """The text of each document: the vocabulary has no decoder of its own, so tokens as they are spelled are joined by spaces."""
    ends = np.cumsum([0, *map(len, ids)])
    spelled = _shown(path).take(pa.array(np.concatenate([*ids, np.zeros(0, np.uint32)])))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spelled), " ")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("bpe", release)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS_AT_ONCE):
                part = batch.slice(at, DOCUMENTS_AT_ONCE)
                ids = encode_texts(part.column(1).to_pylist(), path)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()),
                        decode(ids, path),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    rows = in_small_batches(pick(docs, doc_id=id_col, text=text_col))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids binary, decoded string")


@query("op9_bpe_codec")
def op9_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    coded = encode(table(spark, sf, "documents"), public_tokenizers.path(VOCABULARY))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
