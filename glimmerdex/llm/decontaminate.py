"""Benchmark decontamination by spaced seeds (operator 4).

Texts are runs of letters and digits in lower case. A seed is a fixed mask over token
positions that ignores some of them; its hash over the others still agrees where an
ignored token was substituted. Hashes of test items at every position, under every mask,
meet the hashes of the training texts; around each hit the two texts are laid over each
other and compared token by token. A document is contaminated by an item when some
WINDOW consecutive tokens of the item agree with it in all but SUBSTITUTED places.

The two masks miss nothing: however SUBSTITUTED places fall in a window, one of the masks
fits between them (a test enumerates all cases). Items shorter than a window must agree
as a whole, in four of five tokens; they use runs of tokens between the possible
substitutions. Items under LEAST tokens say too little: they match only documents that
hold exactly the same tokens. Items and documents without tokens match nothing.

Test items travel to the tasks in blocks of at most BLOCK_BYTES, measured before; more
blocks mean more passes, never items left out. Defined results: null texts are empty,
null and repeated ids stay as they are, repeated rows give repeated rows, empty tables no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmerdex.llm.registry import in_small_batches, pick, query, table, take_over
from glimmerdex.plans.sizing import measure

WINDOW = 13
SUBSTITUTED = 2
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 8, 9))
LEAST = 5
BLOCK_BYTES = 16 << 20
BYTES_AT_ONCE = 1 << 18
BASE = np.uint64(0x100000001B3)
MIX = np.uint64(0x9E3779B97F4A7C15)


def normal(text: Column) -> Column:
    """Tokens in lower case, separated by one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def allowed(tokens: int) -> int:
    """Substitutions allowed in an item that is shorter than a window."""
    return 0 if tokens < LEAST else tokens // 5


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


class Powers:
    """Powers of the hash base modulo 2^64 and their inverses, as many as asked for so far."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.power = self.inverse = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.power) < n:
            size = 1 << (n - 1).bit_length()
            back = np.uint64(pow(int(BASE), -1, 1 << 64))
            self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, BASE)]), dtype=np.uint64)
            self.inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, back)]), dtype=np.uint64)
        return self.power[:n], self.inverse[:n]


POWERS = Powers()


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash per token of all texts in order, and where each text's tokens begin (one more at the end)."""
    data = np.frombuffer("\n".join(texts).encode("utf-8") + b"\n", dtype=np.uint8)
    gap = (data == 32) | (data == 10)
    power, inverse = POWERS.upto(len(data))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)])
    starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    ends = np.flatnonzero(gap & ~np.concatenate([[True], gap[:-1]]))
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts])
    lines = np.flatnonzero(data == 10)[: len(texts)]
    return hashes, np.concatenate([[0], np.searchsorted(starts, lines)])


def seed_hashes(tokens: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The hash of the mask laid at every position where it fits."""
    n = max(0, len(tokens) - mask[-1])
    out = np.full(n, np.uint64(len(mask)))
    for offset in mask:
        out = mixed(out + tokens[offset : offset + n])
    return out


def masks_for(tokens: int) -> list[tuple[int, ...]]:
    """The seeds that find every match of an item of so many tokens."""
    if tokens >= WINDOW:
        return list(MASKS)
    return [tuple(range(max(1, tokens // (allowed(tokens) + 1))))] if tokens else []


@dataclass
class Seeds:
    """Hashed test items: per mask the sorted hashes with item and position, and a filter before the search."""

    ids: list
    tokens: list[np.ndarray]
    tables: list[tuple[tuple[int, ...], np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    bits: int = 16

    @classmethod
    def of(cls, ids: list, texts: list[str]) -> Seeds:
        hashes, bounds = token_hashes(texts)
        made = cls(ids, [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
        by_mask: dict[tuple[int, ...], list] = {}
        for item, tokens in enumerate(made.tokens):
            for mask in masks_for(len(tokens)):
                seeds = seed_hashes(tokens, mask)
                by_mask.setdefault(mask, []).append((seeds, np.full(len(seeds), item), np.arange(len(seeds))))
        most = max((sum(len(s) for s, _, _ in parts) for parts in by_mask.values()), default=1)
        made.bits = min(26, max(16, (32 * most).bit_length()))
        for mask, parts in by_mask.items():
            seeds, items, places = (np.concatenate(p) for p in zip(*parts, strict=True))
            order = np.argsort(seeds, kind="stable")
            made.tables.append((mask, seeds[order], items[order], places[order]))
        return made

    def filters(self) -> list[np.ndarray]:
        out = []
        for _, seeds, _, _ in self.tables:
            seen = np.zeros(1 << self.bits, dtype=bool)
            seen[seeds >> np.uint64(64 - self.bits)] = True
            out.append(seen)
        return out

    def hits(self, tokens: np.ndarray, filters: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in the tokens, item, position in the item) of every equal seed."""
        found = []
        for (mask, seeds, items, places), seen in zip(self.tables, filters, strict=True):
            hashes = seed_hashes(tokens, mask)
            at = np.flatnonzero(seen[hashes >> np.uint64(64 - self.bits)])
            low = np.searchsorted(seeds, hashes[at], "left")
            size = np.searchsorted(seeds, hashes[at], "right") - low
            ends = np.cumsum(size)
            pick_ = np.repeat(low - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
            found.append((np.repeat(at, size), items[pick_], places[pick_]))
        if not found:
            return (np.zeros(0, dtype=np.int64),) * 3
        return tuple(np.concatenate(p) for p in zip(*found, strict=True))  # type: ignore[return-value]

    def overlap(self, doc: np.ndarray, item: int, shift: int) -> tuple[int, int, int] | None:
        """(first and last agreeing token of the document, end exclusive, agreeing tokens) where the item, laid
        over the document from token `shift` on, agrees well enough; else None."""
        tokens = self.tokens[item]
        if len(tokens) < LEAST and len(doc) != len(tokens):
            return None
        low, high = max(0, -shift), min(len(tokens), len(doc) - shift)
        equal = tokens[low:high] == doc[low + shift : high + shift]
        window = min(WINDOW, len(tokens))
        spare = SUBSTITUTED if len(tokens) >= WINDOW else allowed(len(tokens))
        if len(equal) < window:
            return None
        agree = np.concatenate([[0], np.cumsum(equal)])
        good = np.flatnonzero(agree[window:] - agree[:-window] >= window - spare)
        if not len(good):
            return None
        inside = equal[good[0] : good[-1] + window]
        places = np.flatnonzero(inside) + good[0] + low + shift
        return int(places[0]), int(places[-1]) + 1, int(inside.sum())


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of whole texts of about BYTES_AT_ONCE."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes, dtype=np.int64) // BYTES_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(a, b - a)


def overlaps(seeds: Seeds, filters: list[np.ndarray], texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, start, end, agreeing tokens), for every item its best overlap with a text."""
    tokens, bounds = token_hashes(texts)
    at, item, place = seeds.hits(tokens, filters)
    if not len(at):
        return
    text = np.searchsorted(bounds, at, "right") - 1
    lays = np.unique(np.stack([text, item, at - bounds[text] - place], axis=1), axis=0)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for t, i, shift in lays.tolist():
        found = seeds.overlap(tokens[bounds[t] : bounds[t + 1]], i, shift)
        if found and ((t, i) not in best or (found[2], -found[0]) > (best[t, i][2], -best[t, i][0])):
            best[t, i] = found
    for (t, i), (start, end, agree) in best.items():
        yield t, i, start, end, agree


def contaminated(
    docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(doc_id, item_id, start, end, agreeing, item_tokens) of every document and item that overlap.

    start and end count the document's tokens."""
    spark = docs.sparkSession
    rows = in_small_batches(docs).select(F.col(f"`{id_col}`").alias("doc_id"), normal(F.col(f"`{text_col}`")).alias("text"))
    items = bench.select(F.col(f"`{item_id}`").alias("item_id"), normal(F.col(f"`{item_text}`")).alias("text")).filter("text <> ''")
    kinds = [r.schema[c].dataType.simpleString() for r, c in ((rows, "doc_id"), (items, "item_id"))]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start bigint, end bigint, agreeing bigint, item_tokens bigint"
    _, size = measure(items)
    blocks = 1 + size // BLOCK_BYTES
    found = spark.createDataFrame([], schema)
    for block in range(blocks):
        taken = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).toArrow()
        item_type = taken.schema.field("item_id").type
        shared = spark.sparkContext.broadcast(Seeds.of(taken["item_id"].to_pylist(), taken["text"].to_pylist()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, item_type=item_type) -> Iterator[pa.RecordBatch]:
            take_over("decontaminate", POWERS.clear)
            seeds = shared.value
            filters = seeds.filters()
            names = ["doc_id", "item_id", "start", "end", "agreeing", "item_tokens"]
            for batch in batches:
                for part in parts_of(batch):
                    out = list(overlaps(seeds, filters, part.column(1).to_pylist()))
                    if out:
                        text, item, start, end, agree = zip(*out, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [
                                part.column(0).take(pa.array(text)),
                                pa.array([seeds.ids[i] for i in item], item_type),
                                *[pa.array(c, pa.int64()) for c in (start, end, agree)],
                                pa.array([len(seeds.tokens[i]) for i in item], pa.int64()),
                            ],
                            names=names,
                        )

        found = found.union(rows.mapInArrow(run, schema)) if block else rows.mapInArrow(run, schema)
    return found


@query("op4_decontaminate")
def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(table(spark, sf, "documents"), pick(table(spark, sf, "benchmark"), item_id="item_id", text="text"))
