"""Document fingerprints from prefix polynomial hashes (operator 13).

A text's prefix array holds the polynomial hash of each of its beginnings, modulo two
primes. Any two spans, of one text or of several laid after each other, are compared by
two entries each, and how far two places agree is found by binary search over that.

A fingerprint keeps few entries of the prefix array: those at places that the characters
before them choose, whatever stands further off, and at the end. The hash of the WINDOW
characters before a place ranks it, and the lowest rank is kept that leaves at most PLACES
of them. Spans between kept places can be compared from fingerprints alone, so two
fingerprints tell which stretches their texts share: equal spans are looked up, each is
extended over the places that follow by binary search, and the likeness is the part of
both texts that such stretches hold. Texts moved or cut keep their places; equal texts
have equal fingerprints.

Defined results: a null text counts as empty; an empty text has a fingerprint without
places and is like another empty one (1) and like nothing else (0). Documents follow each
other by id (null first), then by a hash of the text, then by the text, so repeated rows
and ids stand side by side; after the last comes the first, and a document alone follows
itself. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmerdex.llm.registry import in_small_batches, pick, query, table, take_over
from glimmerdex.plans.sizing import written

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (911_382_323, 972_663_749)
BLOCK = 1 << 16
WINDOW = 8
PLACES = 32
LEAST_RUN = 8  # shorter stretches count only where both texts begin or end
CHARS_AT_ONCE = 1 << 19
BYTES_A_TASK = 32 << 20
MOST_TASKS = 20_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, prime: int, size: int) -> np.ndarray:
    """base to the power of 0 … size - 1, by doubling."""
    out, step = np.ones(1, dtype=np.uint64), base % prime
    while len(out) < size:
        out = np.concatenate([out, out * np.uint64(step) % np.uint64(prime)])
        step = step * step % prime
    return out[:size]


class Modulus:
    """Tables of powers of one base modulo one prime; two levels reach any length of a text."""

    def __init__(self, prime: int, base: int):
        self.p, self.prime, self.base = np.uint64(prime), prime, base
        self.low = _powers(base, prime, BLOCK + 1)
        self.high = _powers(pow(base, BLOCK, prime), prime, BLOCK)
        self.inverse = _powers(pow(base, -1, prime), prime, BLOCK)

    def power(self, n: np.ndarray) -> np.ndarray:
        return self.low[n % BLOCK] * self.high[n // BLOCK] % self.p

    def prefixes(self, codes: np.ndarray) -> np.ndarray:
        """The hash of every beginning, by sums with negative powers inside blocks."""
        out = np.zeros(len(codes) + 1, dtype=np.uint32)
        carry = np.uint64(0)
        for at in range(0, len(codes), BLOCK):
            part = codes[at : at + BLOCK].astype(np.uint64) + np.uint64(1)
            sums = np.cumsum(part * self.inverse[: len(part)] % self.p) % self.p
            hashes = (carry * self.low[1 : len(part) + 1] + sums * self.low[: len(part)]) % self.p
            out[at + 1 : at + 1 + len(part)] = hashes
            carry = hashes[-1]
        return out

    def span(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        before = prefix[start].astype(np.uint64) * self.power(end - start) % self.p
        return (prefix[end].astype(np.uint64) + self.p - before) % self.p


MODULI: list[Modulus] = []


def moduli() -> list[Modulus]:
    if not MODULI:
        MODULI.extend(Modulus(p, b) for p, b in zip(PRIMES, BASES, strict=True))
    return MODULI


class Prefixes:
    """Prefix arrays over texts laid after each other; places are code points from the first text's start."""

    def __init__(self, texts: list[str]):
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.of = [m.prefixes(codes) for m in moduli()]

    def span(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one, two = (m.span(prefix, start, end) for m, prefix in zip(moduli(), self.of, strict=True))
        return one, two

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n code points from a on are those from b on."""
        (a1, a2), (b1, b2) = self.span(a, a + n), self.span(b, b + n)
        return (a1 == b1) & (a2 == b2)

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many code points from a and b on agree, up to `most`, by binary search."""
        low, high = np.zeros(len(a), dtype=np.int64), np.array(most, dtype=np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(a, b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def ranks(self) -> np.ndarray:
        """The rank of the place after every code point: trailing zeros of the hash of the characters before it."""
        place = np.arange(1, int(self.ends[-1]) + 1) if len(self.ends) else np.zeros(0, dtype=np.int64)
        begin = np.repeat(self.starts, self.ends - self.starts)
        out = np.empty(len(place), dtype=np.uint8)
        for at in range(0, len(place), BLOCK):
            end = place[at : at + BLOCK]
            value = moduli()[0].span(self.of[0], np.maximum(begin[at : at + BLOCK], end - WINDOW), end)
            value = (value + np.uint64(1)) * _ODD >> np.uint64(32) | np.uint64(1 << 32)
            out[at : at + BLOCK] = np.bitwise_count((value & (~value + np.uint64(1))) - np.uint64(1))
        return out


class Fingerprint:
    """The length of a text, the rank that its places reach, and per place (position, rank, two hashes); the end comes last."""

    __slots__ = ("n", "rank", "places", "__dict__")

    def __init__(self, n: int, rank: int, places: list[tuple[int, int, int, int]]):
        self.n, self.rank, self.places = n, rank, places

    def text(self) -> str:
        packed = b"".join([(p << 6 | r).to_bytes(6, "little") + a.to_bytes(4, "little") + b.to_bytes(4, "little") for p, r, a, b in self.places])
        return base64.b64encode(self.n.to_bytes(6, "little") + bytes([self.rank]) + packed).decode()

    @classmethod
    def read(cls, text: str) -> Fingerprint:
        raw = base64.b64decode(text)
        number = lambda a, b: int.from_bytes(raw[a:b], "little")
        places = [(number(k, k + 6) >> 6, number(k, k + 6) & 63, number(k + 6, k + 10), number(k + 10, k + 14)) for k in range(7, len(raw), 14)]
        return cls(number(0, 6), raw[6], places)

    def kept(self, rank: int) -> tuple[list[int], list[int], list[int]]:
        """Positions and hashes from the start on, of the places of at least that rank."""
        if rank == self.rank:
            return self._all
        chosen = [p for p in self.places[:-1] if p[1] >= rank] + self.places[-1:]
        return [0, *[p[0] for p in chosen]], [0, *[p[2] for p in chosen]], [0, *[p[3] for p in chosen]]

    @cached_property
    def _all(self) -> tuple[list[int], list[int], list[int]]:
        return [0, *[p[0] for p in self.places]], [0, *[p[2] for p in self.places]], [0, *[p[3] for p in self.places]]


END_RANK = 63


def fingerprints(hashed: Prefixes) -> list[Fingerprint]:
    """One per text."""
    ranks, kept, levels = hashed.ranks(), [], []
    for a, b in zip(hashed.starts.tolist(), hashed.ends.tolist(), strict=True):
        own = ranks[a : max(a, b - 1)]  # the end is kept anyway
        above = np.bincount(own, minlength=34)[::-1].cumsum()[::-1]
        level = int(np.argmax(above <= PLACES))
        levels.append(level)
        kept.append(np.append(np.flatnonzero(own >= level) + a + 1, b) if b > a else np.zeros(0, np.int64))
    sizes = [len(k) for k in kept]
    place = np.concatenate(kept) if kept else np.zeros(0, np.int64)
    start = np.repeat(hashed.starts, sizes)
    one, two = (h.tolist() for h in hashed.span(start, place))
    rank = [END_RANK if p == e else int(ranks[p - 1]) for p, e in zip(place.tolist(), np.repeat(hashed.ends, sizes).tolist(), strict=True)]
    rows = list(zip((place - start).tolist(), rank, one, two, strict=True))
    cuts = np.cumsum([0, *sizes]).tolist()
    lengths = (hashed.ends - hashed.starts).tolist()
    return [Fingerprint(n, level, rows[a:b]) for n, level, a, b in zip(lengths, levels, cuts[:-1], cuts[1:], strict=True)]


class _Spans:
    """Spans between the kept places of a fingerprint."""

    def __init__(self, of: Fingerprint, rank: int):
        self.at, self.one, self.two = of.kept(rank)

    def span(self, i: int, j: int) -> tuple[int, int, int]:
        n = self.at[j] - self.at[i]
        first, second = moduli()
        high, low = divmod(n, BLOCK)
        p1 = int(first.low[low]) * int(first.high[high])
        p2 = int(second.low[low]) * int(second.high[high])
        return n, (self.one[j] - self.one[i] * p1) % first.prime, (self.two[j] - self.two[i] * p2) % second.prime


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """The part of both texts in stretches that they share, from 0 to 1, as their fingerprints show it."""
    if a.n == b.n and a.places[-1:] == b.places[-1:]:
        return 1.0
    rank = max(a.rank, b.rank)
    mine, theirs = _Spans(a, rank), _Spans(b, rank)
    last, end = len(mine.at) - 1, len(theirs.at) - 1
    free = [True] * end
    where: dict[tuple[int, int, int], list[int]] = {}
    for j in range(end):
        where.setdefault(theirs.span(j, j + 1), []).append(j)
    shared = i = 0
    while i < last:
        best, found = 0, -1
        for j in where.get(mine.span(i, i + 1), ()):
            if not free[j]:
                continue
            most = 1
            while most < min(last - i, end - j) and free[j + most]:
                most += 1
            low, high = 1, most
            while low < high:
                middle = (low + high + 1) // 2
                low, high = (middle, high) if mine.span(i, i + middle) == theirs.span(j, j + middle) else (low, middle - 1)
            if low > best:
                best, found = low, j
        length = mine.at[i + best] - mine.at[i]
        if best and (length >= LEAST_RUN or i == found == 0 or (i + best == last and found + best == end)):
            shared += length
            free[found : found + best] = [False] * best
        i += max(1, best)
    return 2.0 * shared / (a.n + b.n)


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, ahead, doc_id, h, text): documents dealt by ranges of their order, sorted in each partition, and after them
    (ahead = 1) the document that follows the last one.

    The ranges are drawn over ids and hashes alone, so that texts are dealt once."""
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("h", F.xxhash64("text"))
    keys = written(rows.select("doc_id", "h", F.octet_length("text").alias("bytes")), "keys")
    size = keys.agg(F.sum("bytes")).first()[0] or 0
    tasks = min(MOST_TASKS, max(spark.sparkContext.defaultParallelism, size // BYTES_A_TASK))
    ranged = keys.repartitionByRange(tasks, "doc_id", "h").groupBy(F.spark_partition_id().alias("part"))
    firsts = [r["first"] for r in ranged.agg(F.min(F.struct("doc_id", "h")).alias("first")).orderBy("first").collect()]  # one per task
    kind, n = rows.schema["doc_id"].dataType, max(1, len(firsts))
    bounds = F.array(*[F.struct(F.lit(f["doc_id"]).cast(kind).alias("doc_id"), F.lit(f["h"]).cast("long").alias("h")) for f in firsts])
    steps = F.lit([1 << k for k in reversed(range(n.bit_length()))])
    key = F.struct("doc_id", "h")
    if firsts:
        reached = lambda at, step: (at + step < n) & (F.get(bounds, at + step) <= key)
        bucket = F.aggregate(steps, F.lit(0), lambda at, step: F.when(reached(at, step), at + step).otherwise(at))
    else:
        bucket, bounds = F.lit(0), F.array(key)
    placed = rows.withColumn("bucket", bucket)
    heads = placed.filter(F.get(bounds, F.col("bucket")) == key) if firsts else placed
    heads = heads.groupBy("bucket", "doc_id", "h").agg(F.min("text").alias("text"))
    columns = ["bucket", "ahead", "doc_id", "h", "text"]
    before = heads.withColumn("bucket", F.pmod(F.col("bucket") - 1, F.lit(n))).withColumn("ahead", F.lit(1))
    every = placed.withColumn("ahead", F.lit(0)).select(columns).unionByName(before.select(columns))
    return every.repartitionById(n, F.col("bucket")).sortWithinPartitions("ahead", "doc_id", "h", "text")


RESULT = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
    "first_change bigint"
)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the following text's beginning."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def compared(texts: list[str]) -> list[tuple]:
    """The columns of RESULT for every text but the last, which only follows."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    hashed = Prefixes(texts + changed)
    prints = fingerprints(hashed)
    n = len(changed)
    starts, sizes = hashed.starts, hashed.ends - hashed.starts
    first = hashed.extension(starts[:n], starts[n + 1 :], np.minimum(sizes[:n], sizes[n + 1 :])).tolist()
    return [
        (
            len(texts[i]), hashlib.sha256(changed[i].encode("utf-8")).hexdigest(), prints[i].text(), prints[n + 1 + i].text(),
            likeness(prints[i], prints[n + 1 + i]), likeness(prints[i], prints[i + 1]), first[i],
        )
        for i in range(n)
    ]


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its edited text, their likeness, that to the next document, and the first place
    where the edited text differs (the length of the shorter one, if nowhere)."""
    rows = neighbours(in_small_batches(docs), id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *[c.split()[0] for c in RESULT.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("prefix_hash", MODULI.clear)
        ids, texts, size = [], [], 0  # the last one waits for what follows it

        def flush() -> pa.RecordBatch:
            columns = list(zip(*compared(texts), strict=True))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids[:-1], id_type), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=names
            )

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if size >= CHARS_AT_ONCE and len(texts) > 1:
                    yield flush()
                    ids, texts, size = ids[-1:], texts[-1:], len(text)
        if len(texts) > 1:
            yield flush()

    return rows.mapInArrow(run, f"doc_id {kind}, {RESULT}")


@query("op13_fingerprints")
def op13_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return document_fingerprints(table(spark, sf, "documents"))
