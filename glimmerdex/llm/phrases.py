"""Phrase collocations by three-way quicksort of suffix pointers (operator 12).

Every word begins a suffix of its piece, cut to DEPTH words. A first pass over the texts
finds the leading words that hold so many suffixes that one task should not get them all.
A second one routes every suffix by its first word, and those of such hot prefixes by one
word more, so all suffixes that share a prefix of at least the routed length meet in one
task, and no task gets more than about twice GROUP. Equal suffixes are counted before they
travel; they travel in packs of numbered words. The task sorts pointers to its suffixes by
three-way partition, word by word down to DEPTH: the size of an equal partition is the
count of the phrase, and a partition below the wanted count is left. Counts of hot
prefixes, which several tasks see parts of, are summed afterwards.

The phrases, their cuts and those inside longer ones are ordinary joins.

Defined results: null and empty texts have no phrases; rows are occurrences whatever their
id, so repeated rows count again; a null language is `und`; other columns are not read; an
empty table gives an empty result. Ties go by the order of phrases in UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glimmerdex.llm.registry import in_small_batches, pick, query, table, take_over
from glimmerdex.plans.sizing import keyed_join, written

DEPTH = 4
LEAST = 30
TOP = 2000
INSIDE = (80, 100)  # a phrase goes when a longer one around it has so large a share of its count
SCALE = 2_000_000
GROUP = 1_000_000  # suffixes a task gets
HOT_PREFIXES = 500_000  # at most about so many prefixes are told to all tasks; GROUP grows for it
BYTES_A_WORD = 6  # only to estimate how many suffixes there are
POSITIONS_AT_ONCE = 2_000_000
BYTES_AT_ONCE = 1 << 20
SMALL = 4096  # partitions up to this size are sorted at once
END = b"."  # between pieces; never a word
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz" + END * 9)
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Numbers(dict):
    """Numbers words as they are first asked for; the end of a piece is 0."""

    def __init__(self) -> None:
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def pieces(texts: list[bytes]) -> list[bytes]:
    """The words of the texts in order, with END between pieces."""
    return b".".join(texts).translate(_FOLD).replace(END, b" . ").split()


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], dict[str, np.ndarray]]]:
    """About POSITIONS_AT_ONCE words of (lang, text) rows at a time: the words by number, and the numbers in order per language."""
    numbers, held, size = Numbers(), {}, 0
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = 0
        while at < len(texts):
            taken: dict[str, list[bytes]] = {}
            room = BYTES_AT_ONCE
            while at < len(texts) and room > 0:
                if texts[at]:
                    taken.setdefault(langs[at], []).append(texts[at])
                    room -= len(texts[at])
                at += 1
            for lang, some in taken.items():
                codes = numbers.of(pieces(some))
                held.setdefault(lang, []).extend((codes, np.zeros(1, np.int64)))
                size += len(codes)
            if size >= POSITIONS_AT_ONCE:
                yield list(numbers), {k: np.concatenate(v) for k, v in held.items()}
                numbers, held, size = Numbers(), {}, 0
    if held:
        yield list(numbers), {k: np.concatenate(v) for k, v in held.items()}


def suffixes(codes: np.ndarray) -> np.ndarray:
    """DEPTH columns: every word with those after it, zeros from the end of its piece on."""
    columns = np.zeros((DEPTH, len(codes)), dtype=np.int64)
    columns[0] = codes
    for d in range(1, DEPTH):
        columns[d, :-d or None] = codes[d:]
        columns[d][columns[d - 1] == 0] = 0
    return columns[:, codes != 0]


def _told(rows: list[tuple]) -> pa.RecordBatch:
    lang, words, phrase, n = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(words, pa.int32()), pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
        names=["lang", "words", "phrase", "n"],
    )


COUNTS = "lang string, words int, phrase string, n bigint"


def leading(rows: DataFrame, share: float) -> DataFrame:
    """Per language its number of words (as words = 0) and the prefixes that may hold more than `share` of all suffixes,
    with what is surely theirs.

    A run of words tells of the prefixes with that share of it. What it leaves out of one prefix is less than
    that share, so a prefix told with less than `share` of all in total holds under twice that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("phrases")
        for words, langs in runs(batches):
            least = max(1.0, share * sum(np.count_nonzero(c) for c in langs.values()))
            out: list[tuple] = []
            for lang, codes in langs.items():
                columns = suffixes(codes)
                out.append((lang, 0, b"", columns.shape[1]))
                group, names = np.zeros(columns.shape[1], dtype=np.int64), [b""]
                for d in range(DEPTH - 1):
                    columns, group = columns[:, columns[d] != 0], group[columns[d] != 0]
                    keys, group, n = np.unique(group * len(words) + columns[d], return_inverse=True, return_counts=True)
                    names = [names[k // len(words)] + b" " * (d > 0) + words[k % len(words)] for k in keys[n >= least].tolist()]
                    out += [(lang, d + 1, name, int(c)) for name, c in zip(names, n[n >= least], strict=True)]
                    columns, group = columns[:, (n >= least)[group]], (np.cumsum(n >= least) - 1)[group[(n >= least)[group]]]
            if out:
                yield _told(out)

    return rows.mapInArrow(run, COUNTS).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))


def _hash(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def _is_hot(columns: np.ndarray, depth: int, hot: list[tuple[bytes, ...]], number: dict[bytes, int]) -> np.ndarray:
    """Which suffixes begin with one of the hot prefixes of `depth` words."""
    known = [[number[w] for w in prefix] for prefix in hot if all(w in number for w in prefix)]
    if not known:
        return np.zeros(columns.shape[1], dtype=bool)
    wanted, base = np.array(known, dtype=np.int64).T, len(number)
    mine, theirs = columns[0], wanted[0]
    for d in range(1, depth):
        keys = np.unique(theirs)
        at = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
        mine = np.where(keys[at] == mine, at * base + columns[d], -1)
        theirs = np.searchsorted(keys, theirs) * base + wanted[d]
    return np.isin(mine, theirs)


PACKS = "bucket int, lang string, routed int, words binary, codes binary, counts binary"


def packed(rows: DataFrame, buckets: int, hot: dict[tuple[str, int], list[tuple[bytes, ...]]]) -> DataFrame:
    """The distinct suffixes of every run of words with their counts, a pack for each bucket and routed length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("phrases")
        for words, langs in runs(batches):
            number, hashes = {w: i for i, w in enumerate(words)}, _hash(words)
            for lang, codes in langs.items():
                columns = suffixes(codes)
                if not columns.shape[1]:
                    continue
                order = np.lexsort((columns[2] << 32 | columns[3], columns[0] << 32 | columns[1]))
                columns = columns[:, order]
                first = np.flatnonzero(np.concatenate([[True], (columns[:, 1:] != columns[:, :-1]).any(axis=0)]))
                counts = np.diff(np.append(first, columns.shape[1]))
                columns = columns[:, first]
                routed = np.ones(len(first), dtype=np.int64)
                key = hashes[columns[0]] + _hash([lang.encode()])[0]
                for d in range(1, DEPTH):
                    deeper = (routed == d) & _is_hot(columns, d, hot.get((lang, d), []), number)
                    routed[deeper] += 1
                    key[deeper] = key[deeper] * _ODD + hashes[columns[d][deeper]]
                key = (key ^ (key >> np.uint64(29))) * _ODD
                place = ((key >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64) * DEPTH + routed - 1
                order = np.argsort(place, kind="stable")
                place, columns, counts = place[order], columns[:, order], counts[order]
                starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
                out: list[tuple] = []
                for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(place)], strict=True):
                    used, codes_ = np.unique(np.append(columns[:, a:b].ravel(), 0), return_inverse=True)
                    kind = np.uint16 if len(used) < 1 << 16 else np.uint32
                    out.append(
                        (
                            int(place[a]) // DEPTH, lang, int(place[a]) % DEPTH + 1, b" ".join([words[c] for c in used[1:].tolist()]),
                            codes_[:-1].astype(kind).tobytes(), counts[a:b].astype(np.uint32).tobytes(),
                        )
                    )
                kinds = [pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                names = [c.split()[0] for c in PACKS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return rows.mapInArrow(run, PACKS)


def frequent(columns: np.ndarray, n: np.ndarray, least: int, whole: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a suffix that begins with it, its length, its count) of every phrase counted `least` times or more, by three-way quicksort.

    Prefixes shorter than `whole` words are seen in part only: they are given whatever their count.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    pending = [(np.arange(columns.shape[1]), 0)]
    while pending:
        rows, depth = pending.pop()
        if not len(rows) or (depth + 1 >= whole and n[rows].sum() < least):
            continue
        if len(rows) <= SMALL:
            found += _sorted_at_once(columns[:, rows], n[rows], rows, depth, least, whole)
            continue
        key = columns[depth][rows]
        pivot = np.sort(key[:: max(1, len(key) // 9)])[4]
        less, more = key < pivot, key > pivot
        pending += [(rows[less], depth), (rows[more], depth)]
        if pivot == 0:  # these have ended
            continue
        same = rows[~(less | more)]
        total = int(n[same].sum())
        if total >= least or depth + 1 < whole:
            found.append((same[:1], np.array([depth + 1]), np.array([total])))
            if depth + 1 < len(columns):
                pending.append((same, depth + 1))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(p) for p in zip(*found, strict=True))  # type: ignore[return-value]


def _sorted_at_once(columns, n, rows, depth, least, whole) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    order = np.lexsort(columns[depth:][::-1])
    columns, n, rows = columns[:, order], n[order], rows[order]
    new, out = np.zeros(len(rows), dtype=bool), []
    new[0] = True
    for d in range(depth, len(columns)):
        new[1:] |= columns[d, 1:] != columns[d, :-1]
        starts = np.flatnonzero(new)
        totals = np.add.reduceat(n, starts)
        kept = columns[d, starts] != 0
        if d + 1 >= whole:
            kept &= totals >= least
        out.append((rows[starts[kept]], np.full(int(kept.sum()), d + 1), totals[kept]))
    return out


def counted(packs: DataFrame, least: int) -> DataFrame:
    """(lang, words, phrase, n) from the packs of one partition at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("phrases")
        numbers, held = Numbers(), {}
        for batch in batches:
            for row in range(batch.num_rows):
                lang, routed, words, codes, counts = (batch.column(c)[row].as_py() for c in range(1, 6))
                own = np.append(0, numbers.of(words.split(b" "))).astype(np.int32)
                counts = np.frombuffer(counts, dtype=np.uint32)
                kind = np.uint16 if len(codes) == 2 * DEPTH * len(counts) else np.uint32
                held.setdefault((lang, routed), []).append((own[np.frombuffer(codes, dtype=kind).reshape(DEPTH, -1)], counts))
        words = list(numbers)
        for (lang, routed), parts in held.items():
            columns = np.concatenate([c for c, _ in parts], axis=1)
            n = np.concatenate([w for _, w in parts]).astype(np.int64)
            parts.clear()
            at, length, total = frequent(columns, n, least, routed)
            spelled = [b" ".join([words[c] for c in columns[:k, i].tolist()]) for i, k in zip(at.tolist(), length.tolist(), strict=True)]
            if spelled:
                yield _told([(lang, k, s, t) for k, s, t in zip(length.tolist(), spelled, total.tolist(), strict=True)])

    return packs.mapInArrow(run, COUNTS)


def counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """The phrases of 1 to DEPTH words that occur `least` times or more in their language, (lang, words, phrase, n),
    and the number of words of each language, (lang, n)."""
    spark = docs.sparkSession
    rows = in_small_batches(pick(docs, lang=lang_col, text=text_col)).select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    about = max(1, size // BYTES_A_WORD)
    group = max(GROUP, about // HOT_PREFIXES)
    told = written(leading(rows, group / about), "leading")
    sizes = told.filter("words = 0").select("lang", "n")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot: dict[tuple[str, int], list[tuple[bytes, ...]]] = {}
    for r in told.filter((F.col("words") > 0) & (F.col("n") >= group / about * total)).toLocalIterator():  # at most DEPTH / share rows
        hot.setdefault((r["lang"], r["words"]), []).append(tuple(r["phrase"].encode().split(b" ")))
    buckets = max(spark.sparkContext.defaultParallelism, total // group)
    packs = packed(rows, buckets, hot).repartitionById(buckets, F.col("bucket"))
    parts = counted(packs, least)
    whole = parts.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return written(whole, "phrases"), sizes


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two to DEPTH words of each language.

    The score of a phrase is that of its weakest cut into two parts: SCALE times its count over the sum of theirs."""
    known, sizes = counts(docs, lang_col, text_col, least)
    candidates = known.filter("words > 1")
    cuts = candidates.select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    parts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)")).withColumn("right", F.expr("substring_index(phrase, ' ', k - words)"))
    count_of = lambda part, name: known.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
    met = parts.join(count_of("left", "l"), ["lang", "left"]).join(count_of("right", "r"), ["lang", "right"])
    score = F.expr(f"CAST(a AS DECIMAL(20, 0)) * {SCALE} div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    weakest = met.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    longer = candidates.filter("words > 2").select("lang", "words", "n", F.split("phrase", " ").alias("w"))
    inner = longer.select(
        "lang", "n", F.explode(F.expr("""flatten(transform(sequence(2, words - 1), k ->
            transform(sequence(1, words - k + 1), i -> array_join(slice(w, i, k), ' '))))""")).alias("phrase"),
    )
    around = inner.groupBy("lang", "phrase").agg(F.max("n").alias("around"))
    share, of = INSIDE
    swallowed = F.col("around").cast("decimal(20,0)") * of >= F.col("a").cast("decimal(20,0)") * share
    kept = weakest.join(around, ["lang", "phrase"], "left").filter(~F.coalesce(swallowed, F.lit(False)))
    best = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return keyed_join(ranked, sizes, ["lang"], "phrase").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]'), lambda w: w <> '') AS ws FROM pieces
), sizes AS (
    SELECT lang, sum(len(ws))::BIGINT AS n FROM words GROUP BY lang
), spans AS (
    SELECT lang, ws, words, unnest(range(1, len(ws) - words + 2)) AS i
    FROM (SELECT lang, ws, unnest([1, 2, 3, 4]) AS words FROM words)
), known AS (
    SELECT lang, words, array_to_string(list_slice(ws, i, i + words - 1), ' ') AS phrase, count(*) AS n
    FROM spans GROUP BY ALL HAVING count(*) >= {LEAST}
), cuts AS (
    SELECT lang, phrase, n AS a, string_split(phrase, ' ') AS ws, unnest(range(1, words)) AS k FROM known WHERE words > 1
), scored AS (
    SELECT c.lang, c.phrase, c.a, l.n AS l, r.n AS r, k, ({SCALE}::HUGEINT * c.a) // (l.n::HUGEINT + r.n) AS score
    FROM cuts c
    JOIN known l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.ws, 1, k), ' ')
    JOIN known r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.ws, k + 1, len(c.ws)), ' ')
), weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_ AS (
    SELECT lang, n, ws, k, unnest(range(1, words - k + 2)) AS i
    FROM (SELECT lang, n, words, string_split(phrase, ' ') AS ws, unnest(range(2, words)) AS k FROM known WHERE words > 2)
), around AS (
    SELECT lang, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase, max(n) AS n FROM inner_ GROUP BY ALL
), kept AS (
    SELECT w.* FROM weakest w LEFT JOIN around o ON o.lang = w.lang AND o.phrase = w.phrase
    WHERE o.n IS NULL OR {INSIDE[1]}::HUGEINT * o.n < {INSIDE[0]}::HUGEINT * w.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN sizes USING (lang) QUALIFY rank <= {TOP}
"""


@query("op12_collocations", SQL)
def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"))
