"""A quality classifier on document statistics (operator 6).

Statistics of the whole text (shares of character classes, lengths, repetition, entropy)
are standardised and mapped by random Fourier features, which approximate a Gaussian
kernel. Every partition sums its part of the normal equations of a ridge regression, the
driver adds the sums, whose size does not depend on the data, and solves them. Isotonic
regression turns scores into probabilities; it learns from labelled rows scored by a
ridge that was fitted without their fold.

At most FIT_ROWS labelled rows are used to fit, taken by a hash of their id; statistics
and scores are computed for every row. Rows whose crc32(doc_id as text) mod 4 is
HELD_OUT are never learned from; the other remainders are the folds.

Defined results: a null text counts as empty and is scored like one; labels that are null
or belong to no document are left out, several labels of one id count as their mean;
repeated rows get the same score; with no usable labels every score is 0.5. Other
columns are kept by `scored` and never read. A null id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glimmerdex.llm.registry import free_name, in_small_batches, pick, query, table, take_over
from glimmerdex.plans.sizing import keyed_join, written

FOLDS, HELD_OUT = 4, 2
FIT_ROWS = 400_000
FIT_TASKS = 8
FEATURES = 384
BANDWIDTH = 4.0
RIDGE = 1e-3
THRESHOLD = 0.7
SEED = 7
CLIP = 6.0

CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t",
    "line": b"\n\r",
    "stop": b".?",
    "shout": b"!",
    "comma": b",;:",
    "bar": b"|/\\",
    "sign": b"#$%&*@^~=+_<>",
    "bracket": b"()[]{}\"'`-",
    "wide": bytes(range(128, 256)),
    "control": bytes([*range(9), 11, 12, *range(14, 32), 127]),
}
MEMBERS = np.zeros((256, len(CLASSES)))
for _column, _members in enumerate(CLASSES.values()):
    MEMBERS[list(_members), _column] = 1.0
STATISTICS = len(CLASSES) + 14


def statistics(text: bytes | None) -> np.ndarray:
    """The statistics of one text in UTF-8."""
    text = text or b""
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    size = max(1, len(text))
    words = text.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    lines = [line for line in text.split(b"\n") if line]
    shares = counts[counts > 0] / size
    distinct = len(set(words))
    follow = len(set(zip(words, words[1:], strict=False)))
    ends = sum(line[-1:] in b".!?" for line in lines)
    first = np.bincount(np.array([w[0] for w in words] or [0], dtype=np.uint8), minlength=256) / n
    last = np.bincount(np.array([w[-1] for w in words] or [0], dtype=np.uint8), minlength=256) / n
    return np.concatenate(
        [
            np.sqrt(counts @ MEMBERS / size),
            [
                np.log1p(len(words)),
                np.log1p(len(text)),
                lengths.mean(),
                np.log1p(lengths.std()),
                np.log1p(lengths.max()),
                distinct / n,
                np.log1p(distinct),
                follow / n,
                len(set(lines)) / max(1, len(lines)),
                np.log1p(len(text) / max(1, len(lines))),
                ends / max(1, len(lines)),
                -(shares * np.log2(shares)).sum() if len(shares) else 0.0,
                1.0 - first[MEMBERS[:, 0] + MEMBERS[:, 1] + MEMBERS[:, 11] > 0].sum(),
                1.0 - last[MEMBERS[:, 0] + MEMBERS[:, 1] + MEMBERS[:, 11] > 0].sum(),
            ],
        ]
    )


def measured(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """The kept columns with an array of statistics, and the name of that column."""
    keep = docs.columns if keep is None else keep
    name = free_name(docs, "statistics")
    bytes_name = free_name(docs, "utf8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("quality")
        for batch in batches:
            rows = np.array([statistics(t.as_py()) for t in batch.column(batch.num_columns - 1)]).reshape(-1, STATISTICS)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, rows.size + 1, STATISTICS, dtype=np.int32)), pa.array(rows.ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*batch.schema.names[:-1], name])

    source = in_small_batches(docs).select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("binary").alias(bytes_name))
    fields = [source.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    return source.mapInArrow(run, schema), name


@dataclass(frozen=True)
class Model:
    """Everything a score needs; its size depends on the numbers of statistics and features only."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray
    ridge: np.ndarray
    steps: np.ndarray
    values: np.ndarray

    def fourier(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -CLIP, CLIP)
        kernel = np.sqrt(2.0 / len(self.phase)) * np.cos(z @ self.weights + self.phase)
        return np.hstack([np.ones((len(rows), 1)), kernel])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.fourier(rows) @ self.ridge

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(rows), self.steps, self.values)


def isotonic(raw: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the increasing fit of labels to scores changes, and its values, by pooling adjacent violators."""
    levels, at = np.unique(raw, return_inverse=True)
    sums, rows = np.bincount(at, label, len(levels)), np.bincount(at, minlength=len(levels))
    blocks: list[list[float]] = []  # label sum, rows, lowest and highest score
    for x, y, n in zip(levels.tolist(), sums.tolist(), rows.tolist(), strict=True):
        blocks.append([y, n, x, x])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            y1, n1, _, high = blocks.pop()
            blocks[-1][0] += y1
            blocks[-1][1] += n1
            blocks[-1][3] = high
    steps = [s for _, _, low, high in blocks for s in (low, high)]
    return np.array(steps), np.array([y / n for y, n, _, _ in blocks for _ in range(2)])


def remainder(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Learn from the statistics (doc_id, statistics) of labelled documents; labels is (doc_id, label)."""
    known = (
        labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.avg("label").alias("label"))
        .withColumn("fold", remainder())
        .filter(F.col("fold") != HELD_OUT)
    )
    share = FIT_ROWS / max(1, known.count())
    if share < 1.0:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    joined = keyed_join(stats, known, ["doc_id"], "doc_id").select("label", "fold", "statistics")
    rows = written(joined, "labelled").repartition(FIT_TASKS)

    def arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)
        return batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), x

    def summed(function) -> list[bytes]:
        """One sum per partition, of a size the data does not change."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    part = function(*arrays(batch))
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

        return [r["sum"] for r in rows.mapInArrow(run, "sum binary").collect()]

    moments = lambda y, fold, x: np.vstack([np.full(STATISTICS, float(len(x))), x.sum(0), (x * x).sum(0)])
    parts = [np.frombuffer(b).reshape(3, STATISTICS) for b in summed(moments)]
    rng = np.random.default_rng(SEED)
    weights = rng.standard_normal((STATISTICS, FEATURES)) / BANDWIDTH
    phase = rng.uniform(0.0, 2.0 * np.pi, FEATURES)
    if not parts:
        nothing = np.zeros(STATISTICS)
        return Model(nothing, nothing + 1, weights, phase, np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    n, first, second = sum(parts)
    mean = first / n
    scale = np.sqrt(np.maximum(second / n - mean**2, 1e-12)) + 1e-6
    plain = Model(mean, scale, weights, phase, np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))
    shape = (FOLDS, FEATURES + 1, FEATURES + 2)

    def equations(y: np.ndarray, fold: np.ndarray, x: np.ndarray) -> np.ndarray:
        parts = np.zeros(shape)
        for k in np.unique(fold):
            z = plain.fourier(x[fold == k])
            parts[k] = np.hstack([z.T @ z, (z.T @ y[fold == k])[:, None]])
        return parts

    def solve(gram: np.ndarray) -> np.ndarray:
        penalty = RIDGE * max(1.0, gram[0, 0]) * np.eye(FEATURES + 1) / FEATURES
        penalty[0, 0] = 1e-9
        return np.linalg.solve(gram[:, :-1] + penalty, gram[:, -1])

    grams = sum(np.frombuffer(b).reshape(shape) for b in summed(equations))
    ridge = solve(grams.sum(0))
    without = [Model(mean, scale, weights, phase, solve(grams.sum(0) - g), np.zeros(1), np.zeros(1)) for g in grams]

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, fold, x = arrays(batch)
            raw = np.zeros(len(y))
            for k in np.unique(fold):
                raw[fold == k] = without[k].raw(x[fold == k])
            yield pa.RecordBatch.from_arrays([pa.array(raw), pa.array(y)], names=["raw", "label"])

    seen = rows.mapInArrow(held, "raw double, label double").toArrow()  # at most FIT_ROWS pairs
    steps, values = isotonic(seen["raw"].to_numpy(), seen["label"].to_numpy())
    return Model(mean, scale, weights, phase, ridge, steps, values)


def scored(stats: DataFrame, model: Model, column: str = "statistics", name: str = "score") -> DataFrame:
    """The table with a score from 0 to 1 in place of the statistics."""
    columns = [c for c in stats.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(model.score(x))], names=[*columns, name])

    schema = T.StructType([*[stats.schema[c] for c in columns], T.StructField(name, T.DoubleType())])
    return stats.select(*[f"`{c}`" for c in columns], column).mapInArrow(run, schema)


def judged(docs: DataFrame, model: Model, name: str, text_col: str = "text") -> DataFrame:
    """The table with the score of every text, measured and scored in one pass of one worker."""
    bytes_name = free_name(docs, "utf8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("quality")
        for batch in batches:
            rows = np.array([statistics(t.as_py()) for t in batch.column(batch.num_columns - 1)]).reshape(-1, STATISTICS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(model.score(rows))], names=[*batch.schema.names[:-1], name])

    source = in_small_batches(docs).withColumn(bytes_name, F.col(f"`{text_col}`").cast("binary"))
    return source.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def labels_of(spark: SparkSession, sf: str) -> DataFrame:
    return pick(table(spark, sf, "labels"), doc_id="doc_id", label="quality")


@query("op6_quality")
def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    stats, _ = measured(pick(table(spark, sf, "documents"), doc_id="doc_id", text="text"), keep=["doc_id"])
    stats = written(stats, "statistics")
    rows = scored(stats, fit(stats, labels_of(spark, sf)))
    return rows.select(
        "doc_id",
        F.coalesce(remainder() == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
