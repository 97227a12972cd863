"""The quality classifier: its parts by other means, and its accuracy on rows it has not seen."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from glimmerdex.llm import quality as Q

SF = "/root/testdata/sf0.1"


def test_isotonic_is_the_best_increasing_fit():
    rng = np.random.default_rng(0)
    raw = np.round(rng.uniform(size=400), 2)
    label = (rng.uniform(size=400) < raw).astype(float)
    steps, values = Q.isotonic(raw, label)
    fit = np.interp(raw, steps, values)
    assert (np.diff(values) >= 0).all() and (np.diff(steps) >= 0).all()
    levels = np.unique(raw)
    mean = np.array([label[raw == x].mean() for x in levels])
    weight = np.array([(raw == x).sum() for x in levels])
    best = [max(min(np.average(mean[a : b + 1], weights=weight[a : b + 1]) for b in range(i, len(levels))) for a in range(i + 1)) for i in range(len(levels))]
    assert np.allclose([fit[raw == x][0] for x in levels], best)


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    rows = rng.standard_normal((40, Q.STATISTICS)) * 0.7
    weights = rng.standard_normal((Q.STATISTICS, 20000)) / Q.BANDWIDTH
    model = Q.Model(np.zeros(Q.STATISTICS), np.ones(Q.STATISTICS), weights, rng.uniform(0, 2 * np.pi, 20000), None, None, None)
    z = model.fourier(rows)[:, 1:]
    apart = ((rows[:, None] - rows[None]) ** 2).sum(2)
    assert np.abs(z @ z.T - np.exp(-apart / (2 * Q.BANDWIDTH**2))).max() < 0.05


def test_statistics_take_any_text():
    for text in (None, b"", b" ", b"\n\n", b"\xff\x00", b"a" * 100000, "é".encode() * 3, b"A B! C?\nA B! C?"):
        found = Q.statistics(text)
        assert found.shape == (Q.STATISTICS,) and np.isfinite(found).all()


@pytest.fixture(scope="module")
def scores(spark):
    return Q.op6_quality(spark, SF).toPandas().set_index("doc_id")


def test_held_out_accuracy(scores):
    labels = pq.read_table(f"{SF}/labels.parquet").to_pandas().set_index("doc_id")["quality"]
    held = scores[scores["held_out"]].join(labels, how="inner")
    assert len(held) > 800
    ranks, good = held["score"].rank(), held["quality"] == 1
    auc = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.98
    assert (held["predicted"] == held["quality"]).mean() > 0.98
    assert (held["predicted"][good] == 1).mean() > 0.985  # clean documents stay


def test_scores_do_not_depend_on_held_out_labels(spark, scores):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stats, _ = Q.measured(docs.select("doc_id", "text"), keep=["doc_id"])
    labels = Q.labels_of(spark, SF)
    turned = labels.withColumn("label", F.when(Q.remainder() == Q.HELD_OUT, 1 - F.col("label")).otherwise(F.col("label")))
    again = Q.scored(stats, Q.fit(stats, turned)).toPandas().set_index("doc_id")["score"]
    assert np.allclose(again.sort_index(), scores["score"].sort_index(), atol=1e-6)


def test_without_labels_every_score_is_a_half(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    stats, _ = Q.measured(docs, keep=["doc_id"])
    none = spark.createDataFrame([(1, None), (None, 1), (9, 1)], "doc_id long, label int")
    assert [r["score"] for r in Q.scored(stats, Q.fit(stats, none)).collect()] == [0.5, 0.5]
