"""Features, the fitted order, and held-out rows."""

from __future__ import annotations

import math

import numpy as np

from coursetide.llm import quality

from ..conftest import TESTDATA
from .data import awkward, documents, prose


def test_features_are_bounded():
    for _, text in awkward():
        row = quality.features(text or "")
        assert row.shape == (len(quality.FEATURES),) and np.isfinite(row).all()
        assert (row >= 0).all() and (row <= 1.5).all()
    assert not quality.features("").any() and not quality.features(" \n").any()


def test_pairs_order_scores():
    draw = np.random.default_rng(2)
    labels = draw.integers(0, 2, 400)
    rows = draw.normal(0, 1, (400, len(quality.FEATURES))) + labels[:, None] * np.linspace(0, 2, len(quality.FEATURES))
    scores = quality.fit(rows, labels, pairs=4000).scores(rows)
    assert ((scores > 0) & (scores < 1)).all()
    assert ((scores >= 0.5) == labels).mean() > 0.95
    assert (quality.fit(rows, labels).scores(rows) == quality.fit(rows, labels).scores(rows)).all()


def test_without_both_labels_everything_is_kept(spark):
    docs = documents(spark, awkward(), clash=True)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (99, 0)], "doc_id long, quality int")
    for known in (labels, labels.limit(0)):
        out = quality.score(docs, quality.learn(docs, known))
        assert out.columns == [c for c in docs.columns]
        assert [r.score for r in out.collect()] == [1.0] * len(awkward())
    assert quality.score(documents(spark, []), quality.learn(docs, labels)).count() == 0


def test_learns_from_labels(spark):
    rows = [(k, prose(k, 80) if k % 2 else prose(k, 80).upper() + "!!! $$$ " * 20) for k in range(200)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(120)] + [(3, 1), (3, 1)], "doc_id long, quality int")
    docs = documents(spark, rows)
    got = quality.score(docs, quality.learn(docs, labels)).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in got)
    odd = quality.score(documents(spark, awkward()), quality.learn(docs, labels)).collect()
    assert all(0 <= r.score <= 1 for r in odd) and len(odd) == len(awkward())


def test_held_out_rows(spark):
    from coursetide.llm.queries import op7_bradley_terry

    folder = str(TESTDATA / "sf0.1")
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in op7_bradley_terry(spark, folder).collect() if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in rows) >= 0.98 * len(rows) > 0


def test_learned_weights_make_the_pairwise_loss_small():
    """Bradley-Terry's loss and its gradient pair by pair, in plain Python: the learned weights are near a minimum."""
    draw = np.random.default_rng(2)
    labels = np.arange(60) % 2
    x = draw.normal(size=(60, len(quality.FEATURES)))
    x[:, 0] += labels * 1.5
    x[:, 3] -= labels * 0.7
    ranking = quality.fit(x, labels)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = [[min(8, max(-8, v)) for v in (row - mean) / scale] for row in x]
    z = [[*row, *(v * v / 8 for v in row)] for row in z]
    pairs = [(a, b) for a in range(60) for b in range(60) if labels[a] > labels[b]]

    def loss_and_slope(weights):
        loss, slope = 0.0, [1e-3 * w for w in weights]
        for a, b in pairs:
            apart = [p - q for p, q in zip(z[a], z[b], strict=True)]
            ahead = sum(w * v for w, v in zip(weights, apart, strict=True))
            loss += math.log1p(math.exp(-ahead)) / len(pairs)
            lost = 1 / (1 + math.exp(ahead))
            slope = [s - lost * v / len(pairs) for s, v in zip(slope, apart, strict=True)]
        return loss, math.hypot(*slope)

    learned, slope = loss_and_slope(ranking.weights.tolist())
    start, steep = loss_and_slope([0.0] * len(z[0]))
    assert learned < start / 2 and slope < steep / 10
    ranks = [sum(w * v for w, v in zip(ranking.weights, row, strict=True)) for row in z]
    scores = ranking.scores(x)
    assert sorted(range(60), key=lambda k: ranks[k]) == sorted(range(60), key=lambda k: scores[k])
    wrong = int(((scores >= 0.5) != labels).sum())  # the threshold parts the draw as well as any does
    assert wrong == min(sum((r >= cut) != y for r, y in zip(ranks, labels, strict=True)) for cut in [*ranks, max(ranks) + 1])


def test_a_repeated_id_gives_one_row_and_clashing_columns_are_replaced(spark):
    rows = [(k % 10, prose(k, 30) if k % 2 else "x " * k) for k in range(200)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(10)], "doc_id long, quality int")
    seen = []
    fit = quality.fit
    quality.fit = lambda x, y: seen.append((len(x), y.tolist())) or fit(x, y)
    try:
        ranking = quality.learn(documents(spark, rows, clash=True), labels)
    finally:
        quality.fit = fit
    assert seen == [(10, [0, 1] * 5)]
    out = quality.score(documents(spark, rows, clash=True), ranking)
    assert out.columns.count("score") == 1 and out.count() == 200
    assert all(0 <= r.score <= 1 for r in out.select("score").collect())
