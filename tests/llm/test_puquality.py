"""The quality classifier: held-out accuracy, the risk at its minimum, and odd tables."""

import zlib

import numpy as np
import pyarrow as pa

from tramline.llm import puquality
from tramline.session import table


def risk(task, frame, w):
    """The non-negative risk from its definition, with the penalty of the parameters."""
    z = task.scorer.expand(pa.array([r.f for r in frame], pa.list_(pa.float32())))
    good = np.array([r.good for r in frame])
    loss = lambda g: np.log1p(np.exp(-np.abs(g))) + np.maximum(-g, 0)
    g = z @ w
    rest = loss(-g[~good]).mean() - task.prior * loss(-g[good]).mean()
    penalty = (puquality.RIDGE * w[1:] ** 2).sum() / 2 + 1e-6 * w[0] ** 2 / 2
    return task.prior * loss(g[good]).mean() + max(0.0, rest) + penalty


def test_held_out_quality_and_least_risk(spark):
    root = "/root/testdata/sf0.01"
    docs, labels = table(spark, root, "documents"), table(spark, root, "labels")
    rows = puquality.with_features(docs.select("doc_id", "text"), labels)
    task = puquality.problem(rows)
    w = task.solve()
    frame = task.rows.collect()
    assert len(frame) == task.positives + task.unlabelled
    least = risk(task, frame, w)
    rng = np.random.default_rng(0)
    for size in (1e-3, 1e-2, 0.1, 1.0):
        for _ in range(20):
            assert risk(task, frame, w + size * rng.standard_normal(len(w)) / len(w) ** 0.5) >= least - 2 * puquality.FLAT
    got = puquality.quality_scores(docs, labels).collect()
    known = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(r.predicted == int(r.score >= 0.3) for r in got)
    own = [(known[r.doc_id], r.score, r.predicted) for r in got if r.held_out and r.doc_id in known]
    good, bad = [s for q, s, _ in own if q == 1], [s for q, s, _ in own if q == 0]
    pairs = np.mean([(a > b) + (a == b) / 2 for a in good for b in bad])
    assert pairs > 0.9 and np.mean([q == p for q, _, p in own]) > 0.9


def test_sums_of_a_pass(spark):
    rng = np.random.default_rng(2)
    rows = [(rng.random(puquality.N_FEATURES).tolist(), bool(i % 3)) for i in range(50)]
    frame = spark.createDataFrame(rows, "f array<float>, good boolean").repartition(4)
    scorer = puquality.Scorer(np.full(puquality.N_FEATURES, 0.5), np.full(puquality.N_FEATURES, 0.3), None)
    task = puquality.Problem(frame, scorer, 33, 17, 0.8)
    w, mu = rng.standard_normal(puquality.N_WEIGHTS) / 9, 0.4
    got = task.sums(w, mu)
    part = own = 0.0
    slope, gain, curve = np.zeros(len(w)), np.zeros(len(w)), np.zeros((len(w), len(w)))
    for f, good in rows:
        z = scorer.expand(pa.array([f], pa.list_(pa.float32())))[0]
        s = 1 / (1 + np.exp(-z @ w))
        part += np.log(1 + np.exp(z @ w)) * (-0.8 / 33 if good else 1 / 17)
        slope += s * z * (-0.8 / 33 if good else 1 / 17)
        own += np.log(1 + np.exp(-z @ w)) * 0.8 / 33 if good else 0
        gain += (s - 1) * z * 0.8 / 33 if good else 0
        curve += np.outer(z, z) * s * (1 - s) * (0.6 * 0.8 / 33 if good else 0.4 / 17)
    assert np.allclose(got, np.r_[part, own, slope, gain, curve[np.triu_indices(len(w))]])


SCHEMA = "doc_id long, text string, quality int, f string, held_out string"


def test_odd_tables(spark):
    rows = [(i, t, 0, "x", "y") for i, t in enumerate(["", None, "word " * 9000, "a b", "a b", "\x00", "é\n\né", "!!!"])]
    docs = spark.createDataFrame([*rows, (None, "no id", 1, "", ""), (3, "a b", 1, "", "")], SCHEMA)
    labels = "doc_id long, quality int, toxic int"
    few = spark.createDataFrame([(i, i % 2, 0) for i in range(6)] + [(1, 1, 0), (3, 0, 0), (None, 1, 0), (6, None, 1)], labels)
    got = puquality.quality_scores(docs, few).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    every = spark.createDataFrame([(i, 1, 0) for i in range(8)], labels)
    assert all(0 <= r.score <= 1 for r in puquality.quality_scores(docs.where("doc_id IS NOT NULL"), every).collect())
    none = spark.createDataFrame([], labels)
    assert {(r.score, r.predicted) for r in puquality.quality_scores(docs, none).collect()} == {(0.5, 1)}
    assert puquality.quality_scores(docs.limit(0), few).collect() == []
