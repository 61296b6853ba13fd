"""A quality classifier learned from trusted positives and unlabelled web text.

With ``p`` the share of good documents, the risk of a score ``g`` under the logistic loss is
``p E_P[l(g)] + max(0, E_U[l(-g)] - p E_P[l(-g)])``: positives ``P`` count as good, unlabelled
texts ``U`` as bad less the good ones among them, and that difference is kept from falling
below zero. This is the largest value over ``mu`` in [0, 1] of
``p E_P[l(g)] + mu (E_U[l(-g)] - p E_P[l(-g)])``, which is convex in a linear ``g``; so the
minimum is a saddle point that Newton steps reach in some ten passes. A pass adds up
gradients and curvatures over all learning documents' features, which are written once.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm import tokens
from tramline.session import cut_lineage

#: A document is predicted to be good from this score on.
CUT = 0.3
#: Weight of the squared parameters, passes at most, and the slope at which they end.
RIDGE, PASSES, FLAT = 0.01, 30, 1e-5
#: Largest step of the parameters, and the range of standardised features.
LONGEST_STEP, RANGE = 4.0, 6.0

MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
N_FEATURES = 7 + len(MARKS) + 8
N_WEIGHTS = 1 + 2 * N_FEATURES


def features(text: str) -> list[float]:
    """Of a whole text: size, shares of kinds of bytes and of each mark, repetition of words and lines."""
    raw = text.encode()
    n = max(1, len(raw))
    share = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / n
    kinds = [share[65:91].sum(), share[97:123].sum(), share[48:58].sum(), share[32], share[10], share[128:].sum()]
    words, lines = text.split(), [line for line in text.split("\n") if line]
    counts = Counter(words)
    m, k = max(1, len(words)), max(1, len(lines))
    again = sum(map(str.__eq__, words, words[1:]))
    return [
        np.log1p(len(raw)), *np.sqrt(np.array([*kinds, *share[MARKS]])).tolist(),
        np.log1p(len(words)), len(counts) / m, (again / m) ** 0.5, n / m / 10, (max(counts.values(), default=0) / m) ** 0.5,
        np.log1p(len(lines)), len(set(lines)) / k, np.log1p(n / k),
    ]


def _features_of(batches):
    for batch in tokens.slices(batches):
        rows = [features(text) for text in tokens.texts_of(batch)]
        flat = pa.array(np.array(rows, np.float32).ravel())
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * N_FEATURES)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "held_out", "f"]
        )


def held_out() -> Column:
    """Documents whose labels take no part in learning; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def with_features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, f, quality`` of every row, written once; ids with labels that disagree have none."""
    agreed = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    agreed = agreed.agg(F.min("quality").alias("quality"), F.max("quality").alias("_most")).where("quality = _most").drop("_most")
    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    rows = rows.mapInArrow(_features_of, "doc_id long, held_out boolean, f array<float>")
    return cut_lineage(rows.join(agreed, "doc_id", "left"))


class Scorer:
    """Standardisation of the features and the weights of them, their squares and a constant."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, weights: np.ndarray):
        self.mean, self.deviation, self.weights = mean, deviation, weights

    def expand(self, column: pa.ListArray) -> np.ndarray:
        x = column.flatten().to_numpy().reshape(len(column), N_FEATURES).astype(float)
        z = np.clip((x - self.mean) / self.deviation, -RANGE, RANGE)
        return np.concatenate([np.ones((len(z), 1)), z, np.minimum(z * z, 9.0)], axis=1)


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _softplus(x):
    return np.logaddexp(0.0, x)


class Problem:
    """The learning documents, their numbers and the class prior."""

    def __init__(self, rows: DataFrame, scorer: Scorer, positives: int, unlabelled: int, prior: float):
        self.rows, self.scorer, self.prior = rows, scorer, prior
        self.positives, self.unlabelled = positives, unlabelled

    def sums(self, weights: np.ndarray, mu: float) -> np.ndarray:
        """Losses, gradients and curvature over all documents, one number per slot."""
        scorer, upper = self.scorer, np.triu_indices(N_WEIGHTS)
        own, other = self.prior / max(1, self.positives), 1 / max(1, self.unlabelled)

        def add(batches):
            total = np.zeros(2 + 2 * N_WEIGHTS + len(upper[0]))
            for batch in batches:
                if not batch.num_rows:
                    continue
                z = scorer.expand(batch.column("f"))
                good = batch.column("good").to_numpy(zero_copy_only=False)
                g = z @ weights
                s, loss = _sigmoid(g), _softplus(g)
                # the part that may not fall below zero, its gradient, and the positives' own part
                part = np.where(good, -own, other)
                total[0] += (part * loss).sum()
                total[1] += own * _softplus(-g[good]).sum()
                total[2 : 2 + N_WEIGHTS] += (part * s) @ z
                total[2 + N_WEIGHTS : 2 + 2 * N_WEIGHTS] += own * (s[good] - 1) @ z[good]
                bend = np.where(good, own * (1 - mu), other * mu) * s * (1 - s)
                total[2 + 2 * N_WEIGHTS :] += ((z * bend[:, None]).T @ z)[upper]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["slot", "value"])

        found = self.rows.mapInArrow(add, "slot long, value double").groupBy("slot").agg(F.sum("value").alias("value"))
        out = np.zeros(2 + 2 * N_WEIGHTS + len(upper[0]))
        table = found.toArrow()
        out[table["slot"].to_numpy()] = table["value"].to_numpy()
        return out

    def solve(self) -> np.ndarray:
        """Weights at the saddle point."""
        w, mu, bound = np.zeros(N_WEIGHTS), 1.0, False
        ridge = np.full(N_WEIGHTS, RIDGE)
        ridge[0] = 1e-6
        upper = np.triu_indices(N_WEIGHTS)
        for _ in range(PASSES):
            sums = self.sums(w, mu)
            rest, slope, own = sums[0], sums[2 : 2 + N_WEIGHTS], sums[2 + N_WEIGHTS : 2 + 2 * N_WEIGHTS]
            grad = own + mu * slope + ridge * w
            if np.linalg.norm(grad) < FLAT and (abs(rest) < FLAT or (mu == 1.0 and rest > 0)):
                break
            curve = np.zeros((N_WEIGHTS, N_WEIGHTS))
            curve[upper] = sums[2 + 2 * N_WEIGHTS :]
            curve = curve + np.triu(curve, 1).T + np.diag(ridge)
            bound = bound or rest < 0 or mu < 1.0
            if bound:
                # the difference is held at zero, and mu is its multiplier
                both = np.zeros((N_WEIGHTS + 1, N_WEIGHTS + 1))
                both[:-1, :-1], both[:-1, -1], both[-1, :-1], both[-1, -1] = curve, slope, slope, -1e-6
                step = np.linalg.solve(both, -np.append(grad, rest))
                dw, dmu = step[:-1], float(step[-1])
            else:
                dw, dmu = np.linalg.solve(curve, -grad), 0.0
            pace = min(1.0, LONGEST_STEP / max(1e-12, float(np.linalg.norm(dw))))
            w, mu = w + pace * dw, min(1.0, max(0.0, mu + pace * dmu))
            bound = bound and not (mu == 1.0 and dmu > 0)
        return w


def problem(rows: DataFrame) -> Problem | None:
    """Set up learning from rows that are not held out; none without a positive.

    The prior is the (smoothed) share of positives among the labelled rows. Unlabelled are the
    rows without a label, or all rows where every row has one.
    """
    rows = rows.where("NOT held_out")
    positive, open_row = F.col("quality") == 1, F.col("quality").isNull()
    counts = rows.agg(
        F.count_if(positive).alias("p"), F.count_if(~positive).alias("n"), F.count_if(open_row).alias("u"), F.count(F.lit(1)).alias("all")
    ).first()
    if not counts.p:
        return None
    good = rows.where(positive).withColumn("good", F.lit(True))
    web = (rows.where(open_row) if counts.u else rows).withColumn("good", F.lit(False))
    each = [f(F.col("f")[i].cast("double")) for i in range(N_FEATURES) for f in (F.avg, F.stddev_pop)]
    scale = np.array(web.agg(*[e.alias(f"_{i}") for i, e in enumerate(each)]).first(), float)
    scorer = Scorer(scale[::2], scale[1::2] + 1e-6, np.zeros(N_WEIGHTS))
    prior = (counts.p + 1) / (counts.p + counts.n + 2)
    return Problem(good.unionByName(web).select("f", "good"), scorer, counts.p, counts.u or counts["all"], prior)


def quality_scores(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from its whole text alone.

    Learns from all documents that are not held out: those labelled 1 are the trusted positives,
    those without a label the web text. A null text counts as empty and is scored like others.
    Repeated rows count each, a missing id has no label, ids whose labels disagree count as
    unlabelled. Without a positive every score is 0.5. Other columns are not read.
    """
    rows = with_features(docs.select("doc_id", "text"), labels)
    task = problem(rows)
    scorer = task and task.scorer
    if task:
        scorer.weights = task.solve()

    def score(batches):
        for batch in batches:
            n = batch.num_rows
            value = _sigmoid(scorer.expand(batch.column("f")) @ scorer.weights) if scorer and n else np.full(n, 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(value), pa.array((value >= cut).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    columns = rows.select("doc_id", "held_out", "f")
    return columns.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
