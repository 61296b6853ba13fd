"""Least squares from means and centred sums of products.

One pass collects, per block of rows, the number of rows, the means and the centred products
(co-moments) of all features and the target: an Arrow batch is one matrix product, and
the parts are merged pairwise, first per task, then in two steps across tasks. Everything
else - fits on unions of blocks, errors on other blocks, feature selection - is algebra on
those small matrices and needs no further pass over the data. Centring keeps the digits
that plain sums of squares lose where values are far from zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups that merge the tasks' parts of a block before the last step.
MERGERS = 32


@dataclass(frozen=True)
class Moments:
    """Rows, means and centred products of the features and, last, the target."""

    n: float
    mean: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        gap = other.mean - self.mean
        products = self.products + other.products + np.outer(gap, gap) * (self.n * other.n / n)
        return Moments(n, self.mean + gap * (other.n / n), products)


def second_degree(x: np.ndarray) -> np.ndarray:
    """Columns, their squares and their products in pairs (column by column, the partner not before it)."""
    i, j = np.triu_indices(x.shape[1])
    return np.concatenate([x, x[:, i] * x[:, j]], axis=1)


def moments_of(z: np.ndarray) -> Moments:
    mean = z.mean(0)
    centred = z - mean
    return Moments(float(len(z)), mean, centred.T @ centred)


def _parts(found: dict[int, Moments], group: int) -> pa.RecordBatch:
    flat = [np.concatenate([[m.n], m.mean, m.products[np.triu_indices(len(m.mean))]]) for m in found.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.int64()), pa.array([group] * len(found), pa.int32()), pa.array(flat, pa.list_(pa.float64()))],
        ["block", "part", "m"],
    )


def _unpack(flat: np.ndarray, width: int) -> Moments:
    products = np.zeros((width, width))
    products[np.triu_indices(width)] = flat[1 + width :]
    return Moments(float(flat[0]), flat[1 : 1 + width], products + np.triu(products, 1).T)


def block_moments(df: DataFrame, block: str, features: list[str], target: str, degree: int = 1) -> dict[int, Moments]:
    """Moments per block, on the driver: (blocks) x (width)^2 numbers, for a bounded number of blocks.

    Rows with a null are left out. With ``degree`` 2 also squares and products of the features.
    """
    columns = [*features, target]
    known = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [block, *columns]))
    known = known.select(F.col(block).cast("long").alias("_block"), *[F.col(f"`{c}`").cast("double") for c in columns])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Moments] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.column(0).to_numpy()
            z = np.column_stack([batch.column(i).to_numpy() for i in range(1, batch.num_columns)])
            if degree == 2:
                z = np.concatenate([second_degree(z[:, :-1]), z[:, -1:]], axis=1)
            for b in np.unique(of).tolist():
                own = moments_of(z[of == b])
                found[b] = found[b] + own if b in found else own
        yield _parts(found, TaskContext.get().partitionId() % MERGERS)

    n = len(features)
    width = (n + n * (n + 1) // 2 if degree == 2 else n) + 1

    def merge(last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, Moments] = {}
            for batch in batches:
                for b, m in zip(batch.column("block").to_pylist(), batch.column("m"), strict=True):
                    own = _unpack(m.values.to_numpy(), width)
                    found[b] = found[b] + own if b in found else own
            yield _parts(found, 0 if last else TaskContext.get().partitionId())

        return run

    schema = "block long, part int, m array<double>"
    parts = known.mapInArrow(collect, schema).repartition("block", "part").mapInArrow(merge(False), schema)
    rows = parts.repartition("block").mapInArrow(merge(True), schema).collect()
    return {row.block: _unpack(np.array(row.m), width) for row in rows}


def gramian(df: DataFrame, keys: list[str], features: list[str], target: str) -> DataFrame:
    """Per key the upper triangle of ``Z'Z`` as one array, with Z = [1, features, target]."""
    z = [F.lit(1.0), *[F.col(c).cast("double") for c in [*features, target]]]
    known = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*features, target]))
    sums = [F.sum(z[i] * z[j]) for i in range(len(z)) for j in range(i, len(z))]
    return known.groupBy(*keys).agg(F.array(*sums).alias("gram"))


def square(upper: np.ndarray) -> np.ndarray:
    """The symmetric matrix of an upper triangle in row order."""
    n = int((np.sqrt(8 * len(upper) + 1) - 1) / 2)
    m = np.zeros((n, n))
    m[np.triu_indices(n)] = upper
    return m + np.triu(m, 1).T


@dataclass(frozen=True)
class Fit:
    """Coefficients (constant first) and the numbers that describe the errors."""

    beta: np.ndarray
    n: float
    mse: float
    r2: float
    residual_mean: float
    residual_std: float


def _least_squares(xx: np.ndarray, xy: np.ndarray) -> np.ndarray:
    # scale before solving so that features of different size are treated alike
    scale = np.sqrt(np.maximum(np.diag(xx), 1e-300))
    # minimum-norm answer where features are collinear
    return np.linalg.lstsq(xx / np.outer(scale, scale), xy / scale, rcond=1e-12)[0] / scale


def solve(m: Moments, use: list[int] | None = None) -> np.ndarray:
    """Coefficients for the constant and the feature positions in ``use`` (0-based)."""
    d = len(m.mean) - 1
    cols = list(range(d) if use is None else use)
    beta = np.zeros(d + 1)
    if cols:
        beta[[1 + c for c in cols]] = _least_squares(m.products[np.ix_(cols, cols)], m.products[cols, -1])
    beta[0] = m.mean[-1] - m.mean[:-1] @ beta[1:]
    return beta


def score(m: Moments, beta: np.ndarray) -> Fit:
    """Errors of ``beta`` on the rows that ``m`` sums up."""
    slope = beta[1:]
    xx, xy, yy = m.products[:-1, :-1], m.products[:-1, -1], m.products[-1, -1]
    mean = float(m.mean[-1] - beta[0] - m.mean[:-1] @ slope)
    spread = max(float(yy - 2 * slope @ xy + slope @ xx @ slope), 0.0)
    sse = spread + m.n * mean * mean
    return Fit(beta, m.n, sse / m.n, 1 - sse / yy if yy > 0 else 0.0, mean, float(np.sqrt(spread / m.n)))


def expanding_folds(blocks: dict[int, Moments]) -> list[tuple[int, Moments, Moments]]:
    """(fold, train, test): fold f is tested on block f and trained on all earlier blocks."""
    order = sorted(blocks)
    return [(b, reduce(Moments.__add__, [blocks[p] for p in order if p < b]), blocks[b]) for b in order[1:]]


def cross_validate(blocks: dict[int, Moments], use: list[int] | None = None) -> list[tuple[int, Fit]]:
    return [(f, score(test, solve(train, use))) for f, train, test in expanding_folds(blocks)]


def best_fold(fits: list[tuple[int, Fit]]) -> int:
    """The fold of least mean squared error (ties: the first)."""
    return min(fits, key=lambda x: (x[1].mse, x[0]))[0]


def best_r2(blocks: dict[int, Moments], use: list[int]) -> float:
    """R2 of the best fold."""
    return max(fit.r2 for _, fit in cross_validate(blocks, use))


@dataclass(frozen=True)
class Step:
    """One step of a selection: the features in use, the one that came or went, and R2 of the best fold."""

    use: tuple[int, ...]
    changed: int | None
    r2: float


def forward_by_rank(blocks: dict[int, Moments], ranked: list[int]) -> list[Step]:
    """Steps with the first 1, 2, ... features of a ranking."""
    return [Step(tuple(ranked[:k]), ranked[k - 1], best_r2(blocks, ranked[:k])) for k in range(1, len(ranked) + 1)]


def backward_elimination(blocks: dict[int, Moments]) -> list[Step]:
    """Drop the feature with the smallest standardised coefficient until one is left."""
    total = reduce(Moments.__add__, blocks.values())
    std = np.sqrt(np.maximum(np.diag(total.products)[:-1] / total.n, 0))
    left = list(range(len(std)))
    steps = [Step(tuple(left), None, best_r2(blocks, left))]
    while len(left) > 1:
        size = np.abs(solve(total, left)[1:]) * std
        worst = min(left, key=lambda i: (size[i], i))
        left.remove(worst)
        steps.append(Step(tuple(left), worst, best_r2(blocks, left)))
    return steps


def best_step(steps: list[Step]) -> Step:
    """The step of largest R2; of equal ones that with fewest features."""
    return max(steps, key=lambda s: (s.r2, -len(s.use)))


def gram_moments(gram: np.ndarray) -> Moments:
    """Moments from plain sums of products of [1, features, target]."""
    n, mean = gram[0, 0], gram[0, 1:] / gram[0, 0]
    return Moments(float(n), mean, gram[1:, 1:] - n * np.outer(mean, mean))


def fit_per_key(grams: DataFrame, key: str) -> DataFrame:
    """Coefficients and residual spread per key, solved on the executors: (key, beta, spread)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fits = []
            for g in pdf["gram"]:
                m = gram_moments(square(np.asarray(g)))
                fits.append(score(m, solve(m)))
            yield pd.DataFrame(
                {key: pdf[key], "beta": [f.beta for f in fits], "spread": [f.residual_std for f in fits]}
            )

    kind = grams.schema[key].dataType.simpleString()
    return grams.mapInPandas(run, f"{key} {kind}, beta array<double>, spread double")


def mutual_information(df: DataFrame, features: list[str], target: str, bins: int = 16) -> DataFrame:
    """Mutual information (nats) of each feature with the target from equal-width bins.

    Two passes: the ranges, then one joint histogram of all features.
    """
    cols = [*features, target]
    ends = df.agg(*[F.min(c).cast("double").alias(f"{c}_lo") for c in cols], *[F.max(c).cast("double").alias(f"{c}_hi") for c in cols]).first()

    def binned(c: str):
        lo, hi = ends[f"{c}_lo"], ends[f"{c}_hi"]
        width = (hi - lo) or 1.0
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(width) * bins), F.lit(bins - 1)).cast("int")

    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), binned(c).alias("x")) for c in features]))
    joint = df.select(binned(target).alias("y"), pairs.alias("p")).groupBy("p.feature", "p.x", "y").agg(
        F.count(F.lit(1)).alias("nxy")
    )
    nx = joint.groupBy("feature", "x").agg(F.sum("nxy").alias("nx"))
    ny = joint.groupBy("feature", "y").agg(F.sum("nxy").alias("ny"))
    n = joint.groupBy("feature").agg(F.sum("nxy").alias("n"))
    j = joint.join(nx, ["feature", "x"]).join(ny, ["feature", "y"]).join(n, "feature")
    term = F.col("nxy") / F.col("n") * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return j.groupBy("feature").agg(F.sum(term).alias("mi"))
