"""Time-series operators on long tables (key, t in epoch seconds, value)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.operators import ordered
from tramline.operators.shaping import dense_index


def bucket(t: str, step: int, origin: int = 0) -> Column:
    """Start of the ``step``-second interval that holds ``t``."""
    return (F.floor((F.col(t) - origin) / step) * step + origin).cast("bigint")


def resample_mean(df: DataFrame, keys: list[str], t: str, value: str, step: int) -> DataFrame:
    return df.groupBy(*keys, bucket(t, step).alias(t)).agg(F.avg(value).alias(value))


def time_grid(df: DataFrame, keys: list[str], t: str, step: int) -> DataFrame:
    """``df`` (unique per key and grid time) on the grid from its first to its last time for every key; gaps are NULL."""
    bounds = df.agg(F.min(t).alias("lo"), F.max(t).alias("hi")).first()
    if bounds.lo is None:
        return df
    grid = df.select(*keys).distinct().withColumn(
        t, F.explode(F.sequence(F.lit(bounds.lo).cast("bigint"), F.lit(bounds.hi).cast("bigint"), F.lit(step).cast("bigint")))
    )
    return grid.join(df, [*keys, t], "left")


def interpolate(
    df: DataFrame, keys: list[str], t: str, value: str, out: str, mode: str = "time",
    chunks: int | None = None,
) -> DataFrame:
    """Linear fill of interior gaps; leading gaps stay NULL.

    ``mode="position"`` weighs by row position and lets trailing gaps repeat the
    last value, as data-frame libraries do by default.
    """
    base, at = ordered.chunked(df, keys, [t], chunks), t
    if mode == "position":
        base, at = ordered.row_numbers(base, keys, [t], "_pos"), "_pos"
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(at).alias("at"), F.col(value).alias("v")))
    both = ordered.carry(base, keys, [t], {"_prev": known}, {"_next": known})
    p, n = F.col("_prev"), F.col("_next")
    share = (F.col(at) - p.at) / (n.at - p.at)
    inner = p.v + (n.v - p.v) * share
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(p.isNotNull() & n.isNotNull(), inner)
    if mode == "position":
        filled = F.coalesce(filled, p.v)
    return both.withColumn(out, filled).select(*df.columns, out)


def trailing_mean(
    df: DataFrame, keys: list[str], t: str, value: str, span: int, out: str, with_current: bool = True
) -> DataFrame:
    """Mean of ``value`` over ``[t - span, t]`` (or up to ``t - 1``) per key.

    Rows of the same second are summed first. Time is cut into buckets of ``span`` seconds;
    a window is the end of the bucket before, from ``t - span`` on, and the start of its own,
    so sums from a bucket's start and from its end give it without a subtraction: large or
    infinite values leave no trace outside their windows. A window group has at most ``span``
    rows whatever the size of the key.
    """
    bucket_of = F.floor(F.col(t) / span).cast("bigint")
    per = df.groupBy(*keys, t).agg(F.sum(value).alias("_s"), F.count(value).alias("_n")).withColumn("_b", bucket_of)
    w = Window.partitionBy(*keys, "_b").orderBy(t)
    head = w.rowsBetween(Window.unboundedPreceding, 0 if with_current else -1)
    tail = w.rowsBetween(0, Window.unboundedFollowing)
    sums = per.withColumns({
        "_hs": F.sum("_s").over(head), "_hn": F.sum("_n").over(head),
        "_ts": F.sum("_s").over(tail), "_tn": F.sum("_n").over(tail),
    })
    # a second asks the bucket before its own for what stands there from t - span on
    ask = sums.select(*keys, (F.col("_b") - 1).alias("_b"), (F.col(t) - span).alias("_at"), F.lit(0).alias("_kind"), F.col(t).alias("_t"), "_hs", "_hn", F.lit(None).cast("struct<s:double,n:bigint>").alias("_end"))
    told = sums.select(*keys, "_b", F.col(t).alias("_at"), F.lit(1).alias("_kind"), F.col(t).alias("_t"), "_hs", "_hn", F.struct(F.col("_ts").cast("double").alias("s"), F.col("_tn").alias("n")).alias("_end"))
    ahead = Window.partitionBy(*keys, "_b").orderBy("_at", "_kind").rowsBetween(0, Window.unboundedFollowing)
    met = ask.unionByName(told).withColumn("_end", F.first("_end", ignorenulls=True).over(ahead)).where("_kind = 0")
    n = F.coalesce("_hn", F.lit(0)) + F.coalesce("_end.n", F.lit(0))
    # a sum of no values is null and takes no part
    total = F.coalesce("_hs", F.lit(0.0)) + F.coalesce("_end.s", F.lit(0.0))
    means = met.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_t").alias("_kt"), F.when(n > 0, total / n).alias(out))
    same = [df[k].eqNullSafe(means[f"_k{i}"]) for i, k in enumerate(keys)] + [df[t] == means["_kt"]]
    return df.join(means, same, "left").select(*df.columns, out)


def ema(
    df: DataFrame, keys: list[str], order: list[str], value: str, out: str, alpha: float = 0.1,
    chunks: int | None = None,
) -> DataFrame:
    """Exponential moving average per key, seeded with the first value."""
    placed = ordered.chunked(df.where(F.col(value).isNotNull()), keys, order, chunks)
    n = ordered.row_numbers(placed, keys, order, "_n")
    first = F.col("_n") == 1
    a = F.when(first, 0.0).otherwise(1 - alpha)
    b = F.when(first, F.col(value)).otherwise(alpha * F.col(value))
    return ordered.linear_scan(n, keys, order, a, b, out).drop("_n", ordered.CHUNK)


def kalman_gains(q: float, r: float) -> tuple[np.ndarray, float]:
    """Gains of the first steps of a scalar random walk, and the fixed gain of all later ones.

    The gain depends on the step number only, not on the data. With ``q`` above 0 it approaches
    the fixed point of the variance; steps are listed until it is reached. With ``q = 0`` it
    has a closed form, ``kalman_gain``, and none are listed.
    """
    if q == 0:
        return np.zeros(0), 0.0
    steady = (math.sqrt(q * q + 4 * q * r) + q) / 2
    fixed, gains, p = steady / (steady + r), [], 1.0
    while not gains or abs(gains[-1] - fixed) > 1e-15 * fixed:
        gain = (p + q) / (p + q + r)
        if gains and gain == gains[-1]:
            break
        gains.append(gain)
        p = (1 - gain) * (p + q)
    return np.array(gains), gains[-1]


def kalman(
    df: DataFrame, keys: list[str], order: list[str], value: str, out: str,
    q: float = 1e-5, r: float = 0.1, chunks: int | None = None,
) -> DataFrame:
    """Scalar random-walk Kalman filter per key, started at the first value."""
    gains, fixed = kalman_gains(q, r)

    @F.pandas_udf(T.DoubleType())
    def gain(step: pd.Series) -> pd.Series:
        n = step.to_numpy()
        if not len(gains):
            return pd.Series(1.0 / (n + r))
        return pd.Series(np.where(n <= len(gains), gains[np.minimum(n, len(gains)) - 1], fixed))

    placed = ordered.chunked(df.where(F.col(value).isNotNull()), keys, order, chunks)
    n = ordered.row_numbers(placed, keys, order, "_n")
    n = n.withColumn("_k", F.when(F.col("_n") == 1, 1.0).otherwise(gain(F.greatest(F.col("_n") - 1, F.lit(1)))))
    out_df = ordered.linear_scan(n, keys, order, 1 - F.col("_k"), F.col("_k") * F.col(value), out)
    return out_df.drop("_n", "_k", ordered.CHUNK)


def drift_flags(
    df: DataFrame, keys: list[str], t: str, value: str, ema_col: str, slope_limit: float, z_limit: float
) -> DataFrame:
    """Trend of the smoothed series (units per day) and largest z-score, with a flag for each."""
    base = F.min(t)
    stats = df.groupBy(*keys).agg(
        F.regr_slope(F.col(ema_col), F.col(t) / 86400.0).alias("trend_per_day"),
        F.avg(value).alias("_mean"), F.stddev(value).alias("_std"),
        F.max(value).alias("_max"), F.min(value).alias("_min"), base.alias("first_t"),
    )
    z = F.greatest(F.col("_max") - F.col("_mean"), F.col("_mean") - F.col("_min")) / F.col("_std")
    return stats.select(
        *keys, "trend_per_day", z.alias("peak_z"),
        (F.abs("trend_per_day") > slope_limit).alias("trending"), (z > z_limit).alias("spiky"),
    )


def hann_weights(length: int) -> list[float]:
    raw = [0.5 - 0.5 * math.cos(2 * math.pi * i / (length - 1)) for i in range(length)]
    return [x / sum(raw) for x in raw]


def hann_smooth(df: DataFrame, keys: list[str], pos: str, value: str, out: str, length: int = 11) -> DataFrame:
    """Hann-window smoothing of series numbered 0, 1, ... with odd reflection at both ends.

    Every point is handed to its neighbours with its weight and the parts are
    summed, so no window over the whole series is needed.
    """
    half = length // 2
    weights = F.array(*[F.lit(w) for w in hann_weights(length)])
    ends = df.groupBy(*keys).agg(
        F.min_by(value, pos).alias("_x0"), F.max_by(value, pos).alias("_xn"), F.max(pos).alias("_last")
    )
    x = df.join(ends, keys)
    # position -j mirrors j - 1, position last + j mirrors last - j + 1
    mirrored = F.array_compact(
        F.array(
            F.struct(F.col(pos).alias("at"), F.col(value).alias("x")),
            F.when(F.col(pos) < half, F.struct((-F.col(pos) - 1).alias("at"), (2 * F.col("_x0") - F.col(value)).alias("x"))),
            F.when(
                F.col("_last") - F.col(pos) < half,
                F.struct(
                    (2 * F.col("_last") + 1 - F.col(pos)).alias("at"), (2 * F.col("_xn") - F.col(value)).alias("x")
                ),
            ),
        )
    )
    padded = x.select(*keys, "_last", F.explode(mirrored).alias("s"))
    spread = padded.select(
        *keys, "_last", F.col("s.x").alias("x"), F.col("s.at").alias("at"), F.posexplode(weights).alias("_i", "_w")
    ).withColumn("_to", F.col("at") + F.col("_i") - half)
    smooth = spread.where((F.col("_to") >= 0) & (F.col("_to") <= F.col("_last"))).groupBy(
        *keys, F.col("_to").alias(pos)
    ).agg(F.sum(F.col("_w") * F.col("x")).alias(out))
    return df.join(smooth, [*keys, pos])


def cv_folds(df: DataFrame, order: list[str], folds: int, chunks: int | None = None) -> DataFrame:
    """Expanding-window folds: rows of block ``b`` test fold ``b`` and train all later folds."""
    ranked = dense_index(df, order, "_rank", 0, chunks)
    total = df.agg(F.count(F.lit(1)))
    block = F.floor(F.col("_rank") * (folds + 1) / total.scalar()).cast("int")
    roles = F.explode(
        F.filter(
            F.transform(
                F.sequence(F.lit(1), F.lit(folds)),
                lambda f: F.struct(
                    f.alias("fold"),
                    F.when(F.col("_block") == f, "test").when(F.col("_block") < f, "train").alias("role"),
                ),
            ),
            lambda s: s.role.isNotNull(),
        )
    )
    return ranked.withColumn("_block", block).withColumn("_f", roles).select(*df.columns, "_f.fold", "_f.role")
