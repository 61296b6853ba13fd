"""Nearest-in-time join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators import ordered


def nearest_in_time(
    events: DataFrame, readings: DataFrame, key: str, t: str, tolerance: int,
    chunks: int | None = None,
) -> DataFrame:
    """Every event with its nearest reading of the same key within ``tolerance``.

    Both sides are interleaved in time order and the last reading before and the
    next one after are carried to each event: one shuffle, no pairs. On equal
    distance the earlier reading wins. Events without a reading stay, with
    ``matched`` false. ``readings`` must be unique per (key, t); its columns must
    differ from those of ``events`` apart from ``key`` and ``t``.
    """
    payload = [c for c in readings.columns if c not in (key, t)]
    rs = readings.select(
        key, t, F.lit(0).alias("_kind"), F.struct(F.col(t).alias("reading_t"), *payload).alias("_r")
    )
    ev_cols = [c for c in events.columns if c not in (key, t)]
    es = events.select(key, t, F.lit(1).alias("_kind"), F.struct(*ev_cols).alias("_ev"))
    both = rs.unionByName(es, allowMissingColumns=True)
    order = [t, "_kind"]
    both = ordered.carry(both, [key], order, {"_prev": F.col("_r")}, {"_next": F.col("_r")}, chunks)
    back = F.col(t) - F.col("_prev.reading_t")
    ahead = F.col("_next.reading_t") - F.col(t)
    use_prev = (back <= tolerance) & (F.col("_next").isNull() | (back <= ahead))
    best = F.when(use_prev, F.col("_prev")).when(ahead <= tolerance, F.col("_next"))
    out = both.where(F.col("_kind") == 1).withColumn("_best", best)
    return out.select(
        key, t, "_ev.*", F.col("_best").isNotNull().alias("matched"), "_best.*"
    )
