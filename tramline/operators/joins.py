"""Join helpers that the plain DataFrame join does not already spell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_with_flag(left: DataFrame, right: DataFrame, on: list[str], flag: str = "matched") -> DataFrame:
    """Left join to the distinct keys of ``right``; rows of ``left`` are never multiplied."""
    keys = right.select(*on).distinct().withColumn(flag, F.lit(True))
    return left.join(keys, on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def keys_only_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def key_overlap(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """Distinct keys per frame and keys shared by all of them, as one row.

    The frames are stacked with their name and folded per key once, so the
    number of passes does not grow with the number of frames.
    """
    names = list(frames)
    tagged = [df.select(F.col(key).alias("k"), F.lit(n).alias("src")) for n, df in frames.items()]
    stacked = tagged[0]
    for t in tagged[1:]:
        stacked = stacked.unionByName(t)
    seen = (
        stacked.where(F.col("k").isNotNull())
        .groupBy("k")
        .agg(*[F.max((F.col("src") == n).cast("int")).alias(n) for n in names])
    )
    return seen.agg(
        *[F.sum(n).cast("bigint").alias(n) for n in names],
        F.sum(F.array_min(F.array(*names))).cast("bigint").alias("in_all"),
    )
