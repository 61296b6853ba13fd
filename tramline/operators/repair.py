"""Sensor repair: rebuild a drifting site from its nearest good sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators import regression


def repair_sites(
    series: DataFrame, repairs: DataFrame, neighbours: DataFrame, k: int, z: float = 1.96
) -> DataFrame:
    """Spliced series of every site in ``repairs`` with a 95 % prediction band.

    ``series``: site, t, value on a common grid; ``repairs``: site, good_from,
    good_to; ``neighbours``: site, neighbour, rank (1..k, good sites only). One
    linear model per site is fitted on its good period from the neighbours'
    values at the same time; a missing neighbour value is replaced by that
    neighbour's mean over the site's rows. Outside the good period the
    prediction takes the place of the reading. All sites are fitted in one job.
    """
    target = series.join(repairs, "site").withColumn("good", F.col("t").between(F.col("good_from"), F.col("good_to")))
    near = neighbours.join(series.withColumnsRenamed({"site": "neighbour", "value": "x"}), "neighbour")
    names = [f"x{i}" for i in range(1, k + 1)]
    wide = near.groupBy("site", "t").pivot("rank", list(range(1, k + 1))).agg(F.max("x"))
    for i, name in enumerate(names, 1):
        wide = wide.withColumnRenamed(str(i), name)
    means = wide.groupBy("site").agg(*[F.coalesce(F.avg(n), F.lit(0.0)).alias(f"{n}_mean") for n in names])
    rows = target.join(wide, ["site", "t"], "left").join(means, "site", "left")
    rows = rows.withColumns({n: F.coalesce(n, f"{n}_mean", F.lit(0.0)) for n in names})
    grams = regression.gramian(rows.where("good"), ["site"], names, "value")
    fits = regression.fit_per_key(grams, "site")
    j = rows.join(fits, "site")
    predicted = F.col("beta")[0]
    for i, name in enumerate(names, 1):
        predicted = predicted + F.col("beta")[i] * F.col(name)
    fixed = F.when(F.col("good"), F.col("value")).otherwise(predicted)
    return j.select(
        "site", "t", F.col("value").alias("original"), fixed.alias("corrected"),
        (predicted - z * F.col("spread")).alias("lo"), (predicted + z * F.col("spread")).alias("hi"),
    )
