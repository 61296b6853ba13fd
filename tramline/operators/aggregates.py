"""Grouped summaries built as single passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.session import broadcast_if_small, cut_lineage


def is_blank(name: str) -> Column:
    c = F.col(name)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows, distinct values, blank values, numeric minimum and maximum; one row per column.

    One pass over the data: every row is turned into (column, value) pairs that
    are counted per distinct value before anything else.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    )
    counted = df.select(pairs.alias("p")).groupBy("p.name", "p.value").agg(F.count(F.lit(1)).alias("n"))
    number = F.col("value").try_cast("double")
    blank = F.col("value").isNull() | (F.trim("value") == "")
    return counted.groupBy(F.col("name").alias("column_name")).agg(
        F.sum("n").alias("n_rows"),
        F.count("value").alias("n_distinct"),
        F.sum(F.when(blank, F.col("n")).otherwise(0)).alias("n_blank"),
        F.min(number).alias("min_number"),
        F.max(number).alias("max_number"),
    )


def null_percent(df: DataFrame, period: Column, columns: list[str]) -> DataFrame:
    """Share of null or blank values per column and period, in percent."""
    shares = [(100 * F.avg(is_blank(c).cast("double"))).alias(f"{c}_pct") for c in columns]
    return df.groupBy(period.alias("period")).agg(*shares)


def null_fractions(df: DataFrame, columns: list[str], keep_below: float = 0.5) -> DataFrame:
    """Null share of all columns in one pass, with the decision to keep and to impute."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    long = one.unpivot([], columns, "column_name", "null_fraction")
    frac = F.col("null_fraction")
    return long.select(
        "column_name", "null_fraction", (frac < keep_below).alias("keep"),
        ((frac > 0) & (frac < keep_below)).alias("impute"),
    )


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Attach ``total / (classes * count(label))`` to every row."""
    counts = cut_lineage(df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")))
    totals = counts.agg(F.sum("_n") / F.count(F.lit(1)))
    weights = counts.select(label, (totals.scalar() / F.col("_n")).alias(out))
    # one row per class: broadcast, so that a frequent class is not one shuffle partition
    return df.join(broadcast_if_small(weights), label)


def describe_numeric(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, interpolated quartiles and max of one column as rows."""
    from tramline.operators.quantiles import exact_quantiles

    base = df.agg(
        F.count(column).cast("double").alias("count"),
        F.avg(column).alias("mean"),
        F.stddev(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    q = exact_quantiles(
        df.withColumn("_g", F.lit(1)), ["_g"], column, {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    ).select("p25", "p50", "p75")
    long = [f.unpivot([], f.columns, "statistic", "value") for f in (base, q)]
    return long[0].unionByName(long[1])


def transfer_stats(stops: DataFrame, transfers: DataFrame, default_seconds: int = 120) -> DataFrame:
    """Minimum change time and number of transfer targets per stop."""
    per = transfers.groupBy(F.col("from_stop").alias("stop_id")).agg(
        F.min("min_transfer_time").alias("min_transfer_time"), F.count(F.lit(1)).alias("transfer_degree")
    )
    out = stops.select("stop_id").join(per, "stop_id", "left")
    return out.na.fill({"min_transfer_time": default_seconds, "transfer_degree": 0})
