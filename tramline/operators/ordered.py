"""Ordered operators that stay parallel when one key holds most rows.

Rows are dealt out by ranges of the whole tuple (key, order), which Spark samples in the
columns' own order: hot keys, equal leading values and nulls are split like all others, at
any size and for every orderable type. A range is a chunk, written once. A key's rows inside
a chunk are windowed on their own, and the state at chunk borders, which only keys that
cross a border have, is carried over. A chain of operators over the same key and order can
share one ``chunked`` frame: frames with a ``_chunk`` are taken as they are and keep it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.session import cut_lineage

CHUNK = "_chunk"
#: Steps of a linear recurrence that are taken at once in a batch.
BLOCK = 64


def chunked(df: DataFrame, keys: list[str], order: list[str], chunks: int | None = None) -> DataFrame:
    """``df`` with ``_chunk``, non-decreasing in ``order`` within a key; rows of equal order share one.

    ``chunks`` is the number of ranges, by default that of shuffle partitions.
    """
    if CHUNK in df.columns:
        return df
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    placed = df.repartitionByRange(chunks, *by) if chunks else df.repartitionByRange(*by)
    # written, so that the ranges cannot change between evaluations
    return cut_lineage(placed.withColumn(CHUNK, F.spark_partition_id()))


def _window(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys, CHUNK).orderBy(*[F.col(c).asc_nulls_first() for c in order])


def _before(keys: list[str]):
    return Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def _after(keys: list[str]):
    return Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(1, Window.unboundedFollowing)


def _with_borders(rows: DataFrame, borders: DataFrame, keys: list[str]) -> DataFrame:
    """Join the state at chunk borders; null keys meet as well.

    Only keys that cross a border have one, so there are at most two rows per chunk, however many
    rows and keys there are: they are broadcast without being counted.
    """
    names = {k: f"_at_{i}" for i, k in enumerate([*keys, CHUNK])}
    borders = F.broadcast(borders.withColumnsRenamed(names))
    same = [rows[k].eqNullSafe(borders[name]) for k, name in names.items()]
    return rows.join(borders, same, "left").drop(*names.values())


def _kept(df: DataFrame, *more: str) -> list[str]:
    return [*df.columns, *more]


def running_sum(
    df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, chunks: int | None = None
) -> DataFrame:
    """Sum of ``value`` from the first row of the key to the current row."""
    c = chunked(df.withColumn("_v", value), keys, order, chunks)
    w = _window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    totals = c.groupBy(*keys, CHUNK).agg(F.sum("_v").alias("_s"))
    before = totals.withColumn("_off", F.sum("_s").over(_before(keys))).where("_off IS NOT NULL").drop("_s")
    res = _with_borders(c.withColumn(out, F.sum("_v").over(w)), before, keys)
    # a sum of nulls alone is null
    total = F.when(F.col(out).isNull() & F.col("_off").isNull(), None).otherwise(
        F.coalesce(out, F.lit(0)) + F.coalesce("_off", F.lit(0))
    )
    return res.withColumn(out, total).select(*_kept(df, out))


def row_numbers(df: DataFrame, keys: list[str], order: list[str], out: str, chunks: int | None = None) -> DataFrame:
    """1-based position of a row in its key; ``order`` must be total, nulls come first."""
    return running_sum(df, keys, order, F.lit(1).cast("bigint"), out, chunks)


def carry(
    df: DataFrame, keys: list[str], order: list[str], last: dict[str, Column] | None = None,
    following: dict[str, Column] | None = None, chunks: int | None = None,
) -> DataFrame:
    """The last non-null (``last``) and next non-null (``following``) values, the current row included."""
    w = _window(keys, order)
    sides = [
        (last or {}, F.last, w.rowsBetween(Window.unboundedPreceding, 0), F.max_by, _before(keys)),
        (following or {}, F.first, w.rowsBetween(0, Window.unboundedFollowing), F.min_by, _after(keys)),
    ]
    names = [o for values, *_ in sides for o in values]
    c = df.withColumns({f"_in_{o}": v for values, *_ in sides for o, v in values.items()})
    c = chunked(c, keys, order, chunks)
    res, rank, ends, borders = c, F.struct(*order), [], {}
    for values, pick, span, best, across in sides:
        if values:
            res = res.withColumns({o: pick(f"_in_{o}", ignorenulls=True).over(span) for o in values})
        for o in values:
            ends.append(best(f"_in_{o}", F.when(F.col(f"_in_{o}").isNotNull(), rank)).alias(f"_e_{o}"))
            borders[f"_b_{o}"] = pick(f"_e_{o}", ignorenulls=True).over(across)
    edge = c.groupBy(*keys, CHUNK).agg(*ends).withColumns(borders)
    edge = edge.select(*keys, CHUNK, *borders).where(" OR ".join(f"{b} IS NOT NULL" for b in borders))
    res = _with_borders(res, edge, keys).withColumns({o: F.coalesce(o, f"_b_{o}") for o in names})
    return res.select(*_kept(df, *names))


def neighbour(
    df: DataFrame, keys: list[str], order: list[str], value: Column, out: str,
    step: int = -1, chunks: int | None = None,
) -> DataFrame:
    """The non-null ``value`` of the previous (-1) or next (+1) row of the key."""
    c = chunked(df.withColumn("_v", value), keys, order, chunks)
    w = _window(keys, order)
    ends = c.groupBy(*keys, CHUNK).agg((F.max_by if step < 0 else F.min_by)("_v", F.struct(*order)).alias("_end"))
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    ends = ends.withColumn("_end", F.lag("_end").over(across) if step < 0 else F.lead("_end").over(across))
    res = c.withColumn(out, F.lag("_v").over(w) if step < 0 else F.lead("_v").over(w))
    res = _with_borders(res, ends.where("_end IS NOT NULL"), keys).withColumn(out, F.coalesce(out, "_end"))
    return res.select(*_kept(df, out))


def _steps(a: np.ndarray, b: np.ndarray, first: np.ndarray, y: float, p: float):
    """``y = a * y_previous + b`` and the product of the factors since a row marked ``first``.

    Blocks of rows advance together, one step at a time, from zero; then each takes up the
    state of the block before it. A first row cuts what is before it off: its factor is zero
    for the sum and starts the product anew.
    """
    n = len(a)
    width = -(-n // BLOCK)
    pad = BLOCK * width - n
    factor = np.pad(np.where(first, 0.0, a), (0, pad)).reshape(BLOCK, width)
    addend = np.pad(b, (0, pad)).reshape(BLOCK, width)
    fresh = np.pad(first, (0, pad)).reshape(BLOCK, width)
    start = np.pad(a, (0, pad)).reshape(BLOCK, width)
    ys, through, ps = np.empty((BLOCK, width)), np.empty((BLOCK, width)), np.empty((BLOCK, width))
    opened = np.zeros((BLOCK, width), bool)
    state, passed, product, seen = np.zeros(BLOCK), np.ones(BLOCK), np.ones(BLOCK), np.zeros(BLOCK, bool)
    for i in range(width):
        state = factor[:, i] * state + addend[:, i]
        passed = factor[:, i] * passed
        product = np.where(fresh[:, i], start[:, i], start[:, i] * product)
        seen = seen | fresh[:, i]
        ys[:, i], through[:, i], ps[:, i], opened[:, i] = state, passed, product, seen
    for k in range(BLOCK):
        # what comes in from before reaches the rows of the block up to its first opening
        ys[k] += np.where(opened[k], 0.0, through[k] * y)
        ps[k] *= np.where(opened[k], 1.0, p)
        y, p = float(ys[k, -1]), float(ps[k, -1])
    ys, ps = ys.ravel()[:n], ps.ravel()[:n]
    return ys, ps


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    y, p = 0.0, 1.0
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_a", "_b", "_first"))
        ys, ps = _steps(a.astype(float), b.astype(float), first.astype(bool), y, p)
        y, p = float(ys[-1]), float(ps[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(ys), pa.array(ps)], names=[*batch.schema.names, "_y", "_p"]
        )


def linear_scan(
    df: DataFrame, keys: list[str], order: list[str], a: Column, b: Column, out: str, chunks: int | None = None
) -> DataFrame:
    """``y = a * y_previous + b`` along each key, starting from ``y_previous = 0``.

    The rows of a chunk stream through Arrow batches with constant state. With zero start
    the pass also yields the product ``p`` of the factors, so a chunk that does not open its
    key is corrected by ``p * y_end(previous chunk)``.
    """
    c = chunked(df.withColumns({"_a": a, "_b": b}), keys, order, chunks)
    c = c.withColumn("_first", F.row_number().over(_window(keys, order)) == 1)
    # the borders are read twice, so the scan itself is written once
    res = cut_lineage(_apply_scan(c, [*keys, CHUNK], order))
    ends = res.groupBy(*keys, CHUNK).agg(F.max_by(F.struct("_p", "_y"), F.struct(*order)).alias("_e"))
    ends = ends.select(*keys, CHUNK, F.col("_e._p").alias("_a"), F.col("_e._y").alias("_b"))
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    ends = ends.withColumn("_first", F.row_number().over(across) == 1)
    ends = _apply_scan(ends, keys, [CHUNK])
    ends = ends.select(*keys, CHUNK, F.lag("_y").over(across).alias("_y0")).where("_y0 IS NOT NULL")
    whole = F.col("_y") + F.when(F.col("_y0").isNull(), 0.0).otherwise(F.col("_p") * F.col("_y0"))
    return _with_borders(res, ends, keys).withColumn(out, whole).select(*_kept(df, out))


def _apply_scan(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    placed = df.repartition(*group).sortWithinPartitions(
        *group, *[F.col(c).asc_nulls_first() for c in order]
    )
    extra = [T.StructField("_y", T.DoubleType()), T.StructField("_p", T.DoubleType())]
    schema = T.StructType(placed.schema.fields + extra)
    return placed.mapInArrow(_scan, schema)
