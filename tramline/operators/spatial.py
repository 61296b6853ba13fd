"""Distance, nearest-neighbour and containment joins as equi joins on grid cells."""

from __future__ import annotations

import math
import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.geo import EARTH_M, haversine, unit_sphere
from tramline.operators import ordered
from tramline.session import broadcast_if_small, cut_lineage

#: Sites of a leaf of the index, and nodes of the level below that one node holds.
LEAF, FAN = 32, 16
#: Bits of a coordinate in the order of the index.
BITS = 21
EDGES = T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in ("x1", "y1", "x2", "y2")]))


def _cells(size: float) -> dict[str, Column]:
    """Cube of side ``size`` around a place on the unit sphere, as three whole numbers."""
    return {f"_c{i}": F.floor(x / size).cast("int") for i, x in enumerate(unit_sphere())}


def pairs_within(a: DataFrame, b: DataFrame, metres: float) -> DataFrame:
    """Pairs of rows of ``a`` and ``b`` (both with lat, lon) at most ``metres`` apart.

    Places are points on the unit sphere, cut into cubes as wide as the chord of ``metres``.
    ``b`` is copied to its cube and the 26 around it, so a row of ``a``, which lies in one cube,
    meets each row of ``b`` once at most, at the poles and over the date line as well. Both
    sides meet in an equi join on the cube, and the exact distance decides. A crowded cube is
    one hot join key, which adaptive skew handling splits. Columns of ``a`` and ``b`` must
    differ apart from lat and lon.
    """
    chord = 2 * math.sin(min(metres / EARTH_M, math.pi) / 2) * 1.0001
    size, own = max(chord, 1e-9), ["_c0", "_c1", "_c2"]
    around = [F.explode(F.array(*[F.col(c) + i for i in (-1, 0, 1)])) for c in own]
    right = b.withColumns(_cells(size))
    for c, copies in zip(own, around):
        right = right.withColumn(c, copies)
    right = right.withColumnsRenamed({"lat": "_lat2", "lon": "_lon2"})
    dist = haversine("lat", "lon", "_lat2", "_lon2")
    # the planner takes the copies for as small as ``b`` itself and would collect them for a broadcast
    left = a.withColumns(_cells(size)).hint("merge")
    pairs = left.join(right, own).withColumn("metres", dist).where(F.col("metres") <= metres)
    keep = [c for c in a.columns if c not in ("lat", "lon")] + [c for c in b.columns if c not in ("lat", "lon")]
    return pairs.select(*keep, "metres")


def _spread_bits(x: Column) -> Column:
    """The lower 21 bits of a whole number, two zero bits behind each."""
    for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def _z_order() -> list[Column]:
    """Place on a curve through the cubes around the unit sphere that keeps near places together mostly.

    Two numbers, the second one for places in the same cube of some 6 m.
    """
    whole = [F.floor((x + 1) * float(1 << (2 * BITS - 1))).cast("bigint") for x in unit_sphere()]
    out = []
    for shift in (BITS, 0):
        code = F.lit(0).cast("bigint")
        for i, x in enumerate(whole):
            # the far end of an axis stays in the last cube
            part = F.least(F.shiftright(x, shift), F.lit((1 << 2 * BITS - shift) - 1)).bitwiseAND(F.lit((1 << BITS) - 1))
            code = code.bitwiseOR(F.shiftleft(_spread_bits(part), i))
        out.append(code)
    return out


AXES = ("x", "y", "z")


def site_tree(sites: DataFrame, site_id: str) -> tuple[DataFrame, list[DataFrame]]:
    """Sites with their ``leaf``, and the levels of a tree over them, from the top.

    Sites are cut into leaves of ``LEAF`` along a space-filling curve, so a leaf is small where
    sites are dense and wide where they are few. A level has, per node, its number of sites, the box
    around them on the unit sphere, and its ``parent``, the node of ``FAN`` such above it.
    """
    high, low = _z_order()
    placed = sites.withColumns({"_z0": high, "_z1": low, "_all": F.lit(0)})
    placed = ordered.row_numbers(placed, ["_all"], ["_z0", "_z1", site_id], "_row")
    placed = cut_lineage(placed.withColumn("leaf", F.floor((F.col("_row") - 1) / LEAF)).drop("_all", "_z0", "_z1", "_row"))
    boxed = placed.select("leaf", *[c.alias(a) for a, c in zip(AXES, unit_sphere())])
    ends = [f(a).alias(f"{a}{i}") for a in AXES for i, f in enumerate((F.min, F.max))]
    level = boxed.groupBy(F.col("leaf").alias("node")).agg(F.count(F.lit(1)).alias("n"), *ends)
    levels = []
    while True:
        level = cut_lineage(level.withColumn("parent", F.floor(F.col("node") / FAN)))
        levels.append(level)
        if level.count() <= FAN:
            return placed, levels[::-1]
        ends = [f(f"{a}{i}").alias(f"{a}{i}") for a in AXES for i, f in enumerate((F.min, F.max))]
        level = level.groupBy(F.col("parent").alias("node")).agg(F.sum("n").alias("n"), *ends)


def nearest(points: DataFrame, point_id: str, sites: DataFrame, site_id: str, k: int = 1) -> DataFrame:
    """The ``k`` nearest sites of every point: ``(point_id, site_id, metres, rank)``.

    A search down a tree of the sites (``site_tree``). At each level a place keeps the nodes
    whose boxes are not farther than the distance within which ``k`` sites are certain to
    lie; so a place meets some leaves near it, however crowded or far away the sites are. There is
    no radius to choose. Points at the same place are searched once, and of many sites at one
    place only ``k`` are looked at. Ties go to the smaller site id; places without both
    coordinates have no neighbours.
    """
    known = "lat IS NOT NULL AND lon IS NOT NULL"
    left = points.where(known).select("lat", "lon").distinct().withColumn("_q", F.monotonically_increasing_id())
    left = cut_lineage(left.select("*", *[c.alias(f"_{a}") for a, c in zip(AXES, unit_sphere())]))
    # of the sites at one place only the k smallest ids can be chosen
    place = Window.partitionBy("lat", "lon").orderBy(site_id)
    sites = sites.where(known).select(site_id, "lat", "lon").withColumn("_n", F.row_number().over(place))
    placed, levels = site_tree(sites.where(F.col("_n") <= k).drop("_n"), site_id)
    met = left.repartition("_q").withColumn("leaf", F.lit(0).cast("bigint"))
    for level in levels:
        met = _step_down(met, level, k)
    right = placed.select("leaf", site_id, F.col("lat").alias("_lat2"), F.col("lon").alias("_lon2"))
    pairs = met.join(broadcast_if_small(right), "leaf").withColumn("metres", haversine("lat", "lon", "_lat2", "_lon2"))
    order = Window.partitionBy("_q").orderBy("metres", site_id)
    best = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # written: the points of a place meet it in a join of their own
    best = cut_lineage(best.select(F.struct("lat", "lon").alias("_loc"), site_id, "metres", "rank"))
    return points.select(point_id, F.struct("lat", "lon").alias("_loc")).join(best, "_loc").select(point_id, site_id, "metres", "rank")


def _step_down(met: DataFrame, level: DataFrame, k: int) -> DataFrame:
    """Places with the nodes of ``level``, below those they have, in which their ``k`` nearest sites may lie."""
    near, far = F.lit(0.0), F.lit(0.0)
    for a in AXES:
        at, lo, hi = F.col(f"_{a}"), F.col(f"{a}0"), F.col(f"{a}1")
        outside = F.greatest(lo - at, at - hi, F.lit(0.0))
        across = F.greatest(F.abs(at - lo), F.abs(at - hi))
        near, far = near + outside * outside, far + across * across
    down = met.withColumnRenamed("leaf", "parent").join(broadcast_if_small(level), "parent")
    down = down.withColumns({"_near": near, "_far": far})
    w = Window.partitionBy("_q")
    upto = F.sum("n").over(w.orderBy("_far", "node").rowsBetween(Window.unboundedPreceding, 0))
    down = down.withColumn("_upto", upto)
    # squared chords; the margin covers rounding
    bound = F.min(F.when(F.col("_upto") >= k, F.col("_far"))).over(w)
    down = down.withColumn("_bound", bound).where("_bound IS NULL OR _near <= _bound * (1 + 1e-9) + 1e-15")
    return down.select("_q", "lat", "lon", *[f"_{a}" for a in AXES], F.col("node").alias("leaf"))


def read_wkb(blob: bytes) -> list[dict[str, float]]:
    """Edges of a (multi)polygon in well-known binary, holes included."""
    edges: list[dict[str, float]] = []

    def geometry(at: int) -> int:
        order = "<" if blob[at] == 1 else ">"
        kind, count = struct.unpack_from(order + "II", blob, at + 1)
        at += 9
        if kind == 6:
            for _ in range(count):
                at = geometry(at)
            return at
        if kind != 3:
            raise ValueError(f"not a polygon: geometry type {kind}")
        for _ in range(count):
            (n,) = struct.unpack_from(order + "I", blob, at)
            xy = struct.unpack_from(f"{order}{2 * n}d", blob, at + 4)
            at += 4 + 16 * n
            ring = list(zip(xy[0::2], xy[1::2]))
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                edges.append({"x1": x1, "y1": y1, "x2": x2, "y2": y2})
        return at

    geometry(0)
    return edges


@F.pandas_udf(EDGES)
def wkb_edges(blobs: pd.Series) -> pd.Series:
    return blobs.map(lambda b: None if b is None else read_wkb(bytes(b)))


def points_in_regions(
    points: DataFrame, regions: DataFrame, region_id: str, wkb: str, cell_degrees: float = 0.05
) -> DataFrame:
    """Rows of ``points`` (lat, lon) with the id of every region that contains them.

    A region's bounding box is cut into grid cells. Every cell has the edges that a ray from
    inside it towards +x can meet, one row each. Points join on the cell; an odd number of
    crossings means inside, so holes need no special case.
    """
    g = cell_degrees
    decoded = regions.select(region_id, wkb_edges(F.col(wkb)).alias("_e")).where(F.size("_e") > 0)
    left = F.array_min(F.transform("_e", lambda e: F.least(e.x1, e.x2)))
    edges = decoded.withColumn("x0", left).select(region_id, "x0", F.explode("_e").alias("e")).select(region_id, "x0", "e.*")
    # an edge matters to all cells of its rows from the box's left side to its own right end
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    cells = (
        edges.where("y1 <> y2")
        .withColumn("_cy", F.explode(F.sequence(F.floor(low / g), F.floor(high / g))))
        .withColumn("_cx", F.explode(F.sequence(F.floor(F.col("x0") / g), F.floor(F.greatest("x1", "x2") / g))))
        .drop("x0")
    )
    x, y = F.col("lon"), F.col("lat")
    crossed = ((F.col("y1") > y) != (F.col("y2") > y)) & (
        x < (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    )
    # equal places are tested once
    places = points.where("lon IS NOT NULL AND lat IS NOT NULL").select("lon", "lat").distinct()
    keyed = places.withColumns({"_cx": F.floor(x / g), "_cy": F.floor(y / g)})
    hits = keyed.join(broadcast_if_small(cut_lineage(cells)), ["_cx", "_cy"]).where(crossed)
    inside = hits.groupBy("lon", "lat", region_id).count().where("count % 2 = 1").drop("count")
    return points.join(inside, ["lon", "lat"]).select(*points.columns, region_id)


def nearest_others(points: DataFrame, point_id: str, sites: DataFrame, site_id: str, k: int) -> DataFrame:
    """``nearest`` where a site is no neighbour of the point with the same id."""
    got = nearest(points, point_id, sites, site_id, k + 1)
    others = got.where(F.col(point_id) != F.col(site_id)).drop("rank")
    w = Window.partitionBy(point_id).orderBy("metres", site_id)
    return others.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
