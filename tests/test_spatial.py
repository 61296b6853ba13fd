"""Grid joins against brute force, polygons with holes, nearest in time."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from tramline.operators import nearest, spatial
from tramline.operators.transit import footpaths


def dist(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371000 * math.asin(math.sqrt(min(1.0, h)))


@pytest.fixture(scope="module")
def places():
    rng = random.Random(5)
    near = [(46.5 + rng.random() / 20, 6.5 + rng.random() / 20) for _ in range(150)]
    far = [(rng.uniform(-70, 80), rng.uniform(-180, 180)) for _ in range(60)]
    edge = [(10.0 + i / 1000, 179.999 - i / 10000) for i in range(4)] + [(10.0 + i / 1000, -179.999) for i in range(4)]
    poles = [(84.0 + i / 50, 20.0 * i) for i in range(10)] + [(89.5, 10.0), (89.5, -170.0), (89.9, 100.0), (-90.0, 0.0), (-90.0, 77.0), (-89.99, 5.0)]
    return near + far + edge + poles + [near[0]] * 20


def frame(spark, pts, name):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pts)], f"{name} bigint, lat double, lon double")


@pytest.mark.parametrize("metres", [300.0, 1500.0, 400_000.0, 3_000_000.0])
def test_pairs_within(spark, places, metres):
    got = spatial.pairs_within(frame(spark, places, "a"), frame(spark, places, "b"), metres)
    pairs = [(r.a, r.b) for r in got.collect()]
    expected = {
        (i, j) for i, p in enumerate(places) for j, q in enumerate(places) if dist(p, q) <= metres - 1e-6
    }
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == expected


@pytest.mark.parametrize("k", [1, 4])
def test_nearest(spark, places, k):
    sites = places[::3]
    got = spatial.nearest(frame(spark, places, "p"), "p", frame(spark, sites, "s"), "s", k).collect()
    assert len(got) == k * len(places)
    for i, p in enumerate(places):
        best = sorted((dist(p, q), j) for j, q in enumerate(sites))[:k]
        mine = sorted((r["rank"], r.metres) for r in got if r.p == i)
        assert [round(m, 3) for _, m in mine] == [round(d, 3) for d, _ in best]


def test_nearest_with_fewer_sites_than_k(spark, places):
    got = spatial.nearest(frame(spark, places[:5], "p"), "p", frame(spark, places[5:7], "s"), "s", 3)
    assert got.count() == 10
    assert spatial.nearest(frame(spark, places[:5], "p"), "p", frame(spark, places[:1], "s").where("s < 0"), "s").count() == 0


def met_rows(spark, points, sites, k):
    """(place, leaf) rows that a search ends with, and its result."""
    seen, step = [], spatial._step_down

    def counted(met, level, k):
        out = spatial.cut_lineage(step(met, level, k))
        seen.append(out.count())
        return out

    spatial._step_down = counted
    try:
        return spatial.nearest(points, "p", sites, "s", k).collect(), seen
    finally:
        spatial._step_down = step


def test_crowded_and_lonely_places_meet_few_leaves(spark):
    """A city of very many sites in one small cell, and points in it, near it and a continent away."""
    crowd = spark.range(40_000).select(
        F.col("id").alias("s"), (F.lit(46.5) + F.rand(1) / 1000).alias("lat"), (F.lit(6.6) + F.rand(2) / 1000).alias("lon")
    )
    spots = [(0, 46.5005, 6.6005), (1, 46.6, 6.7), (2, -33.9, 151.2), (3, 46.5, -173.4), (4, 90.0, 0.0)]
    spots += [(10 + i, 46.5 + i / 1e5, 6.6 + i / 1e5) for i in range(100)]
    points = spark.createDataFrame(spots, "p int, lat double, lon double")
    sites = spatial.cut_lineage(crowd)
    got, seen = met_rows(spark, points, sites, 3)
    assert max(seen) < 40 * len(spots)
    all_sites = [(r.s, r.lat, r.lon) for r in sites.collect()]
    for p, lat, lon in spots[:5]:
        best = sorted(dist((lat, lon), (a, b)) for _, a, b in all_sites)[:3]
        mine = sorted(r.metres for r in got if r.p == p)
        assert len(mine) == 3 and all(abs(a - b) < 1e-3 for a, b in zip(mine, best))


def test_many_sites_at_one_place_and_missing_coordinates(spark):
    sites = spark.createDataFrame([(i, 10.0, 20.0) for i in range(500)] + [(900, None, 1.0)], "s int, lat double, lon double")
    points = spark.createDataFrame([(1, 10.0, 20.0), (2, None, 5.0), (3, -10.0, -160.0)], "p int, lat double, lon double")
    got = sorted((r.p, r["rank"], r.s) for r in spatial.nearest(points, "p", sites, "s", 2).collect())
    assert got == [(1, 1, 0), (1, 2, 1), (3, 1, 0), (3, 2, 1)]


def wkb(rings, order="<"):
    out = struct.pack(order + "BII", 1 if order == "<" else 0, 3, len(rings))
    for ring in rings:
        out += struct.pack(order + "I", len(ring)) + b"".join(struct.pack(order + "2d", *p) for p in ring)
    return out


RING = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.5, 0.4), (0.0, 1.0), (0.0, 0.0)]
HOLE = [(0.1, 0.1), (0.3, 0.1), (0.3, 0.3), (0.1, 0.3), (0.1, 0.1)]


def inside(x, y, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def test_points_in_regions(spark):
    rng = random.Random(1)
    pts = [(rng.uniform(-0.2, 2.2), rng.uniform(-0.2, 1.2)) for _ in range(400)]
    moved = [[(x + 1.05, y) for x, y in RING]]
    multi = struct.pack("<BII", 1, 6, 2) + wkb([RING, HOLE]) + wkb(moved)
    shapes = spark.createDataFrame(
        [("plain", wkb([RING, HOLE])), ("big_endian", wkb([RING, HOLE], ">")), ("multi", multi)], "region string, wkb binary"
    )
    df = spark.createDataFrame([(i, y, x) for i, (x, y) in enumerate(pts)], "id bigint, lat double, lon double")
    for cell in (0.05, 0.7):
        got = {(r.region, r.id) for r in spatial.points_in_regions(df, shapes, "region", "wkb", cell).collect()}
        want = set()
        for i, (x, y) in enumerate(pts):
            if inside(x, y, [RING, HOLE]):
                want |= {("plain", i), ("big_endian", i), ("multi", i)}
            elif inside(x, y, moved):
                want.add(("multi", i))
        assert got == want


def test_footpaths_are_directed_once(spark, places):
    got = footpaths(frame(spark, places[:150], "stop_id")).collect()
    pairs = {(r.from_stop, r.to_stop) for r in got}
    assert len(pairs) == len(got)
    assert {(b, a) for a, b in pairs} == pairs
    assert all(r.walk_s == math.ceil(r.metres * 60 / 50) for r in got)


@pytest.mark.parametrize("limit", [15, 10**6])
def test_nearest_in_time(spark, limit):
    rng = random.Random(9)
    events = [(i, "hot" if i % 3 else "b", rng.randrange(5000)) for i in range(200)]
    reads = sorted({("hot" if i % 2 else "b", rng.randrange(5000)) for i in range(60)})
    ev = spark.createDataFrame(events, "id bigint, s string, t bigint")
    rd = spark.createDataFrame([(s, t, i) for i, (s, t) in enumerate(reads)], "s string, t bigint, rid bigint")
    got = {r.id: r for r in nearest.nearest_in_time(ev, rd, "s", "t", 60, limit).collect()}
    assert len(got) == len(events)
    for i, s, t in events:
        near = sorted((abs(u - t), u) for z, u in reads if z == s and abs(u - t) <= 60)
        assert got[i].matched == bool(near)
        assert got[i].reading_t == (near[0][1] if near else None)


def stored_stops(spark, tmp_path):
    """Stops as a small file, whose size would let the planner collect them."""
    rows = spark.range(400).selectExpr("id AS stop_id", "46.5 + id % 20 / 1000 AS lat", "6.5 + id DIV 20 / 1000 AS lon")
    rows.selectExpr("stop_id", "CAST(lat AS DOUBLE) AS lat", "CAST(lon AS DOUBLE) AS lon").write.parquet(f"{tmp_path}/stops")
    return spark.read.parquet(f"{tmp_path}/stops")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_footpaths_send_no_copies_to_the_driver(spark, tmp_path):
    stops = stored_stops(spark, tmp_path)
    walks = footpaths(stops)
    assert "Broadcast" not in plan(walks)
    at = [(r.stop_id, (r.lat, r.lon)) for r in stops.collect()]
    near = {(i, j) for i, p in at for j, q in at if i != j and dist(p, q) <= 500}
    assert sorted((r.from_stop, r.to_stop) for r in walks.collect()) == sorted(near)


def test_join_distance_with_a_small_side_sends_no_copies_to_the_driver(spark, tmp_path):
    stops = stored_stops(spark, tmp_path)
    a, b = (stops.withColumnRenamed("stop_id", c) for c in ("stop_a", "stop_b"))
    pairs = spatial.pairs_within(a.where("stop_a < 50"), b, 500.0)
    assert "Broadcast" not in plan(pairs)
    assert pairs.where("stop_a = stop_b AND metres = 0").count() == 50
