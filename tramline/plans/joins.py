"""Joins: plain, spatial and in time."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import functions as F

from tramline import bindings as B
from tramline.bindings import haversine_sql, register_sql
from tramline.operators import joins, nearest, shaping, spatial
from tramline.plans.util import bigint, r
from tramline.registry import query
from tramline.session import broadcast_if_small, cut_lineage, scratch_path, table
from tramline.sources import readers


@query(
    "join_inner_using",
    "SELECT route_id, trip_id, route_type, operator_id FROM trips JOIN routes USING (route_id)",
)
def join_inner_using(spark, root):
    j = B.trips(spark, root).join(B.routes(spark, root), "route_id")
    return j.select("route_id", "trip_id", "route_type", "operator_id")


@query(
    "join_inner_on",
    "SELECT o.o_orderkey, o.o_totalprice, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"
    " WHERE c.c_acctbal > 5000",
)
def join_inner_on(spark, root):
    o, c = table(spark, root, "orders").alias("o"), table(spark, root, "customer").alias("c")
    j = o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey")).where("c.c_acctbal > 5000")
    return j.select("o.o_orderkey", "o.o_totalprice", "c.c_name")


@query(
    "join_left_flag",
    "SELECT stop_id, stop_name, stop_id IN (SELECT stop_id FROM visits) AS matched FROM stops",
)
def join_left_flag(spark, root):
    out = joins.left_with_flag(B.stops(spark, root), B.visits(spark, root), ["stop_id"])
    return out.select("stop_id", "stop_name", "matched")


@query(
    "join_left",
    """SELECT v.event_id, s.stop_name, r.route_type, CAST(t.min_s AS DOUBLE) AS min_s FROM visits v
       LEFT JOIN stops s ON s.stop_id = v.stop_id LEFT JOIN routes r ON r.route_id = v.line_id
       LEFT JOIN (SELECT from_stop, min(min_transfer_time) AS min_s FROM transfers GROUP BY 1) t
       ON t.from_stop = v.stop_id""",
)
def join_left(spark, root):
    v = B.visits(spark, root).select("event_id", "stop_id", F.col("line_id").alias("route_id"))
    t = B.transfers(spark, root).groupBy(F.col("from_stop").alias("stop_id")).agg(
        F.min("min_transfer_time").cast("double").alias("min_s")
    )
    out = v.join(B.stops(spark, root), "stop_id", "left").join(B.routes(spark, root), "route_id", "left")
    return out.join(t, "stop_id", "left").select("event_id", "stop_name", "route_type", "min_s")


_HALF = "SELECT user_id, day(ts) AS d, count(*) AS n FROM events WHERE event_type = '{}' GROUP BY 1, 2"


@query(
    "join_full",
    f"""SELECT COALESCE(a.user_id, b.user_id) AS user_id, COALESCE(a.d, b.d) AS d,
        CAST(a.n AS DOUBLE) AS clicks, CAST(b.n AS DOUBLE) AS views FROM ({_HALF.format('click')}) a
        FULL JOIN ({_HALF.format('view')}) b ON a.user_id = b.user_id AND a.d = b.d""",
)
def join_full(spark, root):
    e = table(spark, root, "events").select("user_id", bigint(F.dayofmonth("ts")).alias("d"), "event_type")

    def side(kind, name):
        return e.where(F.col("event_type") == kind).groupBy("user_id", "d").agg(
            F.count(F.lit(1)).cast("double").alias(name)
        )

    return side("click", "clicks").join(side("view", "views"), ["user_id", "d"], "full")


@query(
    "join_all_hows",
    """WITH a AS (SELECT DISTINCT user_id * 1000 + hour(ts) // 2 * 2 AS k FROM events),
            b AS (SELECT DISTINCT user_id * 1000 + hour(ts) // 3 * 3 AS k FROM events)
       SELECT 'inner' AS how, count(*) AS n FROM a JOIN b USING (k) UNION ALL
       SELECT 'left', count(*) FROM a LEFT JOIN b USING (k) UNION ALL
       SELECT 'right', count(*) FROM a RIGHT JOIN b USING (k) UNION ALL
       SELECT 'outer', count(*) FROM a FULL JOIN b USING (k)""",
)
def join_all_hows(spark, root):
    e = table(spark, root, "events")
    a = e.select(F.expr("user_id * 1000 + hour(ts) DIV 2 * 2").alias("k")).distinct()
    b = e.select(F.expr("user_id * 1000 + hour(ts) DIV 3 * 3").alias("k")).distinct()
    met = a.withColumn("_a", F.lit(1)).join(b.withColumn("_b", F.lit(1)), "k", "outer")
    counts = {
        "inner": F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()), "left": F.count("_a"), "right": F.count("_b"),
        "outer": F.count(F.lit(1)),
    }
    one = met.agg(*[n.alias(how) for how, n in counts.items()])
    return one.unpivot([], list(counts), "how", "n")


@query("join_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT stop_id FROM visits WHERE failed)")
def join_semi(spark, root):
    failed = B.visits(spark, root).where("failed").select(F.col("stop_id").alias("c_custkey"))
    return table(spark, root, "customer").join(failed, "c_custkey", "left_semi").select("c_custkey", "c_name")


_UNPLANNED = "SELECT DISTINCT stop_id FROM visits WHERE unplanned"
_FAILED = "SELECT DISTINCT stop_id FROM visits WHERE failed"


@query("keys_only_left", f"({_UNPLANNED}) EXCEPT ({_FAILED})")
def keys_only_left(spark, root):
    v = B.visits(spark, root)
    return joins.keys_only_in(v.where("unplanned"), v.where("failed"), "stop_id")


@query("keys_only_right", f"({_FAILED}) EXCEPT ({_UNPLANNED})")
def keys_only_right(spark, root):
    v = B.visits(spark, root)
    return joins.keys_only_in(v.where("failed"), v.where("unplanned"), "stop_id")


@query(
    "join_multi_key",
    """SELECT v.event_id, q.n FROM (SELECT event_id, line_id, stop_id, hour(sched) AS h FROM visits) v
       JOIN (SELECT line_id, stop_id, hour(sched) AS h, count(*) AS n FROM visits GROUP BY 1, 2, 3) q
       USING (line_id, stop_id, h)""",
)
def join_multi_key(spark, root):
    v = B.visits(spark, root).select("event_id", "line_id", "stop_id", F.hour("sched").alias("h"))
    q = v.groupBy("line_id", "stop_id", "h").agg(F.count(F.lit(1)).alias("n"))
    return v.join(q, ["line_id", "stop_id", "h"]).select("event_id", "n")


@query(
    "join_star",
    """SELECT n.n_name, p.p_brand, count(*) AS lines, round(sum(l.l_extendedprice * (1 - l.l_discount)), 4) AS revenue
       FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
       JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN part p ON p.p_partkey = l.l_partkey
       WHERE o.o_orderdate >= TIMESTAMP '1996-01-01' AND l.l_shipdate >= TIMESTAMP '1996-06-01'
       GROUP BY 1, 2""",
)
def join_star(spark, root):
    li = table(spark, root, "lineitem").where(F.col("l_shipdate") >= F.lit("1996-06-01").cast("timestamp_ntz"))
    o = table(spark, root, "orders").where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    c, n, p = (table(spark, root, t) for t in ("customer", "nation", "part"))
    j = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .join(p, li.l_partkey == p.p_partkey)
    )
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return j.groupBy("n_name", "p_brand").agg(F.count(F.lit(1)).alias("lines"), r(revenue, 4).alias("revenue"))


@query(
    "join_broadcast",
    "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON n_nationkey = c_nationkey"
    " JOIN region ON r_regionkey = n_regionkey",
)
def join_broadcast(spark, root):
    c, n, g = (table(spark, root, t) for t in ("customer", "nation", "region"))
    dims = broadcast_if_small(n.join(g, n.n_regionkey == g.r_regionkey).select("n_nationkey", "n_name", "r_name"))
    return c.join(dims, c.c_nationkey == dims.n_nationkey).select("c_custkey", "n_name", "r_name")


@query(
    "join_cross_filter",
    f"SELECT a.station_id, b.stop_id, round({haversine_sql('a', 'b')}, 3) AS metres FROM stations a, stops b"
    f" WHERE {haversine_sql('a', 'b')} <= 800",
)
def join_cross_filter(spark, root):
    """Distance filter over the product of two tables, answered without the product."""
    pairs = spatial.pairs_within(
        B.stations(spark, root).drop("station_name"), B.stops(spark, root).select("stop_id", "lat", "lon"), 800.0
    )
    return pairs.select("station_id", "stop_id", r("metres", 3).alias("metres"))


@query(
    "join_distance",
    f"SELECT a.stop_id AS stop_a, b.stop_id AS stop_b, round({haversine_sql('a', 'b')}, 3) AS metres"
    f" FROM stops a JOIN stops b ON a.stop_id <> b.stop_id AND {haversine_sql('a', 'b')} <= 500",
)
def join_distance(spark, root):
    s = B.stops(spark, root).select("stop_id", "lat", "lon")
    pairs = spatial.pairs_within(
        s.withColumnRenamed("stop_id", "stop_a"), s.withColumnRenamed("stop_id", "stop_b"), 500.0
    )
    return pairs.where("stop_a <> stop_b").select("stop_a", "stop_b", r("metres", 3).alias("metres"))


# One region per row of ``region``: a concave outer ring with a square hole.
# Offsets from the region's corner, in degrees (lon, lat).
RING = [(0.0, 0.0), (0.04, 0.0), (0.04, 0.05), (0.02, 0.02), (0.0, 0.05), (0.0, 0.0)]
HOLE = [(0.005, 0.005), (0.012, 0.005), (0.012, 0.012), (0.005, 0.012), (0.005, 0.005)]


def region_shapes(spark, root):
    """Regions with their polygon in well-known binary."""

    @F.pandas_udf("binary")
    def polygon(key: pd.Series) -> pd.Series:
        def one(k: int) -> bytes:
            out = struct.pack("<BII", 1, 3, 2)
            for ring in (RING, HOLE):
                out += struct.pack("<I", len(ring))
                for x, y in ring:
                    out += struct.pack("<2d", (6.55 + k / 100.0) + x, (46.50 + k / 100.0) + y)
            return out

        return key.map(one)

    g = table(spark, root, "region")
    return g.select(F.col("r_name").alias("region"), polygon("r_regionkey").alias("wkb"))


def _edges_sql() -> str:
    rows = []
    for ring in (RING, HOLE):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            rows.append(f"({x1}e0, {y1}e0, {x2}e0, {y2}e0)")
    corner_x, corner_y = "(6.55e0 + r_regionkey / 100e0)", "(46.50e0 + r_regionkey / 100e0)"
    return (
        f"SELECT r_name AS region, {corner_x} + a AS x1, {corner_y} + b AS y1, {corner_x} + c AS x2,"
        f" {corner_y} + d AS y2 FROM region, (VALUES {', '.join(rows)}) v(a, b, c, d)"
    )


register_sql("region_edges", _edges_sql())
register_sql(
    "stop_regions",
    """SELECT stop_id, region FROM stops, region_edges
       WHERE (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1
       GROUP BY stop_id, region HAVING count(*) % 2 = 1""",
)


@query("join_point_in_polygon", "SELECT stop_id, region FROM stop_regions")
def join_point_in_polygon(spark, root):
    s = B.stops(spark, root).select("stop_id", "lat", "lon")
    return spatial.points_in_regions(s, region_shapes(spark, root), "region", "wkb").select("stop_id", "region")


register_sql(
    "stop_station",
    f"""SELECT stop_id, station_id, metres FROM (
        SELECT a.stop_id, b.station_id, {haversine_sql('a', 'b')} AS metres, row_number() OVER
        (PARTITION BY a.stop_id ORDER BY {haversine_sql('a', 'b')}, b.station_id) AS rn FROM stops a, stations b)
        WHERE rn = 1""",
)


def stop_station(spark, root):
    """The nearest weather station of every stop."""
    return spatial.nearest(
        B.stops(spark, root).select("stop_id", "lat", "lon"), "stop_id",
        B.stations(spark, root).select("station_id", "lat", "lon"), "station_id",
    )


@query("join_nearest_point", "SELECT stop_id, station_id, round(metres, 3) AS metres FROM stop_station")
def join_nearest_point(spark, root):
    return stop_station(spark, root).select("stop_id", "station_id", r("metres", 3).alias("metres"))


@query(
    "join_knn_excluding",
    f"""SELECT site, neighbour, rank, round(metres / 1000, 6) AS km FROM (
        SELECT a.station_id AS site, b.station_id AS neighbour, {haversine_sql('a', 'b')} AS metres,
        row_number() OVER (PARTITION BY a.station_id ORDER BY {haversine_sql('a', 'b')}, b.station_id) AS rank
        FROM stations a JOIN stations b ON a.station_id <> b.station_id
        WHERE b.station_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)) WHERE rank <= 5""",
)
def join_knn_excluding(spark, root):
    sites = B.stations(spark, root).select(F.col("station_id").alias("site"), "lat", "lon")
    bad = table(spark, root, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("neighbour"))
    good = sites.withColumnRenamed("site", "neighbour").join(bad, "neighbour", "left_anti")
    out = spatial.nearest_others(sites, "site", good, "neighbour", k=5)
    return out.select("site", "neighbour", "rank", r(F.col("metres") / 1000).alias("km"))


register_sql(
    "visit_weather",
    """SELECT v.event_id, v.stop_id, v.delay_s, s.station_id, v.t, w.reading_id, w.temp, w.precip
       FROM (SELECT *, CAST(epoch(sched) AS BIGINT) AS t FROM visits) v
       JOIN stop_station s ON s.stop_id = v.stop_id
       LEFT JOIN LATERAL (SELECT * FROM weather w WHERE w.station_id = s.station_id AND abs(w.t - v.t) <= 3600
                          ORDER BY abs(w.t - v.t), w.t LIMIT 1) w ON TRUE""",
)


def visit_weather(spark, root):
    """Visits with the reading of their nearest station nearest in time (within an hour)."""
    from tramline.functions.timefn import epoch_seconds

    v = B.visits(spark, root).select("event_id", "stop_id", "delay_s", epoch_seconds("sched").alias("t"))
    near = stop_station(spark, root).select("stop_id", "station_id")
    return nearest.nearest_in_time(v.join(near, "stop_id"), B.weather(spark, root), "station_id", "t", 3600)


@query(
    "join_nearest_time",
    "SELECT event_id, station_id, reading_id IS NOT NULL AS matched, CAST(reading_id AS DOUBLE) AS reading_id"
    " FROM visit_weather",
)
def join_nearest_time(spark, root):
    return visit_weather(spark, root).select(
        "event_id", "station_id", "matched", F.col("reading_id").cast("double").alias("reading_id")
    )


@query(
    "join_by_row_id",
    "SELECT event_id, round(value * 2, 6) AS a, round(value + 1, 6) AS b FROM events",
)
def join_by_row_id(spark, root):
    """Two written prediction sets without a common column meet by the places of their rows."""
    e = cut_lineage(table(spark, root, "events").select("event_id", "value"))
    first, second = scratch_path(spark, "first"), scratch_path(spark, "second")
    e.select("event_id", r(F.col("value") * 2).alias("a")).write.parquet(first)
    e.select(r(F.col("value") + 1).alias("b")).write.parquet(second)
    both = readers.read_with_row_id(spark, first).join(readers.read_with_row_id(spark, second), "row_id")
    return both.select("event_id", "a", "b")


@query(
    "align_columns",
    "SELECT s_suppkey AS id, s_acctbal, c_acctbal FROM supplier JOIN customer ON s_suppkey = c_custkey",
)
def align_columns(spark, root):
    s = table(spark, root, "supplier").select(F.col("s_suppkey").alias("id"), "s_acctbal")
    c = table(spark, root, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    return s.join(c, "id")


@query(
    "key_overlap_report",
    """WITH a AS (SELECT DISTINCT stop_id AS k FROM visits),
            b AS (SELECT DISTINCT CAST(regexp_extract(stop_code, '[0-9]+') AS BIGINT) AS k FROM stops),
            c AS (SELECT DISTINCT from_stop AS k FROM transfers)
       SELECT (SELECT count(*) FROM a) AS visits, (SELECT count(*) FROM b) AS stops,
              (SELECT count(*) FROM c) AS transfers,
              (SELECT count(*) FROM a JOIN b USING (k) JOIN c USING (k)) AS in_all""",
)
def key_overlap_report(spark, root):
    from tramline.functions.text import first_number

    return joins.key_overlap(
        {
            "visits": B.visits(spark, root).select(F.col("stop_id").alias("k")),
            "stops": B.stops(spark, root).select(first_number("stop_code").alias("k")),
            "transfers": B.transfers(spark, root).select(F.col("from_stop").alias("k")),
        },
        "k",
    )


@query(
    "name_match_sample",
    "SELECT DISTINCT c_custkey, s_suppkey, lower(trim(split_part(c_name, '#', 2))) AS name FROM customer JOIN supplier"
    " ON lower(trim(split_part(c_name, '#', 2))) = lower(trim(split_part(s_name, '#', 2)))"
    " ORDER BY c_custkey LIMIT 50",
)
def name_match_sample(spark, root):
    def norm(c):
        return F.lower(F.trim(F.split_part(c, F.lit("#"), F.lit(2)))).alias("name")

    c = table(spark, root, "customer").select("c_custkey", norm("c_name"))
    s = table(spark, root, "supplier").select("s_suppkey", norm("s_name"))
    return c.join(s, "name").distinct().orderBy("c_custkey").limit(50)
