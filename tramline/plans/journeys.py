"""Network, journey search and journey options."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline import bindings as B
from tramline.bindings import hms_sql, register_sql
from tramline.operators import journey, quantiles, transit
from tramline.plans.aggregates import QS
from tramline.plans.transit import inside
from tramline.plans.util import bigint, r
from tramline.registry import query
from tramline.session import cut_lineage

HORIZON = 10 * 3600

register_sql(
    "consecutive",
    """SELECT * FROM (SELECT run_id, trip_id, stop_id AS from_stop, lead(stop_id) OVER w AS to_stop, dep_s,
       lead(arr_s) OVER w AS arr_s FROM stop_times WINDOW w AS (PARTITION BY run_id ORDER BY arr_s, event_id))
       WHERE to_stop IS NOT NULL""",
)
register_sql("connections", "SELECT * FROM consecutive WHERE arr_s >= dep_s")


@query("connections", "SELECT run_id, from_stop, to_stop, dep_s, arr_s FROM connections")
def connections(spark, root):
    return journey.connections(B.stop_times(spark, root)).drop("trip_id")


@query(
    "zero_duration_edges",
    "SELECT run_id, from_stop, to_stop, dep_s, arr_s FROM consecutive WHERE arr_s <= dep_s",
)
def zero_duration_edges(spark, root):
    return journey.consecutive(B.stop_times(spark, root)).where("arr_s <= dep_s").drop("trip_id")


@query(
    "segment_durations",
    "SELECT trip_id, from_stop, to_stop, round(avg(arr_s - dep_s), 5) AS mean_s, count(*) AS n FROM connections"
    " GROUP BY 1, 2, 3",
)
def segment_durations(spark, root):
    out = journey.segment_durations(journey.connections(B.stop_times(spark, root)))
    return out.withColumn("mean_s", r("mean_s", 5))


@query(
    "terminal_departures",
    """SELECT stop_id, count(*) AS departures, count(*) - count(n) AS ending, count(n) = 0 AS terminal_only
       FROM (SELECT stop_id, lead(stop_id) OVER (PARTITION BY run_id ORDER BY arr_s, event_id) AS n FROM stop_times)
       GROUP BY stop_id HAVING count(n) < count(*)""",
)
def terminal_departures(spark, root):
    return journey.terminal_stops(B.stop_times(spark, root))


@query(
    "network_stats",
    """SELECT 'nodes' AS measure, count(*) AS value FROM (SELECT from_stop FROM connections UNION SELECT to_stop FROM
       connections UNION SELECT from_stop FROM footpaths UNION SELECT to_stop FROM footpaths) UNION ALL
       SELECT 'stop_pairs', count(DISTINCT (from_stop, to_stop)) FROM connections UNION ALL
       SELECT 'connections', count(*) FROM connections UNION ALL SELECT 'walks', count(*) FROM footpaths UNION ALL
       SELECT 'max_degree', max(d) FROM (SELECT count(DISTINCT to_stop) AS d FROM connections GROUP BY from_stop)""",
)
def network_stats(spark, root):
    return journey.network_stats(
        journey.connections(B.stop_times(spark, root)), transit.footpaths(B.stops(spark, root))
    )


@query(
    "transfer_time",
    """SELECT p.from_stop, p.to_stop, round(CASE WHEN t.m IS NOT NULL THEN CAST(t.m AS DOUBLE) WHEN p.from_stop = p.to_stop
       THEN 120e0 WHEN f.metres <= 500 THEN 120 + f.metres * 60 / 50 END, 3) AS change_s
       FROM (SELECT from_stop, to_stop FROM transfers UNION SELECT from_stop, to_stop FROM footpaths
             UNION SELECT stop_id, stop_id FROM stops) p
       LEFT JOIN (SELECT from_stop, to_stop, min(min_transfer_time) AS m FROM transfers GROUP BY 1, 2) t
       ON t.from_stop = p.from_stop AND t.to_stop = p.to_stop
       LEFT JOIN footpaths f ON f.from_stop = p.from_stop AND f.to_stop = p.to_stop""",
)
def transfer_time(spark, root):
    explicit, stops = B.transfers(spark, root), B.stops(spark, root)
    walks = transit.footpaths(stops)
    own = stops.select(F.col("stop_id").alias("from_stop"), F.col("stop_id").alias("to_stop"))
    on = ["from_stop", "to_stop"]
    pairs = explicit.select(*on).unionByName(walks.select(*on)).unionByName(own)
    return journey.transfer_seconds(pairs, explicit, walks).withColumn("change_s", r("change_s", 3))


@query(
    "transfer_lookup",
    """SELECT from_stop, to_stop, CAST(min_transfer_time AS DOUBLE) AS min_transfer_time FROM transfers
       WHERE from_stop IN (SELECT stop_id FROM stop_regions) AND to_stop IN (SELECT stop_id FROM stop_regions)""",
)
def transfer_lookup(spark, root):
    out = journey.transfers_between(B.transfers(spark, root), inside(spark, root))
    return out.select("from_stop", "to_stop", F.col("min_transfer_time").cast("double").alias("min_transfer_time"))


@query(
    "next_departure",
    """SELECT q.request_id, q.t, min(c.dep_s) AS dep_s FROM (SELECT run_id * 1000000 + dep_s AS request_id, from_stop, to_stop,
       dep_s - 600 AS t FROM (SELECT DISTINCT run_id, from_stop, to_stop, dep_s FROM connections)) q
       JOIN connections c ON c.from_stop = q.from_stop AND c.to_stop = q.to_stop AND c.dep_s >= q.t GROUP BY 1, 2""",
)
def next_departure(spark, root):
    c = journey.connections(B.stop_times(spark, root))
    requests = c.select("run_id", "from_stop", "to_stop", "dep_s").distinct().select(
        (F.col("run_id") * 1000000 + F.col("dep_s")).alias("request_id"), "from_stop", "to_stop",
        (F.col("dep_s") - 600).alias("t"),
    )
    out = journey.next_departure(requests, c)
    return out.groupBy("request_id", "t").agg(F.min("dep_s").alias("dep_s"))


# keyed recursion: one best label per (query, stop, ridden); a round extends all labels by one leg
register_sql(
    "runs",
    """SELECT run_id, stop_id, event_id, trip_id, arr_s, least(dep_s, COALESCE(lead(arr_s) OVER w, dep_s)) AS dep_s,
       row_number() OVER w AS seq FROM stop_times WINDOW w AS (PARTITION BY run_id ORDER BY arr_s, event_id)""",
)
register_sql("arrivals", "SELECT query_id, stop_id, min(reach) AS arrival FROM labels_found GROUP BY 1, 2")
register_sql("ride_pairs", """
   SELECT a.stop_id AS from_stop, b.stop_id AS to_stop, a.dep_s, b.arr_s FROM runs a JOIN runs b
   ON a.run_id = b.run_id AND b.seq > a.seq AND b.arr_s >= a.dep_s""")
register_sql("hops", """
   SELECT from_stop, to_stop, dep_s, arr_s, CAST(NULL AS BIGINT) AS walk_s FROM ride_pairs UNION ALL
   SELECT from_stop, to_stop, NULL, NULL, walk_s FROM footpaths""")


def timetable(spark, root):
    """Stop times with position and line."""
    st = journey.number_stops(B.stop_times(spark, root))
    return st.withColumn("line_id", F.expr("trip_id DIV 2"))


def arrivals(spark, root, times):
    walks = cut_lineage(transit.footpaths(B.stops(spark, root)))
    return journey.earliest_arrival(
        B.journey_queries(spark, root), cut_lineage(timetable(spark, root)), walks, HORIZON, times=times
    )


# kinds of label: 0 origin, 1 after a ride, 2 walked before any ride, 3 walked after a ride
register_sql(
    "labels_found",
    f"""SELECT query_id, source AS stop_id, 0 AS kind, depart_at AS reach, depart_at + {HORIZON} AS horizon
        FROM journey_queries
        UNION
        SELECT n.query_id, n.stop_id, n.kind, min(n.reach), any_value(n.horizon) FROM (
          SELECT l.query_id, h.to_stop AS stop_id, CASE WHEN h.walk_s IS NULL THEN 1 ELSE l.kind + 2 END AS kind,
                 CASE WHEN h.walk_s IS NULL THEN h.arr_s ELSE l.reach + h.walk_s END AS reach, l.horizon
          FROM labels_found l JOIN hops h ON h.from_stop = l.stop_id
          WHERE (h.walk_s IS NULL AND h.dep_s >= l.reach + 120 * (l.kind % 2) AND h.dep_s <= l.horizon
                 AND h.arr_s <= l.horizon)
             OR (h.walk_s IS NOT NULL AND l.kind < 2 AND l.reach + h.walk_s <= l.horizon)) n
        LEFT JOIN recurring.labels_found o ON o.query_id = n.query_id AND o.stop_id = n.stop_id AND o.kind = n.kind
        WHERE o.reach IS NULL OR n.reach < o.reach GROUP BY n.query_id, n.stop_id, n.kind""",
    "(query_id, stop_id, kind, reach, horizon) USING KEY (query_id, stop_id, kind)",
)


# per stop the arrival of each kind; ready is the earliest time to board again
register_sql(
    "label_kinds",
    """SELECT *, least(u, l + 120, k + 120) AS ready FROM (SELECT query_id, stop_id, min(reach) FILTER (WHERE kind IN (0, 2)) AS u,
       min(reach) FILTER (WHERE kind = 1) AS l, min(reach) FILTER (WHERE kind = 3) AS k FROM labels_found GROUP BY 1, 2)""",
)
register_sql(
    "boarding",
    """SELECT query_id, run_id, arg_min(stop_id, seq) AS board, min(seq) AS seq, arg_min(dep_s, seq) AS dep_s
       FROM runs JOIN label_kinds USING (stop_id) WHERE dep_s >= ready GROUP BY 1, 2""",
)
register_sql(
    "walk_from",
    """SELECT g.query_id, g.stop_id, min(z.stop_id) AS z, arg_min(f.walk_s, z.stop_id) AS walk_s FROM label_kinds g
       JOIN footpaths f ON f.to_stop = g.stop_id JOIN label_kinds z ON z.query_id = g.query_id AND z.stop_id = f.from_stop
       WHERE z.l + f.walk_s = g.k GROUP BY 1, 2""",
)
register_sql(
    "ride_steps",
    """SELECT s.query_id, s.stop_id, s.ride_s, y.u = y.ready AS opens, CASE WHEN y.u = y.ready THEN y.u - q.depart_at
              WHEN y.l + 120 = y.ready THEN 0 ELSE w.walk_s END AS walk_s,
              CASE WHEN y.l + 120 = y.ready THEN y.stop_id ELSE w.z END AS parent
       FROM (SELECT g.query_id, g.stop_id, arg_min(b.board, (h.first_dep, r.run_id)) AS board,
                    arg_min(g.l - b.dep_s, (h.first_dep, r.run_id)) AS ride_s
             FROM label_kinds g JOIN runs r ON r.stop_id = g.stop_id AND r.arr_s = g.l
             JOIN boarding b ON b.query_id = g.query_id AND b.run_id = r.run_id AND b.seq < r.seq
             JOIN (SELECT run_id, dep_s AS first_dep FROM runs WHERE seq = 1) h ON h.run_id = r.run_id GROUP BY 1, 2) s
       JOIN label_kinds y ON y.query_id = s.query_id AND y.stop_id = s.board
       JOIN journey_queries q ON q.query_id = s.query_id
       LEFT JOIN walk_from w ON w.query_id = s.query_id AND w.stop_id = s.board""",
)
register_sql(
    "ridden_times",
    """SELECT query_id, stop_id, walk_s, ride_s FROM ride_steps WHERE COALESCE(opens, false) UNION ALL
       SELECT s.query_id, s.stop_id, s.walk_s + t.walk_s, s.ride_s + t.ride_s FROM ride_steps s
       JOIN ridden_times t ON t.query_id = s.query_id AND t.stop_id = s.parent WHERE NOT COALESCE(s.opens, false)""",
)


@query(
    "earliest_arrival",
    """SELECT g.query_id, g.stop_id, least(u, l, k) AS arrival,
       CAST(CASE WHEN u = least(u, l, k) THEN u - depart_at WHEN l = least(u, l, k) THEN t.walk_s ELSE w.walk_s + tz.walk_s END
            AS BIGINT) AS walk_s,
       CAST(CASE WHEN u = least(u, l, k) THEN 0 WHEN l = least(u, l, k) THEN t.ride_s ELSE tz.ride_s END AS BIGINT) AS ride_s
       FROM label_kinds g JOIN journey_queries q USING (query_id)
       LEFT JOIN ridden_times t ON t.query_id = g.query_id AND t.stop_id = g.stop_id
       LEFT JOIN walk_from w ON w.query_id = g.query_id AND w.stop_id = g.stop_id
       LEFT JOIN ridden_times tz ON tz.query_id = g.query_id AND tz.stop_id = w.z""",
)
def earliest_arrival(spark, root):
    return arrivals(spark, root, times=True)


@query(
    "isochrone",
    """SELECT query_id, stop_id, stop_name, lat, lon, (arrival - depart_at) // 900 * 15 AS band_minutes FROM arrivals
       JOIN journey_queries USING (query_id) JOIN stops USING (stop_id)""",
)
def isochrone(spark, root):
    return journey.isochrone(arrivals(spark, root, times=False), B.journey_queries(spark, root), B.stops(spark, root), 15)


def path_requests(spark, root):
    """Requests with a departure time or a latest arrival, at four confidence levels."""
    q = B.journey_queries(spark, root)
    by_arrival = F.col("query_id") % 2 == 1
    level = F.element_at(F.array(*[F.lit(p) for p in QS.values()]), (F.col("query_id") % 4 + 1).cast("int"))
    return q.select(
        "query_id", "source", "target", level.alias("confidence"),
        F.when(~by_arrival, F.col("depart_at")).alias("depart_at"),
        F.when(by_arrival, F.col("depart_at") + 21600).alias("arrive_by"),
    )


def path_options(spark, root, requests):
    delays = quantiles.discrete_quantiles(B.visits(spark, root), ["line_id"], "delay_s", QS).drop("n")
    return journey.robust_paths(
        requests, cut_lineage(timetable(spark, root)), cut_lineage(transit.footpaths(B.stops(spark, root))), delays,
        max_duration=21600, arrive_window=21600,
    )


@query("robust_paths")
def robust_paths(spark, root):
    options = path_options(spark, root, path_requests(spark, root))
    best = journey.diversify(options.withColumn("option_id", F.col("signature")), 3)
    return best.select(
        "query_id", "option_no", "departure", "arrival", "changes", r("walk_m", 1).alias("walk_m"),
        F.coalesce(F.size("legs"), F.lit(0)).alias("n_legs"), F.to_json("legs").alias("legs"),
    )


register_sql(
    "path_requests",
    """SELECT query_id, source, target, start, limit_s, line_id, greatest(CASE WHEN query_id % 4 = 0 THEN q50 WHEN query_id % 4 = 1
              THEN q75 WHEN query_id % 4 = 2 THEN q90 ELSE q95 END, 0) AS late
       FROM (SELECT query_id, source, target, CASE WHEN query_id % 2 = 1 THEN greatest(depart_at, 0) ELSE depart_at END AS start,
             depart_at + 21600 AS limit_s FROM journey_queries),
       (SELECT line_id, quantile_disc(delay_s, 0.5) AS q50, quantile_disc(delay_s, 0.75) AS q75, quantile_disc(delay_s, 0.9) AS q90,
        quantile_disc(delay_s, 0.95) AS q95 FROM visits GROUP BY line_id)""",
)
register_sql(
    "late_rides",
    """SELECT a.stop_id AS from_stop, b.stop_id AS to_stop, a.dep_s, b.arr_s, a.trip_id // 2 AS line_id FROM runs a JOIN runs b
       ON a.run_id = b.run_id AND b.seq > a.seq AND b.arr_s >= a.dep_s""",
)
# kinds as in labels_found; one label per distance walked, the target is not left again
register_sql(
    "robust_found",
    """SELECT DISTINCT query_id, source AS stop_id, 0 AS kind, 0e0 AS walk_m, start AS reach, target, limit_s FROM path_requests
        WHERE source <> target
        UNION
        SELECT n.query_id, n.stop_id, n.kind, n.walk_m, min(n.reach), any_value(n.target), any_value(n.limit_s) FROM (
          SELECT l.query_id, h.to_stop AS stop_id, 1 AS kind, l.walk_m, h.arr_s + q.late AS reach, l.target, l.limit_s
          FROM robust_found l JOIN late_rides h ON h.from_stop = l.stop_id
          JOIN path_requests q ON q.query_id = l.query_id AND q.line_id = h.line_id
          WHERE l.stop_id <> l.target AND h.dep_s >= l.reach + 120 * (l.kind % 2) AND h.dep_s <= l.limit_s AND h.arr_s + q.late <= l.limit_s
          UNION ALL
          SELECT l.query_id, w.to_stop, l.kind + 2, l.walk_m + w.metres, l.reach + w.walk_s, l.target, l.limit_s
          FROM robust_found l JOIN footpaths w ON w.from_stop = l.stop_id
          WHERE l.stop_id <> l.target AND l.kind < 2 AND l.walk_m + w.metres <= 500 AND l.reach + w.walk_s <= l.limit_s) n
        LEFT JOIN recurring.robust_found o ON o.query_id = n.query_id AND o.stop_id = n.stop_id AND o.kind = n.kind
             AND o.walk_m = n.walk_m
        WHERE o.reach IS NULL OR n.reach < o.reach GROUP BY n.query_id, n.stop_id, n.kind, n.walk_m""",
    "(query_id, stop_id, kind, walk_m, reach, target, limit_s) USING KEY (query_id, stop_id, kind, walk_m)",
)


@query(
    "robust_arrival",
    """SELECT query_id, min(reach) AS arrival FROM (SELECT query_id, reach FROM robust_found WHERE stop_id = target UNION ALL
       SELECT query_id, start FROM path_requests WHERE source = target) GROUP BY query_id""",
)
def robust_arrival(spark, root):
    """The earliest arrival of each request at its confidence, over all options of the search."""
    options = path_options(spark, root, path_requests(spark, root))
    return options.groupBy("query_id").agg(F.min("arrival").alias("arrival"))


# ---- operators on given options: four consecutive stops of a run form an option of three legs


def legs(spark, root):
    st = journey.number_stops(B.stop_times(spark, root))
    point = st.select("*", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("j"))
    chains = point.groupBy("run_id", (F.col("seq") - F.col("j")).alias("start")).agg(
        F.sort_array(F.collect_list(F.struct("j", "stop_id", "dep_s", "arr_s", "event_id", "trip_id"))).alias("p")
    ).where(F.size("p") == 4)
    leg = F.transform(
        F.sequence(F.lit(1), F.lit(3)),
        lambda i: F.struct(
            i.alias("leg_no"),
            F.get("p", i - 1).stop_id.alias("from_stop"), F.get("p", i).stop_id.alias("to_stop"),
            F.get("p", i - 1).dep_s.alias("dep_s"), F.get("p", i).arr_s.alias("arr_s"),
        ),
    )
    rows = chains.select(
        F.col("p")[0]["event_id"].alias("option_id"), F.col("run_id").alias("query_id"),
        F.col("p")[0]["trip_id"].alias("trip_id"), F.explode(leg).alias("l"),
    ).select("option_id", "query_id", "trip_id", "l.*")
    n = F.col("option_id") + F.col("leg_no")
    trip = F.col("trip_id") + n % 2
    return rows.select(
        "option_id", "query_id", "leg_no", "from_stop", "to_stop", "dep_s", "arr_s",
        F.when(n % 4 == 0, "WALK").otherwise("PT").alias("kind"), trip.alias("leg_trip"),
        F.floor(trip / 2).alias("line_id"),
    )


register_sql(
    "legs",
    """SELECT c.event_id AS option_id, c.run_id AS query_id, l.leg_no, l.from_stop, l.to_stop, l.dep_s, l.arr_s,
       CASE WHEN (c.event_id + l.leg_no) % 4 = 0 THEN 'WALK' ELSE 'PT' END AS kind,
       c.trip_id + (c.event_id + l.leg_no) % 2 AS leg_trip, (c.trip_id + (c.event_id + l.leg_no) % 2) // 2 AS line_id
       FROM (SELECT event_id, run_id, trip_id, stop_id AS s0, dep_s AS d0, lead(stop_id, 1) OVER w AS s1,
             lead(dep_s, 1) OVER w AS d1, lead(arr_s, 1) OVER w AS a1, lead(stop_id, 2) OVER w AS s2,
             lead(dep_s, 2) OVER w AS d2, lead(arr_s, 2) OVER w AS a2, lead(stop_id, 3) OVER w AS s3,
             lead(arr_s, 3) OVER w AS a3 FROM runs WINDOW w AS (PARTITION BY run_id ORDER BY arr_s, event_id)) c,
       LATERAL (SELECT 1 AS leg_no, s0 AS from_stop, s1 AS to_stop, d0 AS dep_s, a1 AS arr_s
                UNION ALL SELECT 2, s1, s2, d1, a2 UNION ALL SELECT 3, s2, s3, d2, a3) l
       WHERE c.s3 IS NOT NULL""",
)
register_sql(
    "leg_changes",
    """SELECT option_id, count(*) FILTER (WHERE prev <> leg_trip) AS changes FROM (SELECT option_id, leg_trip,
       lag(leg_trip) OVER (PARTITION BY option_id ORDER BY leg_no) AS prev FROM legs WHERE kind = 'PT') GROUP BY option_id""",
)
register_sql(
    "change_slack",
    """SELECT option_id, leg_no, leg_trip, line_id, to_stop, arr_s // 3600 % 24 AS arr_hour, n_dep - arr_s - 120 AS slack FROM (SELECT *,
       lead(leg_trip) OVER w AS n_trip, lead(dep_s) OVER w AS n_dep FROM legs WHERE kind = 'PT'
       WINDOW w AS (PARTITION BY option_id ORDER BY leg_no)) WHERE n_trip IS NOT NULL AND n_trip <> leg_trip""",
)


@query(
    "path_confidence",
    """WITH v AS (SELECT line_id, stop_id, hour(sched) AS h, delay_s FROM visits),
       m AS (SELECT c.option_id, c.leg_no, v.delay_s <= c.slack AS fits, v.stop_id = c.to_stop AS here,
                    v.stop_id = c.to_stop AND v.h = c.arr_hour AS now FROM change_slack c LEFT JOIN v ON v.line_id = c.line_id),
       n AS (SELECT option_id, leg_no, CAST(count(*) FILTER (WHERE fits) AS DOUBLE) AS f1, count(fits) AS n1,
                    CAST(count(*) FILTER (WHERE fits AND here) AS DOUBLE) AS f2, count(*) FILTER (WHERE here) AS n2,
                    CAST(count(*) FILTER (WHERE fits AND now) AS DOUBLE) AS f3, count(*) FILTER (WHERE now) AS n3 FROM m GROUP BY 1, 2),
       p AS (SELECT option_id, CASE WHEN n3 >= 5 THEN f3 / n3 WHEN n2 >= 5 THEN f2 / n2 WHEN n1 > 0 THEN f1 / n1 ELSE 0 END AS p FROM n),
       held AS (SELECT option_id, CASE WHEN min(p) <= 0 THEN 0e0 ELSE exp(sum(CASE WHEN p > 0 THEN ln(p) END)) END AS confidence
                FROM p GROUP BY 1)
       SELECT o.option_id, round(COALESCE(h.confidence, 1e0), 6) AS confidence FROM (SELECT DISTINCT option_id FROM legs) o
       LEFT JOIN held h USING (option_id)""",
)
def path_confidence(spark, root):
    seen = B.visits(spark, root).select("line_id", "stop_id", F.hour("sched").alias("hour"), "delay_s")
    out = journey.option_confidence(legs(spark, root), seen)
    return out.select("option_id", r("confidence").alias("confidence"))


@query(
    "path_replay",
    """WITH checks AS (SELECT option_id, leg_trip, to_stop, slack FROM change_slack UNION ALL
          SELECT option_id, leg_trip, to_stop, 300 FROM (SELECT *, row_number() OVER (PARTITION BY option_id
          ORDER BY leg_no DESC) AS k FROM legs WHERE kind = 'PT') WHERE k = 1),
       actual AS (SELECT trip_id, stop_id, operating_day, max(delay_s) AS late FROM visits GROUP BY 1, 2, 3),
       days AS (SELECT c.option_id, a.operating_day, bool_and(a.late <= c.slack) AS held FROM checks c
                JOIN actual a ON a.trip_id = c.leg_trip AND a.stop_id = c.to_stop GROUP BY 1, 2)
       SELECT option_id, round(avg(CASE WHEN held THEN 1e0 ELSE 0e0 END), 6) AS share, count(*) AS days FROM days GROUP BY 1""",
)
def path_replay(spark, root):
    return journey.replay(legs(spark, root), B.visits(spark, root)).withColumn("share", r("share"))


@query(
    "path_has_loop",
    """SELECT option_id, count(*) FILTER (WHERE prev IS NULL OR prev <> s) > count(DISTINCT s) AS has_loop FROM (
       SELECT option_id, s, lag(s) OVER (PARTITION BY option_id ORDER BY k) AS prev FROM (
       SELECT option_id, 0 AS k, from_stop AS s FROM legs WHERE leg_no = 1 UNION ALL
       SELECT option_id, leg_no, to_stop FROM legs)) GROUP BY option_id""",
)
def path_has_loop(spark, root):
    return journey.has_loop(legs(spark, root))


@query(
    "path_transfers",
    "SELECT option_id, COALESCE(changes, 0) AS changes FROM (SELECT DISTINCT option_id FROM legs)"
    " LEFT JOIN leg_changes USING (option_id)",
)
def path_transfers(spark, root):
    return journey.count_changes(legs(spark, root))


def leg_options(spark, root):
    """One row per option with what the selection needs."""
    item = F.struct("leg_no", "from_stop", "to_stop", "kind", "leg_trip")
    one = legs(spark, root).groupBy("option_id", "query_id").agg(
        F.min_by("dep_s", "leg_no").alias("departure"), F.max_by("arr_s", "leg_no").alias("arrival"),
        F.sort_array(F.collect_list(item)).alias("l"),
    )
    rides = F.transform(F.filter("l", lambda x: x.kind == "PT"), lambda x: x.leg_trip)
    one = one.withColumn("rides", rides)
    differs = F.zip_with("rides", F.slice("rides", F.lit(2), F.size("rides")), lambda a, b: F.coalesce(a != b, F.lit(False)))
    sign = F.transform("l", lambda x: F.concat_ws(":", x.from_stop, x.to_stop, x.kind, x.leg_trip))
    return cut_lineage(
        one.select(
            "option_id", "query_id", "departure", "arrival",
            F.size(F.filter(differs, lambda x: x)).alias("changes"),
            F.array_join(F.slice("rides", 1, 2), ",").alias("first_trips"),
            F.array_join(sign, ";").alias("signature"),
        )
    )


register_sql(
    "options",
    """SELECT option_id, query_id, arg_min(dep_s, leg_no) AS departure, arg_max(arr_s, leg_no) AS arrival,
       COALESCE(array_to_string(list(leg_trip ORDER BY leg_no) FILTER (WHERE kind = 'PT')[1:2], ','), '') AS first_trips,
       string_agg(from_stop || ':' || to_stop || ':' || kind || ':' || leg_trip, ';' ORDER BY leg_no) AS signature,
       COALESCE(any_value(c.changes), 0) AS changes FROM legs LEFT JOIN leg_changes c USING (option_id) GROUP BY 1, 2""",
)


@query(
    "path_diversify",
    """WITH a AS (SELECT *, row_number() OVER (PARTITION BY query_id, departure // 900, changes, first_trips
            ORDER BY arrival, departure, changes, option_id) = 1 AS first FROM options),
       b AS (SELECT *, first AND row_number() OVER (PARTITION BY query_id, first
            ORDER BY arrival, departure, changes, option_id) <= 3 AS chosen FROM a),
       c AS (SELECT *, bool_or(chosen) OVER (PARTITION BY query_id, signature) AS taken, row_number() OVER
            (PARTITION BY query_id, signature ORDER BY arrival, departure, changes, option_id) AS sn FROM b),
       d AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY chosen DESC, arrival, departure, changes,
            option_id) AS pick FROM c WHERE chosen OR (NOT taken AND sn = 1))
       SELECT query_id, option_id, row_number() OVER (PARTITION BY query_id ORDER BY arrival, departure, changes,
       option_id) AS option_no FROM d WHERE pick <= 3""",
)
def path_diversify(spark, root):
    return journey.diversify(leg_options(spark, root), 3).select("query_id", "option_id", "option_no")


@query(
    "path_same_stop",
    "SELECT query_id, depart_at AS departure, depart_at AS arrival, 0e0 AS walk_m, 0 AS n_legs FROM journey_queries"
    " WHERE source = target",
)
def path_same_stop(spark, root):
    options = path_options(spark, root, path_requests(spark, root).where("source = target"))
    return options.select("query_id", "departure", "arrival", "walk_m", F.coalesce(F.size("legs"), F.lit(0)).alias("n_legs"))


@query(
    "path_long_query",
    """SELECT query_id, abs(b.lat - a.lat) + abs(b.lon - a.lon) > 0.05 AS is_long FROM journey_queries
       JOIN stops a ON a.stop_id = source JOIN stops b ON b.stop_id = target""",
)
def path_long_query(spark, root):
    return journey.long_queries(B.journey_queries(spark, root), B.stops(spark, root), 0.05)


@query(
    "path_format",
    f"""SELECT option_id, leg_no, kind, a.stop_name AS from_name, b.stop_name AS to_name, {hms_sql('dep_s')} AS departs,
        {hms_sql('arr_s')} AS arrives, round((arr_s - dep_s) / 60e0, 6) AS minutes,
        first_value(COALESCE(a.stop_name, '?')) OVER w || string_agg(' -' || kind || '- ' || COALESCE(b.stop_name, '?'), '') OVER w
        AS summary FROM legs
        LEFT JOIN stops a ON a.stop_id = from_stop LEFT JOIN stops b ON b.stop_id = to_stop
        WINDOW w AS (PARTITION BY option_id ORDER BY leg_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def path_format(spark, root):
    out = journey.format_legs(legs(spark, root), B.stops(spark, root))
    return out.withColumns({"leg_no": bigint("leg_no"), "minutes": r("minutes")})
