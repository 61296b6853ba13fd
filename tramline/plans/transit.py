"""Transit operators on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline import bindings as B
from tramline.bindings import haversine_sql, register_sql
from tramline.functions.timefn import local_time
from tramline.operators import aggregates, quantiles, shaping, transit
from tramline.plans.aggregates import QS
from tramline.plans.joins import region_shapes, visit_weather
from tramline.plans.util import bigint, r
from tramline.registry import query
from tramline.session import scratch_path
from tramline.sources import readers, writers

DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
_Q_SQL = ", ".join(f"quantile_disc({{0}}, {p}) AS {q}" for q, p in QS.items())


@query(
    "stop_key_normalise",
    "SELECT stop_id, stop_code, CAST(regexp_extract(stop_code, '[0-9]+') AS BIGINT) AS stop_key FROM stops",
)
def stop_key_normalise(spark, root):
    return B.stops(spark, root).select("stop_id", "stop_code", transit.normalise_stop_key("stop_code").alias("stop_key"))


def stop_versions(spark, root):
    """Every stop in two weekly publications."""
    two = B.stops(spark, root).withColumn("_i", F.explode(F.array(F.lit(0), F.lit(1))))
    return two.select(
        "stop_id", "stop_code", "lat", "lon", F.concat("stop_name", F.lit(" v"), "_i").alias("stop_name"),
        F.when(F.col("_i") == 0, "2024-07-01").otherwise("2024-07-08").alias("pub_date"),
    )


@query(
    "region_stops",
    """SELECT r.region, s.stop_id AS stop_key, '2024-07-08' AS pub_date, s.stop_name || ' v1' AS stop_name, s.lat, s.lon
       FROM stop_regions r JOIN stops s USING (stop_id)""",
)
def region_stops(spark, root):
    return transit.region_stops(stop_versions(spark, root), region_shapes(spark, root))


def inside(spark, root):
    """Stops in any region."""
    from tramline.operators.spatial import points_in_regions

    s = B.stops(spark, root).select("stop_id", "lat", "lon")
    return points_in_regions(s, region_shapes(spark, root), "region", "wkb").select("region", "stop_id")


@query(
    "realtime_coverage",
    """SELECT region, count(*) AS stops, count(*) FILTER (WHERE NOT seen) AS without_visits,
       round(avg(CASE WHEN seen THEN 0e0 ELSE 100e0 END), 6) AS missing_pct FROM (SELECT region, stop_id IN
       (SELECT stop_id FROM visits WHERE month(operating_day) = 1 AND NOT failed) AS seen FROM stop_regions)
       GROUP BY region""",
)
def realtime_coverage(spark, root):
    month = B.visits(spark, root).where((F.month("operating_day") == 1) & ~F.col("failed"))
    return transit.coverage(inside(spark, root), month, "region").withColumn("missing_pct", r("missing_pct"))


register_sql(
    "footpaths",
    f"""SELECT a.stop_id AS from_stop, b.stop_id AS to_stop, {haversine_sql('a', 'b')} AS metres,
        CAST(ceil({haversine_sql('a', 'b')} * 60 / 50) AS BIGINT) AS walk_s
        FROM stops a JOIN stops b ON a.stop_id <> b.stop_id AND {haversine_sql('a', 'b')} <= 500""",
)


@query("footpaths", "SELECT from_stop, to_stop, round(metres, 3) AS metres, walk_s FROM footpaths")
def footpaths(spark, root):
    return transit.footpaths(B.stops(spark, root)).withColumn("metres", r("metres", 3))


register_sql(
    "subset",
    f"""SELECT DISTINCT s.run_id, s.stop_id, s.dep_s, s.arr_s, {', '.join(DAYS)} FROM stop_times s
        JOIN trips t ON t.trip_id = s.trip_id JOIN calendar c ON c.service_id = t.service_id
        WHERE s.stop_id IN (SELECT stop_id FROM stop_regions)""",
)


def subset(spark, root):
    return transit.timetable_subset(
        B.stop_times_text(spark, root), B.trips(spark, root), B.calendar(spark, root), inside(spark, root)
    )


@query("timetable_subset", "SELECT * FROM subset")
def timetable_subset(spark, root):
    return subset(spark, root)


@query(
    "timetable_counts",
    "SELECT 'all_days' AS day, count(DISTINCT (run_id, stop_id)) AS pairs FROM subset UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '{d}', count(DISTINCT (run_id, stop_id)) FILTER (WHERE {d}) FROM subset" for d in DAYS
    ),
)
def timetable_counts(spark, root):
    return transit.timetable_counts(subset(spark, root), DAYS)


@query(
    "weekday_service",
    """WITH wk AS (SELECT service_id FROM calendar WHERE monday AND tuesday AND wednesday AND thursday AND friday
                  AND NOT saturday AND NOT sunday),
       running AS ((SELECT service_id, CAST(d AS DATE) AS day FROM wk,
                    generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY) g(d)
                    WHERE isodow(d) <= 5
                    UNION SELECT service_id, day FROM calendar_dates WHERE exception_type = 1
                          AND service_id IN (SELECT service_id FROM wk))
                   EXCEPT SELECT service_id, day FROM calendar_dates WHERE exception_type = 2)
       SELECT t.trip_id, ro.route_id, ro.route_type, count(*) AS days FROM running s JOIN trips t USING (service_id)
       JOIN routes ro ON ro.route_id = t.route_id GROUP BY 1, 2, 3""",
)
def weekday_service(spark, root):
    days = transit.service_days(B.calendar(spark, root), B.calendar_dates(spark, root), "2024-01-01", "2024-01-30")
    per = days.groupBy("service_id").agg(F.count(F.lit(1)).alias("days"))
    j = per.join(B.trips(spark, root), "service_id").join(B.routes(spark, root), "route_id")
    return j.select("trip_id", "route_id", "route_type", "days")


register_sql(
    "qualified",
    """SELECT trip_id, count(DISTINCT operating_day) AS days FROM visits WHERE stop_id IN
       (SELECT stop_id FROM stop_regions) GROUP BY trip_id HAVING count(DISTINCT operating_day) >= 20""",
)


@query("qualified_trips", "SELECT * FROM qualified")
def qualified_trips(spark, root):
    return transit.qualified_trips(B.visits(spark, root), inside(spark, root), 20)


@query(
    "visits_clean",
    "SELECT event_id, trip_id, stop_id FROM visits WHERE NOT failed AND NOT unplanned"
    " AND trip_id IN (SELECT trip_id FROM qualified)",
)
def visits_clean(spark, root):
    v = B.visits(spark, root)
    kept = transit.clean_visits(v, transit.qualified_trips(v, inside(spark, root), 20))
    return kept.select("event_id", "trip_id", "stop_id")


_TIMES = ["arr_time", "arr_actual", "dep_time", "dep_actual"]
_ORDER = "ORDER BY arr_time ASC NULLS FIRST, arr_actual ASC NULLS FIRST, event_id"
register_sql(
    "traj",
    f"""SELECT v.*, f.start_time, {', '.join(f'epoch({c} - start_time) AS {c}_rel' for c in _TIMES)} FROM
        (SELECT *, row_number() OVER (PARTITION BY trip_id, operating_day {_ORDER}) AS seq FROM visits) v
        LEFT JOIN (SELECT trip_id, operating_day, dep_time AS start_time FROM (SELECT *, row_number() OVER
        (PARTITION BY trip_id, operating_day {_ORDER}) AS k FROM visits WHERE dep_time IS NOT NULL) WHERE k = 1) f
        USING (trip_id, operating_day)""",
)


def traj(spark, root):
    return transit.trajectories(B.visits(spark, root))


@query(
    "journey_trajectories",
    "SELECT event_id, trip_id, CAST(operating_day AS VARCHAR) AS operating_day, stop_id, seq, start_time, "
    + ", ".join(f"CAST({c}_rel AS DOUBLE) AS {c}_rel" for c in _TIMES)
    + " FROM traj",
)
def journey_trajectories(spark, root):
    return traj(spark, root).select(
        "event_id", "trip_id", F.col("operating_day").cast("string"), "stop_id", "seq", "start_time",
        *[transit.interval_seconds(f"{c}_rel").cast("double").alias(f"{c}_rel") for c in _TIMES],
    )


@query(
    "trajectory_anomalies",
    """SELECT 'order' AS kind, trip_id, stop_id, count(DISTINCT seq) AS variants FROM traj GROUP BY 2, 3
       HAVING count(DISTINCT seq) > 1 UNION ALL
       SELECT 'length', trip_id, -1, count(DISTINCT n) FROM (SELECT trip_id, operating_day, count(*) AS n FROM visits
       GROUP BY 1, 2) GROUP BY 2 HAVING count(DISTINCT n) > 1""",
)
def trajectory_anomalies(spark, root):
    return transit.trajectory_anomalies(traj(spark, root))


@query(
    "punctual_days",
    """SELECT trip_id, CAST(operating_day AS VARCHAR) AS operating_day FROM (SELECT trip_id, operating_day,
       arg_min(epoch(dep_actual - dep_time), seq) AS late FROM traj WHERE dep_time IS NOT NULL GROUP BY 1, 2)
       WHERE abs(late) <= 30""",
)
def punctual_days(spark, root):
    out = transit.punctual_days(traj(spark, root), 30)
    return out.select("trip_id", F.col("operating_day").cast("string"))


_PLAN_DAYS = [f"2024-01-{d:02d}" for d in range(1, 31)]


@query(
    "planned_vs_actual",
    "SELECT trip_id, seq, evt_type, CAST(min(p) AS DOUBLE) AS planned, "
    + ", ".join(
        f"CAST(min(a) FILTER (WHERE operating_day = DATE '{d}') AS DOUBLE) AS \"{d}\"" for d in _PLAN_DAYS
    )
    + """ FROM (SELECT trip_id, seq, operating_day, 'arr' AS evt_type, arr_time_rel AS p, arr_actual_rel AS a FROM traj
        UNION ALL SELECT trip_id, seq, operating_day, 'dep', dep_time_rel, dep_actual_rel FROM traj) GROUP BY 1, 2, 3""",
)
def planned_vs_actual(spark, root):
    wide = transit.planned_vs_actual(traj(spark, root))
    keys = ["trip_id", "seq", "evt_type"]
    return wide.select(*keys, *[F.col(f"`{c}`").cast("double").alias(c) for c in wide.columns if c not in keys])


register_sql(
    "facts",
    """SELECT *, CAST(epoch(arr_actual - arr_time) AS BIGINT) AS arr_delay,
       CAST(epoch(dep_actual - dep_time) AS BIGINT) AS dep_delay FROM visits
       WHERE epoch(arr_actual - arr_time) > -120 AND epoch(arr_actual - arr_time) < 3600
       AND hour(sched) BETWEEN 7 AND 17""",
)


@query(
    "delay_facts",
    "SELECT event_id, trip_id, stop_id, CAST(arr_delay AS DOUBLE) AS arr_delay, CAST(dep_delay AS DOUBLE) AS dep_delay"
    " FROM facts",
)
def delay_facts(spark, root):
    f = transit.delay_facts(B.visits(spark, root))
    delays = [F.col(c).cast("double").alias(c) for c in ("arr_delay", "dep_delay")]
    return f.select("event_id", "trip_id", "stop_id", *delays)


@query(
    "delay_label",
    """SELECT label, count(*) AS n, round(any_value(total) / (2e0 * count(*)), 6) AS weight FROM
       (SELECT CASE WHEN arr_delay > 100 THEN 1 ELSE 0 END AS label, count(*) OVER () AS total FROM facts) GROUP BY label""",
)
def delay_label(spark, root):
    f = transit.delay_facts(B.visits(spark, root))
    labelled = f.select("event_id", F.when(F.col("arr_delay") > 100, 1).otherwise(0).alias("label"))
    weighted = aggregates.class_weights(labelled, "label")
    return weighted.groupBy("label").agg(F.count(F.lit(1)).alias("n"), r(F.max("weight")).alias("weight"))


register_sql(
    "features",
    """SELECT f.event_id, f.stop_id, f.line_id AS route_id, f.arr_delay AS delay, CAST(epoch(f.sched - s.start) AS BIGINT)
       AS scheduled_tt, hour(f.sched) AS sched_hour, hour(f.arr_actual) AS act_hour, isodow(f.sched) AS dow,
       dayofyear(f.sched) AS doy, st.lat, st.lon, ro.route_type, COALESCE(t.m, 120) AS min_transfer_time,
       COALESCE(t.n, 0) AS transfer_degree FROM facts f
       JOIN (SELECT trip_id, operating_day, min(sched) AS start FROM facts GROUP BY 1, 2) s USING (trip_id, operating_day)
       LEFT JOIN stops st ON st.stop_id = f.stop_id LEFT JOIN routes ro ON ro.route_id = f.line_id
       LEFT JOIN (SELECT from_stop, min(min_transfer_time) AS m, count(*) AS n FROM transfers GROUP BY 1) t
       ON t.from_stop = f.stop_id""",
)
_FEATURES = [
    "event_id", "stop_id", "route_id", "delay", "scheduled_tt", "sched_hour", "act_hour", "dow", "doy", "lat", "lon",
    "route_type", "min_transfer_time", "transfer_degree",
]


def features(spark, root):
    return transit.delay_features(
        transit.delay_facts(B.visits(spark, root)), B.stops(spark, root), B.routes(spark, root),
        B.transfers(spark, root),
    )


@query(
    "delay_features",
    f"SELECT {', '.join(_FEATURES)}, round(sin(sched_hour * (2 * pi() / 24)), 6) AS hour_sin,"
    " round(cos(doy * (2 * pi() / 365)), 6) AS doy_cos FROM features",
)
def delay_features(spark, root):
    return features(spark, root).select(
        *[bigint(c).alias(c) if c in ("sched_hour", "act_hour", "dow", "doy") else c for c in _FEATURES],
        r("hour_sin").alias("hour_sin"), r("doy_cos").alias("doy_cos"),
    )


@query(
    "weather_features",
    "SELECT event_id, station_id, delay_s, reading_id IS NOT NULL AS matched, temp, precip FROM visit_weather",
)
def weather_features(spark, root):
    return visit_weather(spark, root).select("event_id", "station_id", "delay_s", "matched", "temp", "precip")


@query(
    "hourly_delay_quantiles",
    f"SELECT hour(sched) AS hour, {_Q_SQL.format('arr_delay')}, count(*) AS n FROM facts GROUP BY 1",
)
def hourly_delay_quantiles(spark, root):
    f = transit.delay_facts(B.visits(spark, root)).withColumn("hour", bigint(F.hour("sched")))
    return quantiles.discrete_quantiles(f, ["hour"], "arr_delay", QS)


@query(
    "baseline_quantiles",
    f"SELECT route_id, stop_id, sched_hour, {_Q_SQL.format('delay')}, count(*) AS n FROM features GROUP BY 1, 2, 3",
)
def baseline_quantiles(spark, root):
    out = quantiles.discrete_quantiles(features(spark, root), ["route_id", "stop_id", "sched_hour"], "delay", QS)
    return out.withColumn("sched_hour", bigint("sched_hour"))


@query(
    "weather_delay_quantiles",
    f"""SELECT weather, {_Q_SQL.format('delay_s')}, count(*) AS n FROM (SELECT delay_s, CASE WHEN precip > 0 THEN 'rain'
        WHEN precip IS NOT NULL THEN 'dry' ELSE 'unknown' END AS weather FROM visit_weather) GROUP BY weather""",
)
def weather_delay_quantiles(spark, root):
    p = F.col("precip")
    rows = visit_weather(spark, root).withColumn(
        "weather", F.when(p > 0, "rain").when(p.isNotNull(), "dry").otherwise("unknown")
    )
    return quantiles.discrete_quantiles(rows, ["weather"], "delay_s", QS)


@query(
    "delay_lag_corr",
    """SELECT line_id, round(corr(a, b), 6) AS lag_corr, count(*) AS pairs FROM (SELECT line_id,
       CAST(delay_s AS DOUBLE) AS a, CAST(lag(delay_s) OVER (PARTITION BY trip_id, operating_day ORDER BY sched, event_id)
       AS DOUBLE) AS b FROM visits) WHERE b IS NOT NULL GROUP BY line_id""",
)
def delay_lag_corr(spark, root):
    return transit.lag_correlation(B.visits(spark, root)).withColumn("lag_corr", r("lag_corr"))


@query(
    "transport_mix",
    "SELECT year(operating_day) AS year, month(operating_day) AS month, lower(product_id) AS product, count(*) AS visits"
    " FROM visits GROUP BY 1, 2, 3",
)
def transport_mix(spark, root):
    v = B.visits(spark, root)
    return v.groupBy(
        bigint(F.year("operating_day")).alias("year"), bigint(F.month("operating_day")).alias("month"),
        F.lower("product_id").alias("product"),
    ).agg(F.count(F.lit(1)).alias("visits"))


_OBS = "block bigint, observations array<struct<station_id:bigint,valid_time_gmt:bigint,temp:double,precip:double>>"


@query(
    "weather_flat",
    """SELECT station_id, valid_time_gmt, year(l) AS year, month(l) AS month, day(l) AS day, hour(l) AS hour, temp, precip
       FROM (SELECT station_id, t AS valid_time_gmt, temp, precip, make_timestamp((t + 3600) * 1000000) AS l FROM weather)
       WHERE station_id IN (SELECT station_id FROM weather GROUP BY station_id
       HAVING count(DISTINCT (month(make_timestamp((t + 3600) * 1000000)), day(make_timestamp((t + 3600) * 1000000)))) >= 29)""",
)
def weather_flat(spark, root):
    w = B.weather(spark, root)
    obs = F.struct("station_id", F.col("t").alias("valid_time_gmt"), "temp", "precip")
    docs = w.groupBy(F.expr("reading_id DIV 50").alias("block")).agg(F.collect_list(obs).alias("observations"))
    path = writers.write_json(docs, scratch_path(spark, "weather"))
    flat = readers.read_json(spark, path, _OBS).select(F.explode("observations").alias("o")).select("o.*")
    local = flat.withColumn("_l", local_time("valid_time_gmt"))
    full = shaping.complete_periods(local, "station_id", [F.month("_l"), F.dayofmonth("_l")], 29)
    parts = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}
    return full.select(
        "station_id", "valid_time_gmt", *[bigint(f("_l")).alias(n) for n, f in parts.items()], "temp", "precip"
    )
