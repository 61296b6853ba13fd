"""Window functions and time series."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tramline import bindings as B
from tramline.bindings import register_sql
from tramline.functions.timefn import cyclic, epoch_seconds, iso_weekday
from tramline.operators import ordered, quantiles, timeseries
from tramline.plans.util import bigint, r
from tramline.registry import query
from tramline.session import table

START, END, STEP = 1704067200, 1706655600, 10800  # 2024-01-01 .. 2024-01-30 23:00, three hours


def _hourly_rank(spark, root, fn):
    rows = B.readings(spark, root).where("value IS NOT NULL").select(
        "event_id", "sensor", F.expr("t DIV 3600").alias("hour"), "value"
    )
    w = Window.partitionBy("hour").orderBy(F.desc("value"))
    return rows.withColumn("rank", fn().over(w)).where("rank <= 5").select("event_id", "hour", "rank")


_RANK_SQL = """SELECT event_id, hour, rank FROM (SELECT event_id, t // 3600 AS hour, {}() OVER
    (PARTITION BY t // 3600 ORDER BY value DESC) AS rank FROM readings WHERE value IS NOT NULL) WHERE rank <= 5"""


@query("win_rank_topn", _RANK_SQL.format("rank"))
def win_rank_topn(spark, root):
    return _hourly_rank(spark, root, F.rank)


@query("win_dense_rank", _RANK_SQL.format("dense_rank"))
def win_dense_rank(spark, root):
    return _hourly_rank(spark, root, F.dense_rank)


register_sql(
    "trailing_avg",
    """SELECT event_id, sensor, t, value, avg(value) OVER (PARTITION BY sensor ORDER BY t
       RANGE BETWEEN 10740 PRECEDING AND CURRENT ROW) AS avg_3h FROM readings""",
)


def _trailing(spark, root):
    rd = B.readings(spark, root).select("event_id", "sensor", "t", "value")
    return timeseries.trailing_mean(rd, ["sensor"], "t", "value", 10740, "avg_3h")


@query("win_range_avg", "SELECT event_id, round(avg_3h, 5) AS avg_3h FROM trailing_avg")
def win_range_avg(spark, root):
    return _trailing(spark, root).select("event_id", r("avg_3h", 5).alias("avg_3h"))


@query(
    "win_rank_of_avg",
    """SELECT event_id, hour, rank FROM (SELECT event_id, t // 3600 AS hour, rank() OVER (PARTITION BY t // 3600
       ORDER BY round(avg_3h, 5) DESC) AS rank FROM trailing_avg WHERE avg_3h IS NOT NULL) WHERE rank <= 5""",
)
def win_rank_of_avg(spark, root):
    rows = _trailing(spark, root).where("avg_3h IS NOT NULL").withColumn("hour", F.expr("t DIV 3600"))
    w = Window.partitionBy("hour").orderBy(F.desc(r("avg_3h", 5)))
    return rows.withColumn("rank", F.rank().over(w)).where("rank <= 5").select("event_id", "hour", "rank")


@query(
    "win_row_number",
    """SELECT event_id, row_number() OVER (PARTITION BY trip_id, operating_day
       ORDER BY arr_time ASC NULLS FIRST, arr_actual ASC NULLS FIRST, event_id) AS seq FROM visits""",
)
def win_row_number(spark, root):
    v = B.visits(spark, root).select("event_id", "trip_id", "operating_day", "arr_time", "arr_actual")
    order = ["arr_time", "arr_actual", "event_id"]
    return ordered.row_numbers(v, ["trip_id", "operating_day"], order, "seq").select("event_id", "seq")


@query(
    "win_first_non_null",
    """SELECT v.event_id, f.start_time FROM visits v JOIN (SELECT trip_id, operating_day,
       arg_min(dep_time, (sched, event_id)) FILTER (WHERE dep_time IS NOT NULL) AS start_time
       FROM visits GROUP BY 1, 2) f USING (trip_id, operating_day)""",
)
def win_first_non_null(spark, root):
    v = B.visits(spark, root).select("event_id", "trip_id", "operating_day", "sched", "dep_time")
    first = v.where("dep_time IS NOT NULL").groupBy("trip_id", "operating_day").agg(
        F.min_by("dep_time", F.struct("sched", "event_id")).alias("start_time")
    )
    return v.join(first, ["trip_id", "operating_day"], "left").select("event_id", "start_time")


@query(
    "win_history_excl",
    """SELECT event_id, round(avg(delay_s) OVER (PARTITION BY line_id, product_id ORDER BY t RANGE BETWEEN
       3600 PRECEDING AND 1 PRECEDING), 5) AS recent_delay
       FROM (SELECT *, CAST(epoch(sched) AS BIGINT) AS t FROM visits)""",
)
def win_history_excl(spark, root):
    v = B.visits(spark, root).select(
        "event_id", "line_id", "product_id", epoch_seconds("sched").alias("t"), "delay_s"
    )
    out = timeseries.trailing_mean(v, ["line_id", "product_id"], "t", "delay_s", 3600, "recent_delay", False)
    return out.select("event_id", r("recent_delay", 5).alias("recent_delay"))


@query(
    "win_lead_pairs",
    """SELECT * FROM (SELECT run_id, stop_id AS from_stop, lead(stop_id) OVER w AS to_stop, dep_s,
       lead(arr_s) OVER w AS arr_s FROM stop_times WINDOW w AS (PARTITION BY run_id ORDER BY arr_s, event_id))
       WHERE arr_s >= dep_s""",
)
def win_lead_pairs(spark, root):
    st = B.stop_times(spark, root)
    nxt = ordered.neighbour(st, ["run_id"], ["arr_s", "event_id"], F.struct("stop_id", "arr_s"), "n", step=1)
    pairs = nxt.where("n IS NOT NULL AND n.arr_s >= dep_s")
    return pairs.select(
        "run_id", F.col("stop_id").alias("from_stop"), F.col("n.stop_id").alias("to_stop"), "dep_s",
        F.col("n.arr_s").alias("arr_s"),
    )


@query(
    "ts_resample",
    "SELECT sensor, t // 1800 * 1800 AS t, round(avg(value), 6) AS value FROM readings GROUP BY 1, 2",
)
def ts_resample(spark, root):
    out = timeseries.resample_mean(B.readings(spark, root), ["sensor"], "t", "value", 1800)
    return out.withColumn("value", r("value"))


@query(
    "ts_resample_median",
    f"SELECT sensor, (t - {START}) // 172800 * 172800 + {START} AS t, round(median(value), 5) AS value FROM readings"
    " WHERE value IS NOT NULL GROUP BY 1, 2",
)
def ts_resample_median(spark, root):
    rd = B.readings(spark, root).withColumn("t", timeseries.bucket("t", 172800, START))
    q = quantiles.exact_quantiles(rd, ["sensor", "t"], "value", {"value_q": 0.5})
    return q.select("sensor", "t", r("value_q", 5).alias("value"))


register_sql(
    "grid",
    f"""SELECT g.sensor, g.t, m.value FROM (SELECT sensor, unnest(range(lo, hi + 1, {STEP})) AS t
        FROM (SELECT DISTINCT sensor FROM readings), (SELECT min(t) // {STEP} * {STEP} AS lo, max(t) // {STEP} * {STEP} AS hi
        FROM readings)) g LEFT JOIN (SELECT sensor, t // {STEP} * {STEP} AS t,
        avg(value) AS value FROM readings GROUP BY 1, 2) m USING (sensor, t)""",
)


def gridded(spark, root):
    mean = timeseries.resample_mean(B.readings(spark, root), ["sensor"], "t", "value", STEP)
    return timeseries.time_grid(mean, ["sensor"], "t", STEP)


@query("ts_grid", "SELECT sensor, t, round(value, 6) AS value FROM grid")
def ts_grid(spark, root):
    return gridded(spark, root).withColumn("value", r("value"))


_FILL = "{}(CASE WHEN value IS NOT NULL THEN {} END IGNORE NULLS) OVER (PARTITION BY sensor ORDER BY t ROWS BETWEEN {})"
_BACK, _AHEAD = "UNBOUNDED PRECEDING AND CURRENT ROW", "CURRENT ROW AND UNBOUNDED FOLLOWING"


@query(
    "ts_interpolate",
    f"""SELECT sensor, t, round(COALESCE(value, pv + (nv - pv) * (t - pt) / (nt - pt)), 9) AS value FROM (
        SELECT *, {_FILL.format('last_value', 'value', _BACK)} AS pv, {_FILL.format('last_value', 't', _BACK)} AS pt,
        {_FILL.format('first_value', 'value', _AHEAD)} AS nv, {_FILL.format('first_value', 't', _AHEAD)} AS nt FROM grid)""",
)
def ts_interpolate(spark, root):
    out = timeseries.interpolate(gridded(spark, root), ["sensor"], "t", "value", "filled")
    return out.select("sensor", "t", r("filled", 9).alias("value"))


@query(
    "ts_ffill",
    f"SELECT sensor, t, round({_FILL.format('last_value', 'value', _BACK)}, 6) AS value FROM grid",
)
def ts_ffill(spark, root):
    out = ordered.carry(gridded(spark, root), ["sensor"], ["t"], last={"filled": F.col("value")})
    return out.select("sensor", "t", r("filled").alias("value"))


@query(
    "ts_bfill",
    f"SELECT sensor, t, round({_FILL.format('first_value', 'value', _AHEAD)}, 6) AS value FROM grid",
)
def ts_bfill(spark, root):
    out = ordered.carry(gridded(spark, root), ["sensor"], ["t"], following={"filled": F.col("value")})
    return out.select("sensor", "t", r("filled").alias("value"))


@query(
    "ts_coverage",
    f"""SELECT sensor, min(t) AS first_t, max(t) AS last_t, min(t) > {START} + 43200 AS late_start,
        max(t) < {END} - 43200 AS early_end FROM readings WHERE value IS NOT NULL GROUP BY sensor
        HAVING min(t) > {START} + 43200 OR max(t) < {END} - 43200""",
)
def ts_coverage(spark, root):
    span = B.readings(spark, root).where("value IS NOT NULL").groupBy("sensor").agg(
        F.min("t").alias("first_t"), F.max("t").alias("last_t")
    )
    flags = span.withColumns(
        {"late_start": F.col("first_t") > START + 43200, "early_end": F.col("last_t") < END - 43200}
    )
    return flags.where("late_start OR early_end")


@query(
    "ts_constant_attr",
    "SELECT sensor, count(DISTINCT site) AS sites FROM readings GROUP BY sensor HAVING count(DISTINCT site) > 1",
)
def ts_constant_attr(spark, root):
    sites = B.readings(spark, root).groupBy("sensor").agg(F.countDistinct("site").alias("sites"))
    return sites.where("sites > 1")


register_sql(
    "numbered",
    """SELECT sensor, event_id, t, value, row_number() OVER (PARTITION BY sensor ORDER BY t, event_id) AS rn
       FROM readings WHERE value IS NOT NULL""",
)
register_sql(
    "ema",
    """SELECT sensor, event_id, t, rn, value, value AS ema FROM numbered WHERE rn = 1 UNION ALL
       SELECT n.sensor, n.event_id, n.t, n.rn, n.value, 0.1e0 * n.value + 0.9e0 * ema.ema FROM ema
       JOIN numbered n ON n.sensor = ema.sensor AND n.rn = ema.rn + 1""",
)
register_sql(
    "kalman",
    """SELECT sensor, event_id, rn, value AS x, 1e0 AS p FROM numbered WHERE rn = 1 UNION ALL
       SELECT n.sensor, n.event_id, n.rn, k.x + (k.p + 1e-5) / (k.p + 1e-5 + 0.1e0) * (n.value - k.x),
              (1 - (k.p + 1e-5) / (k.p + 1e-5 + 0.1e0)) * (k.p + 1e-5) FROM kalman k
       JOIN numbered n ON n.sensor = k.sensor AND n.rn = k.rn + 1""",
)


def sensor_ema(spark, root):
    rd = B.readings(spark, root).select("sensor", "event_id", "t", "value")
    return timeseries.ema(rd, ["sensor"], ["t", "event_id"], "value", "ema", 0.1)


@query("ts_ema", "SELECT sensor, event_id, round(ema, 7) AS ema FROM ema")
def ts_ema(spark, root):
    # rounded: the last bits depend on where blocks of the scan begin, and values of few digits lie on floors
    return sensor_ema(spark, root).select("sensor", "event_id", r("ema", 7).alias("ema"))


@query("ts_kalman", "SELECT sensor, event_id, round(x, 5) AS estimate FROM kalman")
def ts_kalman(spark, root):
    rd = B.readings(spark, root).select("sensor", "event_id", "t", "value")
    out = timeseries.kalman(rd, ["sensor"], ["t", "event_id"], "value", "estimate")
    return out.select("sensor", "event_id", r("estimate", 5).alias("estimate"))


@query(
    "ts_drift_flags",
    """SELECT sensor, round(slope, 5) AS trend_per_day, round(z, 5) AS peak_z, abs(slope) > 1 AS trending, z > 4 AS spiky
       FROM (SELECT sensor, regr_slope(ema, t / 86400e0) AS slope, greatest(max(value) - avg(value),
       avg(value) - min(value)) / stddev(value) AS z FROM ema GROUP BY sensor)""",
)
def ts_drift_flags(spark, root):
    out = timeseries.drift_flags(sensor_ema(spark, root), ["sensor"], "t", "value", "ema", 1.0, 4.0)
    return out.withColumns({"trend_per_day": r("trend_per_day", 5), "peak_z": r("peak_z", 5)})


_W = ", ".join(f"({i - 5}, {w!r}e0)" if "e" not in repr(w) else f"({i - 5}, {w!r})" for i, w in enumerate(timeseries.hann_weights(11)))


@query(
    "ts_smooth",
    f"""WITH s AS (SELECT event_type, day(ts) - 1 AS pos, CAST(count(*) AS DOUBLE) AS x FROM events GROUP BY 1, 2),
        e AS (SELECT event_type, max(pos) AS last, arg_min(x, pos) AS x0, arg_max(x, pos) AS xn FROM s GROUP BY 1),
        p AS (SELECT event_type, pos, x FROM s UNION ALL
              SELECT event_type, -pos - 1, 2 * x0 - x FROM s JOIN e USING (event_type) WHERE pos < 5 UNION ALL
              SELECT event_type, 2 * last + 1 - pos, 2 * xn - x FROM s JOIN e USING (event_type) WHERE last - pos < 5)
        SELECT s.event_type, s.pos, round(sum(w.w * p.x), 6) AS smoothed FROM s
        CROSS JOIN (VALUES {_W}) w(o, w) JOIN p ON p.event_type = s.event_type AND p.pos = s.pos + w.o GROUP BY 1, 2""",
)
def ts_smooth(spark, root):
    daily = table(spark, root, "events").groupBy("event_type", bigint(F.dayofmonth("ts") - 1).alias("pos")).agg(
        F.count(F.lit(1)).cast("double").alias("x")
    )
    out = timeseries.hann_smooth(daily, ["event_type"], "pos", "x", "smoothed")
    return out.select("event_type", "pos", r("smoothed").alias("smoothed"))


_CYC = {"hour": ("hour(ts)", 24), "half": ("hour(ts)", 12), "dow": ("isodow(ts)", 7), "doy": ("dayofyear(ts)", 365)}


@query(
    "ts_cyclic_features",
    "SELECT event_id, "
    + ", ".join(
        f"round({f}({x} * (2 * pi() / {p})), 6) AS {n}_{f}" for n, (x, p) in _CYC.items() for f in ("sin", "cos")
    )
    + " FROM events",
)
def ts_cyclic_features(spark, root):
    base = {"hour": F.hour("ts"), "half": F.hour("ts"), "dow": iso_weekday("ts"), "doy": F.dayofyear("ts")}
    cols = []
    for name, value in base.items():
        sin, cos = cyclic(value, _CYC[name][1])
        cols += [(r(sin) + 0.0).alias(f"{name}_sin"), (r(cos) + 0.0).alias(f"{name}_cos")]
    return table(spark, root, "events").select("event_id", *cols)


@query(
    "ts_cv_folds",
    """WITH b AS (SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) * 6 // (SELECT count(*) FROM events)
       AS block FROM events) SELECT event_id, fold, CASE WHEN block = fold THEN 'test' ELSE 'train' END AS role
       FROM b, range(1, 6) f(fold) WHERE block <= fold""",
)
def ts_cv_folds(spark, root):
    e = table(spark, root, "events").select("event_id", "ts")
    out = timeseries.cv_folds(e, ["ts", "event_id"], 5)
    return out.select("event_id", bigint("fold").alias("fold"), "role")
