"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline import bindings as B
from tramline.operators import aggregates, joins, ordered, quantiles
from tramline.plans.util import bigint, r
from tramline.registry import query
from tramline.session import table


@query(
    "agg_basic",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, round(avg(l_discount), 6) AS avg_disc,
       count(*) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY 1, 2""",
)
def agg_basic(spark, root):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, root, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        r(F.sum("l_quantity"), 2).alias("sum_qty"), r(F.sum(price), 4).alias("revenue"),
        r(F.avg("l_discount")).alias("avg_disc"), F.count(F.lit(1)).alias("n"),
        F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"),
    )


@query(
    "agg_global",
    "SELECT CAST(sum(event_id) AS BIGINT) AS id_sum, round(avg(value), 6) AS mean_value, count(*) AS n FROM events",
)
def agg_global(spark, root):
    return table(spark, root, "events").agg(
        F.sum("event_id").alias("id_sum"), r(F.avg("value")).alias("mean_value"), F.count(F.lit(1)).alias("n")
    )


@query(
    "agg_distinct",
    "SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT (user_id, day(ts))) AS user_days"
    " FROM events GROUP BY event_type",
)
def agg_distinct(spark, root):
    return table(spark, root, "events").groupBy("event_type").agg(
        F.countDistinct("user_id").alias("users"), F.countDistinct("user_id", F.dayofmonth("ts")).alias("user_days")
    )


@query(
    "agg_filter",
    "SELECT trip_id, count(*) AS n, count(*) FILTER (WHERE delay_s > 60) AS late, count(*) FILTER (WHERE failed)"
    " AS failures FROM visits GROUP BY trip_id",
)
def agg_filter(spark, root):
    return B.visits(spark, root).groupBy("trip_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("delay_s") > 60).alias("late"),
        F.count_if("failed").alias("failures"),
    )


_PROFILED = ["doc_id", "title", "birth_year", "death_year", "language"]


@query(
    "profile_columns",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(DISTINCT {c}) AS n_distinct,
        count(*) FILTER (WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS n_blank,
        min(TRY_CAST({c} AS DOUBLE)) AS min_number, max(TRY_CAST({c} AS DOUBLE)) AS max_number FROM meta"""
        for c in _PROFILED
    ),
)
def profile_columns(spark, root):
    return aggregates.profile(B.meta(spark, root), _PROFILED)


@query(
    "null_pct_by_period",
    """SELECT week(sched) AS period, round(avg(CASE WHEN arr_time IS NULL THEN 100e0 ELSE 0e0 END), 6) AS arr_time_pct,
       round(avg(CASE WHEN dep_time IS NULL THEN 100e0 ELSE 0e0 END), 6) AS dep_time_pct FROM visits GROUP BY 1""",
)
def null_pct_by_period(spark, root):
    out = aggregates.null_percent(
        B.visits(spark, root), bigint(F.weekofyear("sched")), ["arr_time", "dep_time"]
    )
    return out.select("period", r("arr_time_pct").alias("arr_time_pct"), r("dep_time_pct").alias("dep_time_pct"))


_NULLABLE = ["title", "first_name", "birth_year", "death_year", "language"]


@query(
    "null_fraction_select",
    "SELECT column_name, round(f, 6) AS null_fraction, f < 0.5 AS keep, f > 0 AND f < 0.5 AS impute FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END) AS f FROM meta"
        for c in _NULLABLE
    )
    + ")",
)
def null_fraction_select(spark, root):
    out = aggregates.null_fractions(B.meta(spark, root), _NULLABLE)
    return out.withColumn("null_fraction", r("null_fraction"))


@query(
    "monthly_counts",
    "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, lower(o_orderpriority) AS kind, count(*) AS n"
    " FROM orders GROUP BY 1, 2, 3",
)
def monthly_counts(spark, root):
    o = table(spark, root, "orders")
    return (
        o.groupBy(
            bigint(F.year("o_orderdate")).alias("year"), bigint(F.month("o_orderdate")).alias("month"),
            F.lower("o_orderpriority").alias("kind"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("year", "month", "kind")
    )


@query(
    "daily_mean",
    """SELECT m.station_id, m.day, round(m.mean_temp, 6) AS mean_temp, s.lat, s.lon FROM
       (SELECT station_id, t // 86400 AS day, avg(temp) AS mean_temp FROM weather GROUP BY 1, 2) m
       JOIN stations s USING (station_id)""",
)
def daily_mean(spark, root):
    w = B.weather(spark, root).groupBy("station_id", F.expr("t DIV 86400").alias("day")).agg(
        r(F.avg("temp")).alias("mean_temp")
    )
    return w.join(B.stations(spark, root).drop("station_name"), "station_id")


@query(
    "monthly_median",
    "SELECT o_orderpriority AS site, CAST(last_day(o_orderdate) AS VARCHAR) AS month_end,"
    " round(median(o_totalprice), 4) AS median_price FROM orders GROUP BY 1, 2",
)
def monthly_median(spark, root):
    o = table(spark, root, "orders").select(
        F.col("o_orderpriority").alias("site"), F.last_day("o_orderdate").alias("month_end"), "o_totalprice"
    )
    q = quantiles.exact_quantiles(o, ["site", "month_end"], "o_totalprice", {"median_price": 0.5})
    return q.select("site", F.col("month_end").cast("string"), r("median_price", 4).alias("median_price"))


@query(
    "monthly_precip_top",
    """SELECT station_id, month, round(avg(total), 3) AS precip FROM (
         SELECT station_id, year, month, sum(hourly) AS total FROM (
           SELECT station_id, year(ts) AS year, month(ts) AS month, date_trunc('hour', ts) AS h, max(precip) AS hourly
           FROM (SELECT *, make_timestamp(t * 1000000) AS ts FROM weather) GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3)
       GROUP BY 1, 2 ORDER BY precip DESC, station_id, month LIMIT 10""",
)
def monthly_precip_top(spark, root):
    from tramline.functions.timefn import local_time

    w = B.weather(spark, root).withColumn("ts", local_time("t", "UTC"))
    hourly = w.groupBy(
        "station_id", F.year("ts").alias("year"), F.month("ts").alias("month"), F.expr("t DIV 3600").alias("h")
    ).agg(F.max("precip").alias("hourly"))
    monthly = hourly.groupBy("station_id", "year", "month").agg(F.sum("hourly").alias("total"))
    mean = monthly.groupBy("station_id", bigint("month").alias("month")).agg(r(F.avg("total"), 3).alias("precip"))
    return mean.orderBy(F.desc("precip"), "station_id", "month").limit(10)


QS = {"q50": 0.5, "q75": 0.75, "q90": 0.9, "q95": 0.95}


@query(
    "agg_quantiles",
    "SELECT event_type, " + ", ".join(f"quantile_disc(value, {p}) AS {q}" for q, p in QS.items())
    + ", count(value) AS n FROM events GROUP BY event_type",
)
def agg_quantiles(spark, root):
    return quantiles.discrete_quantiles(table(spark, root, "events"), ["event_type"], "value", QS)


@query(
    "agg_quantiles_exact",
    "SELECT event_type, " + ", ".join(f"round(quantile_cont(value, {p}), 5) AS {q}" for q, p in QS.items())
    + ", count(value) AS n FROM events GROUP BY event_type",
)
def agg_quantiles_exact(spark, root):
    out = quantiles.exact_quantiles(table(spark, root, "events"), ["event_type"], "value", QS)
    return out.withColumns({q: r(q, 5) for q in QS})


@query(
    "agg_having",
    "SELECT user_id, count(DISTINCT day(ts)) AS days FROM events GROUP BY user_id HAVING count(DISTINCT day(ts)) >= 28",
)
def agg_having(spark, root):
    days = table(spark, root, "events").groupBy("user_id").agg(F.countDistinct(F.dayofmonth("ts")).alias("days"))
    return days.where("days >= 28")


@query(
    "agg_two_level",
    """SELECT trip_id, n_stops, count(*) AS days FROM (SELECT trip_id, operating_day, count(*) AS n_stops FROM visits
       GROUP BY 1, 2) GROUP BY 1, 2""",
)
def agg_two_level(spark, root):
    daily = B.visits(spark, root).groupBy("trip_id", "operating_day").agg(F.count(F.lit(1)).alias("n_stops"))
    return daily.groupBy("trip_id", "n_stops").agg(F.count(F.lit(1)).alias("days"))


@query(
    "agg_collect_set",
    """SELECT trip_id, stop_id, array_to_string(list_sort(list(DISTINCT seq)), ',') AS positions FROM (
       SELECT trip_id, stop_id, row_number() OVER (PARTITION BY trip_id, operating_day ORDER BY sched, event_id) AS seq
       FROM visits) GROUP BY 1, 2""",
)
def agg_collect_set(spark, root):
    v = B.visits(spark, root).select("trip_id", "stop_id", "operating_day", "sched", "event_id")
    seq = ordered.row_numbers(v, ["trip_id", "operating_day"], ["sched", "event_id"], "seq")
    return seq.groupBy("trip_id", "stop_id").agg(
        F.array_join(F.sort_array(F.collect_set("seq")), ",").alias("positions")
    )


@query(
    "agg_match_pct",
    "SELECT round(100 * (1 - avg(CASE WHEN stop_id IN (SELECT stop_id FROM visits) THEN 1e0 ELSE 0e0 END)), 6)"
    " AS missing_pct, count(*) AS stops FROM stops",
)
def agg_match_pct(spark, root):
    flagged = joins.left_with_flag(B.stops(spark, root), B.visits(spark, root), ["stop_id"])
    return flagged.agg(
        r(100 * (1 - F.avg(F.col("matched").cast("double")))).alias("missing_pct"), F.count(F.lit(1)).alias("stops")
    )


@query(
    "agg_describe",
    """SELECT statistic, round(value, 4) AS value FROM (
       SELECT CAST(count(value) AS DOUBLE) AS "count", avg(value) AS "mean", stddev(value) AS "std",
              min(value) AS "min", max(value) AS "max", quantile_cont(value, 0.25) AS p25,
              quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75 FROM events)
       UNPIVOT (value FOR statistic IN ("count", "mean", "std", "min", "max", p25, p50, p75))""",
)
def agg_describe(spark, root):
    out = aggregates.describe_numeric(table(spark, root, "events").select("value"), "value")
    return out.withColumn("value", r("value", 4))


@query(
    "class_weights",
    """SELECT e.event_id, e.label, round(t.total / (t.classes * c.n), 6) AS weight FROM
       (SELECT event_id, CASE WHEN delay_s > 100 THEN 1 ELSE 0 END AS label FROM visits) e
       JOIN (SELECT CASE WHEN delay_s > 100 THEN 1 ELSE 0 END AS label, count(*) AS n FROM visits GROUP BY 1) c
       USING (label) CROSS JOIN (SELECT count(*) AS total, count(DISTINCT delay_s > 100) AS classes FROM visits) t""",
)
def class_weights(spark, root):
    labelled = B.visits(spark, root).select("event_id", F.when(F.col("delay_s") > 100, 1).otherwise(0).alias("label"))
    return aggregates.class_weights(labelled, "label").withColumn("weight", r("weight"))


@query(
    "rdd_reduce_by_key",
    "SELECT event_id % 5 AS k, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY 1",
)
def rdd_reduce_by_key(spark, root):
    keyed = table(spark, root, "events").select((F.col("event_id") % 5).alias("k"), F.col("event_id").alias("v"))
    return keyed.groupBy("k").agg(F.sum("v").alias("total"))


@query(
    "rdd_group_by_key",
    "SELECT event_id % 5 AS k, event_id AS v, row_number() OVER (PARTITION BY event_id % 5 ORDER BY event_id) AS pos"
    " FROM events",
)
def rdd_group_by_key(spark, root):
    """The values of each key together and numbered, without one list per key."""
    keyed = table(spark, root, "events").select((F.col("event_id") % 5).alias("k"), F.col("event_id").alias("v"))
    return ordered.row_numbers(keyed, ["k"], ["v"], "pos")


@query(
    "tree_aggregate_vectors",
    "SELECT year(l_shipdate) AS year, l_suppkey AS idx, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY 1, 2",
)
def tree_aggregate_vectors(spark, root):
    return table(spark, root, "lineitem").groupBy(
        bigint(F.year("l_shipdate")).alias("year"), F.col("l_suppkey").alias("idx")
    ).agg(r(F.sum("l_quantity"), 2).alias("total"))


@query(
    "transfer_stats",
    """SELECT s.stop_id, COALESCE(t.m, 120) AS min_transfer_time, COALESCE(t.n, 0) AS transfer_degree FROM stops s
       LEFT JOIN (SELECT from_stop, min(min_transfer_time) AS m, count(*) AS n FROM transfers GROUP BY 1) t
       ON t.from_stop = s.stop_id""",
)
def transfer_stats(spark, root):
    return aggregates.transfer_stats(B.stops(spark, root), B.transfers(spark, root))
