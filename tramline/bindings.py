"""Derived relations: domain tables computed from the given tables.

Every relation exists twice, as a Spark function and as SQL text for the
independent check. All of them use whole tables and grow with them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.timefn import epoch_seconds, format_seconds, plus_seconds, whole_second
from tramline.session import table

DNA_FROM = "abcdefghijklmnopqrstuvwxyz "
DNA_TO = "acgtacgtacgtacgtacgtacgtacg"


def visits(spark: SparkSession, root: str) -> DataFrame:
    """Actual stop visits of public-transport trips, from ``events``."""
    e = table(spark, root, "events").select("event_id", "user_id", "event_type", "ts", "value")
    trip = F.expr("CAST(user_id DIV 10 + event_id % 3 AS BIGINT)")
    base = e.select(
        "event_id",
        trip.alias("trip_id"),
        F.expr("(user_id DIV 10 + event_id % 3) DIV 2").alias("line_id"),
        F.to_date("ts").alias("operating_day"),
        F.expr("user_id * 10 + (event_id * 7) % 10").alias("stop_id"),
        F.col("event_type").alias("product_id"),
        whole_second("ts").alias("sched"),
        (F.floor("value").cast("bigint") - 30).alias("delay_s"),
        F.expr("event_id % 53 = 0").alias("failed"),
        F.expr("event_id % 47 = 0").alias("unplanned"),
    )
    timed = base.withColumns(
        {
            "arr_time": F.when(F.col("event_id") % 19 != 0, F.col("sched")),
            "dep_time": F.when(
                F.col("event_id") % 23 != 0, plus_seconds("sched", (F.col("event_id") % 3) * 20)
            ),
        }
    )
    return timed.withColumns(
        {
            "arr_actual": plus_seconds("arr_time", F.col("delay_s")),
            "dep_actual": plus_seconds("dep_time", F.col("delay_s") + F.col("event_id") % 5),
        }
    )


def stops(spark: SparkSession, root: str) -> DataFrame:
    """Stops with coordinates and ids in three text formats, from ``customer``."""
    c = table(spark, root, "customer")
    return c.select(
        F.col("c_custkey").alias("stop_id"),
        F.col("c_name").alias("stop_name"),
        _lat("c_custkey", 373, 1000),
        _lon("c_custkey", 619, 1000),
        F.expr(
            "CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS STRING)"
            " WHEN 1 THEN concat('Parent', c_custkey)"
            " ELSE concat(c_custkey, ':0:', c_custkey % 5) END"
        ).alias("stop_code"),
    )


def stations(spark: SparkSession, root: str) -> DataFrame:
    """Weather stations, from ``supplier``."""
    s = table(spark, root, "supplier")
    return s.select(
        F.col("s_suppkey").alias("station_id"),
        F.col("s_name").alias("station_name"),
        _lat("s_suppkey", 733, 67),
        _lon("s_suppkey", 211, 67),
    )


def _lat(key: str, mult: int, per_tile: int):
    return F.expr(
        f"46.5D + CAST(({key} * {mult}) % 1000 AS DOUBLE) / 10000"
        f" + CAST(({key} DIV {per_tile}) % 30 AS DOUBLE) / 10"
    ).alias("lat")


def _lon(key: str, mult: int, per_tile: int):
    return F.expr(
        f"6.55D + CAST(({key} * {mult}) % 997 AS DOUBLE) / 10000"
        f" + CAST((({key} DIV {per_tile}) DIV 30) % 600 AS DOUBLE) / 10"
    ).alias("lon")


def weather(spark: SparkSession, root: str) -> DataFrame:
    """Weather readings, one per (station, second), from ``events``."""
    e = table(spark, root, "events")
    rows = e.select(
        F.expr("(user_id * 2) DIV 3").alias("station_id"),
        epoch_seconds("ts").alias("t"),
        "event_id",
        F.col("value").alias("temp"),
        F.expr("CASE WHEN event_id % 6 = 0 THEN value / 50 ELSE 0D END").alias("precip"),
    )
    # one primitive aggregate per column keeps this a hash aggregate
    return rows.groupBy("station_id", "t").agg(
        F.min("event_id").alias("reading_id"),
        F.min_by("temp", "event_id").alias("temp"),
        F.min_by("precip", "event_id").alias("precip"),
    )


def readings(spark: SparkSession, root: str) -> DataFrame:
    """Sensor readings with gaps, from ``events``."""
    e = table(spark, root, "events")
    return e.select(
        "event_id",
        F.col("user_id").alias("sensor"),
        F.col("event_type").alias("site"),
        whole_second("ts").alias("ts"),
        epoch_seconds("ts").alias("t"),
        F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("value"),
    )


def stop_times(spark: SparkSession, root: str) -> DataFrame:
    """A timetable on one service day, times past 24 h included, from ``events``."""
    e = table(spark, root, "events")
    trip = F.expr("CAST(user_id DIV 10 + event_id % 3 AS BIGINT)")
    secs = F.expr("hour(ts) * 3600 + minute(ts) * 60 + CAST(floor(second(ts)) AS INT)")
    rows = e.select(
        "event_id",
        trip.alias("trip_id"),
        (trip * 100 + F.dayofmonth("ts")).alias("run_id"),
        F.expr("user_id * 10 + (event_id * 7) % 10").alias("stop_id"),
        (secs + F.when(trip % 4 == 0, 43200).otherwise(0)).cast("bigint").alias("arr_s"),
    )
    return rows.withColumn("dep_s", F.col("arr_s") + (F.col("event_id") % 3) * 20)


def stop_times_text(spark: SparkSession, root: str) -> DataFrame:
    """The timetable with ``HH:MM:SS`` text times as published."""
    st = stop_times(spark, root)
    return st.select(
        "event_id",
        "trip_id",
        "run_id",
        "stop_id",
        format_seconds("arr_s").alias("arrival_time"),
        format_seconds("dep_s").alias("departure_time"),
    )


def trips(spark: SparkSession, root: str) -> DataFrame:
    """Trips with route and service, from ``events``."""
    v = visits(spark, root).select("trip_id", "line_id").distinct()
    return v.select("trip_id", F.col("line_id").alias("route_id"), F.col("trip_id").alias("service_id"))


def calendar(spark: SparkSession, root: str) -> DataFrame:
    """Weekday flags per service."""
    s = trips(spark, root).select("service_id").distinct()
    days = ["monday", "tuesday", "wednesday", "thursday", "friday"]
    flags = [(F.col("service_id") % 6 != i + 1).alias(d) for i, d in enumerate(days)]
    weekend = [(F.col("service_id") % 4 == 1).alias(d) for d in ("saturday", "sunday")]
    return s.select("service_id", *flags, *weekend)


def calendar_dates(spark: SparkSession, root: str) -> DataFrame:
    """Service exceptions: type 1 adds a day, type 2 removes it."""
    v = visits(spark, root)
    return (
        v.select(F.col("trip_id").alias("service_id"), F.col("operating_day").alias("day"))
        .distinct()
        .where((F.col("service_id") + F.dayofmonth("day")) % 7 == 0)
        .withColumn("exception_type", (F.dayofmonth("day") % 2 + 1).cast("int"))
    )


def routes(spark: SparkSession, root: str) -> DataFrame:
    r = trips(spark, root).select("route_id").distinct()
    return r.select(
        "route_id",
        F.expr("CASE route_id % 3 WHEN 0 THEN 'B' WHEN 1 THEN 'T' ELSE 'S' END").alias("route_type"),
        (F.col("route_id") % 4).alias("operator_id"),
    )


def transfers(spark: SparkSession, root: str) -> DataFrame:
    """Explicit change times between stops, some of them missing."""
    c = table(spark, root, "customer")
    return c.select(
        F.col("c_custkey").alias("from_stop"),
        F.expr("c_custkey + c_custkey % 13 - 6").alias("to_stop"),
        F.expr("CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 60 + (c_custkey % 7) * 30 END").alias(
            "min_transfer_time"
        ),
    ).where("to_stop >= 0")


def meta(spark: SparkSession, root: str) -> DataFrame:
    """Book metadata with missing values and BC years, from ``documents``."""
    d = table(spark, root, "documents").select("doc_id", "lang", "source")
    return d.select(
        "doc_id",
        F.expr("CASE WHEN doc_id % 23 = 0 THEN NULL ELSE concat('Title ', doc_id) END").alias("title"),
        F.expr("CASE WHEN doc_id % 29 = 0 THEN NULL ELSE concat('F', doc_id % 7) END").alias("first_name"),
        F.col("source").alias("last_name"),
        F.expr(
            "CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN '40 BC'"
            " ELSE CAST(1700 + (doc_id * 37) % 250 AS STRING) END"
        ).alias("birth_year"),
        F.expr(
            "CASE WHEN doc_id % 4 = 0 OR doc_id % 17 = 0 THEN NULL"
            " ELSE CAST(1730 + (doc_id * 37) % 250 + doc_id % 50 AS STRING) END"
        ).alias("death_year"),
        F.col("lang").alias("language"),
    )


def seqs(spark: SparkSession, root: str) -> DataFrame:
    """Nucleotide sequences, from part names."""
    p = table(spark, root, "part")
    return p.select(
        F.col("p_partkey").alias("seq_id"),
        F.translate(F.lower("p_name"), DNA_FROM, DNA_TO).alias("sequence"),
        (F.col("p_size") % 2).alias("promoter"),
    )


def journey_queries(spark: SparkSession, root: str) -> DataFrame:
    """Journey requests, one per supplier."""
    s = table(spark, root, "supplier")
    return s.select(
        F.col("s_suppkey").alias("query_id"),
        (F.col("s_suppkey") * 15).alias("source"),
        (F.col("s_suppkey") * 15 + F.col("s_suppkey") % 15).alias("target"),
        (F.lit(21600) + (F.col("s_suppkey") % 10) * 1800).cast("bigint").alias("depart_at"),
    )


SPARK_BINDINGS = {
    f.__name__: f
    for f in (
        visits, stops, stations, weather, readings, stop_times, stop_times_text, trips,
        calendar, calendar_dates, routes, transfers, meta, seqs, journey_queries,
    )
}


def _sql_geo(key: str, mlat: int, mlon: int, per_tile: int) -> str:
    return f"""46.5e0 + CAST(({key} * {mlat}) % 1000 AS DOUBLE) / 10000
      + CAST(({key} // {per_tile}) % 30 AS DOUBLE) / 10 AS lat,
    6.55e0 + CAST(({key} * {mlon}) % 997 AS DOUBLE) / 10000
      + CAST((({key} // {per_tile}) // 30) % 600 AS DOUBLE) / 10 AS lon"""


_HMS = (
    "lpad(CAST({0} // 3600 AS VARCHAR), 2, '0') || ':' || "
    "lpad(CAST(({0} % 3600) // 60 AS VARCHAR), 2, '0') || ':' || "
    "lpad(CAST({0} % 60 AS VARCHAR), 2, '0')"
)


def hms_sql(expr: str) -> str:
    return _HMS.format(expr)


def haversine_sql(a: str, b: str) -> str:
    """Great-circle metres between relations ``a`` and ``b`` (columns lat, lon)."""
    return (
        f"2 * 6371000 * asin(sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + "
        f"cos(radians({a}.lat)) * cos(radians({b}.lat)) * "
        f"pow(sin(radians({b}.lon - {a}.lon) / 2), 2)))"
    )


SQL_BINDINGS: dict[str, str] = {
    "visits": """
      SELECT *, arr_time + to_seconds(delay_s) AS arr_actual,
             dep_time + to_seconds(delay_s + event_id % 5) AS dep_actual
      FROM (SELECT event_id, CAST(user_id // 10 + event_id % 3 AS BIGINT) AS trip_id,
             CAST((user_id // 10 + event_id % 3) // 2 AS BIGINT) AS line_id,
             CAST(ts AS DATE) AS operating_day,
             CAST(user_id * 10 + (event_id * 7) % 10 AS BIGINT) AS stop_id,
             event_type AS product_id, date_trunc('second', ts) AS sched,
             CAST(floor(value) AS BIGINT) - 30 AS delay_s,
             event_id % 53 = 0 AS failed, event_id % 47 = 0 AS unplanned,
             CASE WHEN event_id % 19 <> 0 THEN date_trunc('second', ts) END AS arr_time,
             CASE WHEN event_id % 23 <> 0
                  THEN date_trunc('second', ts) + to_seconds((event_id % 3) * 20) END AS dep_time
            FROM events)""",
    "stops": f"""
      SELECT c_custkey AS stop_id, c_name AS stop_name, {_sql_geo('c_custkey', 373, 619, 1000)},
             CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS VARCHAR)
                  WHEN 1 THEN 'Parent' || c_custkey
                  ELSE c_custkey || ':0:' || (c_custkey % 5) END AS stop_code
      FROM customer""",
    "stations": f"""
      SELECT s_suppkey AS station_id, s_name AS station_name,
             {_sql_geo('s_suppkey', 733, 211, 67)} FROM supplier""",
    "weather": """
      SELECT station_id, t, min(event_id) AS reading_id, arg_min(temp, event_id) AS temp,
             arg_min(precip, event_id) AS precip
      FROM (SELECT (user_id * 2) // 3 AS station_id,
                   CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS t, event_id, value AS temp,
                   CASE WHEN event_id % 6 = 0 THEN value / 50 ELSE 0e0 END AS precip
            FROM events) GROUP BY station_id, t""",
    "readings": """
      SELECT event_id, user_id AS sensor, event_type AS site, date_trunc('second', ts) AS ts,
             CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS t,
             CASE WHEN event_id % 11 <> 0 THEN value END AS value
      FROM events""",
    "stop_times": """
      SELECT *, arr_s + (event_id % 3) * 20 AS dep_s
      FROM (SELECT event_id, user_id // 10 + event_id % 3 AS trip_id,
                   (user_id // 10 + event_id % 3) * 100 + day(ts) AS run_id,
                   user_id * 10 + (event_id * 7) % 10 AS stop_id,
                   CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts)
                     + CASE WHEN (user_id // 10 + event_id % 3) % 4 = 0 THEN 43200 ELSE 0 END
                     AS BIGINT) AS arr_s
            FROM events)""",
    "stop_times_text": f"""
      SELECT event_id, trip_id, run_id, stop_id, {hms_sql('arr_s')} AS arrival_time,
             {hms_sql('dep_s')} AS departure_time FROM stop_times""",
    "trips": "SELECT DISTINCT trip_id, line_id AS route_id, trip_id AS service_id FROM visits",
    "calendar": """
      SELECT DISTINCT service_id, service_id % 6 <> 1 AS monday, service_id % 6 <> 2 AS tuesday,
             service_id % 6 <> 3 AS wednesday, service_id % 6 <> 4 AS thursday,
             service_id % 6 <> 5 AS friday, service_id % 4 = 1 AS saturday,
             service_id % 4 = 1 AS sunday FROM trips""",
    "calendar_dates": """
      SELECT *, CAST(day(day) % 2 + 1 AS INTEGER) AS exception_type
      FROM (SELECT DISTINCT trip_id AS service_id, operating_day AS day FROM visits)
      WHERE (service_id + day(day)) % 7 = 0""",
    "routes": """
      SELECT DISTINCT route_id, CASE route_id % 3 WHEN 0 THEN 'B' WHEN 1 THEN 'T' ELSE 'S' END
             AS route_type, route_id % 4 AS operator_id FROM trips""",
    "transfers": """
      SELECT c_custkey AS from_stop, c_custkey + c_custkey % 13 - 6 AS to_stop,
             CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 60 + (c_custkey % 7) * 30 END
             AS min_transfer_time
      FROM customer WHERE c_custkey + c_custkey % 13 - 6 >= 0""",
    "meta": """
      SELECT doc_id, CASE WHEN doc_id % 23 = 0 THEN NULL ELSE 'Title ' || doc_id END AS title,
             CASE WHEN doc_id % 29 = 0 THEN NULL ELSE 'F' || (doc_id % 7) END AS first_name,
             source AS last_name,
             CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN '40 BC'
                  ELSE CAST(1700 + (doc_id * 37) % 250 AS VARCHAR) END AS birth_year,
             CASE WHEN doc_id % 4 = 0 OR doc_id % 17 = 0 THEN NULL
                  ELSE CAST(1730 + (doc_id * 37) % 250 + doc_id % 50 AS VARCHAR) END AS death_year,
             lang AS language FROM documents""",
    "seqs": f"""
      SELECT p_partkey AS seq_id, translate(lower(p_name), '{DNA_FROM}', '{DNA_TO}') AS sequence,
             p_size % 2 AS promoter FROM part""",
    "journey_queries": """
      SELECT s_suppkey AS query_id, s_suppkey * 15 AS source,
             s_suppkey * 15 + s_suppkey % 15 AS target,
             CAST(21600 + (s_suppkey % 10) * 1800 AS BIGINT) AS depart_at FROM supplier""",
}


# recursive relations that keep one row per key
KEYED: dict[str, str] = {}


def register_sql(name: str, text: str, keyed: str = "") -> None:
    """Add a derived relation that only check SQL uses."""
    SQL_BINDINGS[name] = text
    if keyed:
        KEYED[name] = keyed


def with_bindings(sql: str) -> str:
    """Put the CTEs that ``sql`` mentions, directly or not, in front of it."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name, body in SQL_BINDINGS.items():
            if name not in order and re.search(rf"\b{name}\b", text) and body is not text:
                visit(body)
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql
    ctes = ",\n".join(f"{n}{KEYED.get(n, '')} AS ({SQL_BINDINGS[n]})" for n in order)
    stripped = re.sub(r"^\s*WITH\s+(RECURSIVE\s+)?", "", sql)
    joint = ",\n" if stripped != sql else "\n"
    return f"WITH RECURSIVE {ctes}{joint}{stripped}"
