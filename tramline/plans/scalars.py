"""Scalar functions, one query per family, and the UDF surface."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline import bindings as B
from tramline.bindings import hms_sql
from tramline.functions import text, timefn
from tramline.functions.geo import haversine
from tramline.plans.util import bigint, r
from tramline.registry import query
from tramline.session import table


@query(
    "fn_string_clean",
    """SELECT c_custkey, lower(trim('  ' || c_mktsegment || ' ')) AS seg, replace(c_name || chr(9) || 'x', chr(9), '')
       AS no_tab, CAST(c_nationkey AS VARCHAR) AS nation_text, trim(c_name, 'C9') AS stripped FROM customer""",
)
def fn_string_clean(spark, root):
    return table(spark, root, "customer").select(
        "c_custkey",
        F.lower(F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")))).alias("seg"),
        F.regexp_replace(F.concat("c_name", F.lit("\tx")), "\t", "").alias("no_tab"),
        F.col("c_nationkey").cast("string").alias("nation_text"),
        F.btrim("c_name", F.lit("C9")).alias("stripped"),
    )


@query(
    "fn_regex",
    """SELECT stop_id, CAST(nullif(regexp_extract(stop_code, '([0-9]+)', 1), '') AS DOUBLE) AS key,
       nullif(regexp_extract(stop_name, '#([a-z]+)', 1), '') AS none, stop_code LIKE 'Parent%' AS is_parent,
       regexp_matches(stop_code, '^[0-9]+$') AS is_plain FROM stops""",
)
def fn_regex(spark, root):
    return B.stops(spark, root).select(
        "stop_id",
        text.first_number("stop_code").cast("double").alias("key"),
        F.nullif(F.regexp_extract("stop_name", "#([a-z]+)", 1), F.lit("")).alias("none"),
        F.col("stop_code").like("Parent%").alias("is_parent"),
        F.col("stop_code").rlike("^[0-9]+$").alias("is_plain"),
    )


@query(
    "fn_split_pad_concat",
    """SELECT event_id, split_part(departure_time, ':', 1) AS hh, lpad(CAST(stop_id AS VARCHAR), 7, '0') AS padded,
       run_id || '-' || stop_id AS joined, concat_ws('/', departure_time, arrival_time) AS both FROM stop_times_text""",
)
def fn_split_pad_concat(spark, root):
    return B.stop_times_text(spark, root).select(
        "event_id",
        F.split_part("departure_time", F.lit(":"), F.lit(1)).alias("hh"),
        F.lpad(F.col("stop_id").cast("string"), 7, "0").alias("padded"),
        F.concat("run_id", F.lit("-"), "stop_id").alias("joined"),
        F.concat_ws("/", "departure_time", "arrival_time").alias("both"),
    )


@query(
    "fn_parse_service_time",
    """SELECT event_id, dep_s AS departure, CAST(CASE WHEN event_id % 9 = 0 THEN NULL ELSE arr_s END AS DOUBLE) AS arrival
       FROM stop_times""",
)
def fn_parse_service_time(spark, root):
    st = B.stop_times_text(spark, root)
    damaged = F.when(F.col("event_id") % 9 == 0, F.lit("25h00")).otherwise(F.col("arrival_time"))
    return st.select(
        "event_id",
        bigint(timefn.parse_service_time("departure_time")).alias("departure"),
        timefn.parse_service_time(damaged).cast("double").alias("arrival"),
    )


@query(
    "fn_format_seconds",
    f"SELECT event_id, {hms_sql('dep_s')} AS clock, '-' || {hms_sql('(dep_s + 1)')} AS negative FROM stop_times",
)
def fn_format_seconds(spark, root):
    return B.stop_times(spark, root).select(
        "event_id",
        timefn.format_seconds("dep_s").alias("clock"),
        timefn.format_seconds(-(F.col("dep_s") + 1)).alias("negative"),
    )


@query(
    "fn_words",
    """SELECT p_partkey, len(w) AS n_words, w[1] AS first_word, round(list_avg([length(x) FOR x IN w]), 6)
       AS mean_length, array_to_string([CASE WHEN length(x) < 2 THEN upper(x) ELSE
       upper(x[1]) || x[2:-2] || upper(x[-1]) END FOR x IN w], ' ') AS ends FROM (SELECT p_partkey,
       [x FOR x IN regexp_split_to_array(regexp_replace(lower(p_name || ', ' || p_brand || '! ' || p_type),
       '[[:punct:]\\s]+', ' ', 'g'), ' ') IF x <> ''] AS w FROM part)""",
)
def fn_words(spark, root):
    joined = F.concat("p_name", F.lit(", "), "p_brand", F.lit("! "), "p_type")
    w = table(spark, root, "part").select("p_partkey", text.words(joined).alias("w"))
    total = F.aggregate("w", F.lit(0), lambda a, x: a + F.length(x))
    return w.select(
        "p_partkey",
        bigint(F.size("w")).alias("n_words"),
        F.col("w")[0].alias("first_word"),
        r(total / F.size("w")).alias("mean_length"),
        F.array_join(F.transform("w", text.capitalise_ends), " ").alias("ends"),
    )


@query(
    "fn_path_date",
    "SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day FROM events",
)
def fn_path_date(spark, root):
    name = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("_events.parquet"))
    parts = [F.regexp_extract(name, r"(\d{4})-(\d{2})-(\d{2})_", i).try_cast("bigint") for i in (1, 2, 3)]
    return table(spark, root, "events").select(
        "event_id", *[p.alias(n) for p, n in zip(parts, ("year", "month", "day"))]
    )


@query(
    "fn_hash",
    """SELECT p_partkey, sha256(array_to_string(list_sort([lower(trim(x)) FOR x IN [p_type, p_brand, p_name]]), '|')) AS h
       FROM part""",
)
def fn_hash(spark, root):
    names = F.sort_array(F.transform(F.array("p_type", "p_brand", "p_name"), lambda x: F.lower(F.trim(x))))
    return table(spark, root, "part").select("p_partkey", F.sha2(F.array_join(names, "|"), 256).alias("h"))


@query(
    "fn_date_parts",
    """SELECT event_id, year(ts) AS y, month(ts) AS m, day(ts) AS d, hour(ts) AS h, minute(ts) AS mi,
       dayofyear(ts) AS doy, strftime(ts, '%Y-%m-%d %H:%M') AS label FROM events""",
)
def fn_date_parts(spark, root):
    parts = {
        "y": F.year("ts"), "m": F.month("ts"), "d": F.dayofmonth("ts"), "h": F.hour("ts"), "mi": F.minute("ts"),
        "doy": F.dayofyear("ts"),
    }
    return table(spark, root, "events").select(
        "event_id", *[bigint(c).alias(n) for n, c in parts.items()],
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("label"),
    )


@query("fn_iso_weekday", "SELECT o_orderkey, isodow(o_orderdate) AS dow FROM orders")
def fn_iso_weekday(spark, root):
    return table(spark, root, "orders").select("o_orderkey", bigint(timefn.iso_weekday("o_orderdate")).alias("dow"))


def _last_sunday(month: int, day: int) -> str:
    """01:00 UTC on the last Sunday of a month that ends on ``day``, in SQL, for the year of ``u``."""
    end = f"make_date(year(u), {month}, {day})"
    return f"(CAST({end} - CAST(dayofweek({end}) AS INTEGER) AS TIMESTAMP) + INTERVAL 1 HOUR)"


# Zurich rule since 1981: +1 h in winter, +2 h from the last Sunday of March to that of September, from 1996 of October
@query(
    "fn_epoch_local",
    f"""SELECT o_orderkey, strftime(u + CASE WHEN u >= {_last_sunday(3, 31)} AND
       u < CASE WHEN year(u) < 1996 THEN {_last_sunday(9, 30)} ELSE {_last_sunday(10, 31)} END
       THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END, '%Y-%m-%d %H:%M:%S')
       AS local FROM (SELECT o_orderkey, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS u FROM orders)""",
)
def fn_epoch_local(spark, root):
    o = table(spark, root, "orders")
    epoch = timefn.epoch_seconds("o_orderdate") + (F.col("o_orderkey") * 7919) % 86400
    return o.select("o_orderkey", F.date_format(timefn.local_time(epoch), "yyyy-MM-dd HH:mm:ss").alias("local"))


@query(
    "fn_epoch_diff",
    "SELECT event_id, CAST(epoch(dep_actual - dep_time) AS DOUBLE) AS dep_delay,"
    " CAST(epoch(arr_actual - arr_time) AS DOUBLE) AS arr_delay FROM visits",
)
def fn_epoch_diff(spark, root):
    return B.visits(spark, root).select(
        "event_id",
        timefn.seconds_between("dep_actual", "dep_time").cast("double").alias("dep_delay"),
        timefn.seconds_between("arr_actual", "arr_time").cast("double").alias("arr_delay"),
    )


@query("fn_interval", "SELECT event_id, CAST(epoch(dep_actual - arr_time) AS DOUBLE) AS dwell_s FROM visits")
def fn_interval(spark, root):
    gap = F.col("dep_actual") - F.col("arr_time")
    return B.visits(spark, root).select("event_id", gap.cast("bigint").cast("double").alias("dwell_s"))


@query(
    "fn_to_timestamp",
    "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN date_trunc('second', ts) END AS parsed FROM events",
)
def fn_to_timestamp(spark, root):
    shown = F.when(F.col("event_id") % 10 == 0, F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    return table(spark, root, "events").select(
        "event_id", F.try_to_timestamp(shown, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("parsed")
    )


@query(
    "fn_haversine",
    """SELECT stop_id, round(m, 3) AS metres, round(m / 1000, 6) AS km FROM (SELECT stop_id, 2 * 6371000 *
       atan2(sqrt(h), sqrt(1 - h)) AS m FROM (SELECT stop_id, pow(sin(radians(lat - 46.5) / 2), 2) +
       cos(radians(46.5)) * cos(radians(lat)) * pow(sin(radians(lon - 6.6) / 2), 2) AS h FROM stops))""",
)
def fn_haversine(spark, root):
    d = haversine(F.lit(46.5), F.lit(6.6), "lat", "lon")
    return B.stops(spark, root).select("stop_id", r(d, 3).alias("metres"), r(d / 1000).alias("km"))


@query(
    "fn_math",
    """SELECT event_id, abs(value - 50) AS dev, round(value, 1) AS rounded, round(sqrt(value), 6) AS root,
       round(pow(value, 2), 4) AS squared, event_id % 7 AS remainder,
       CASE WHEN x1 * x1 * x1 / 100 - x1 * x2 / 2 + x2 * x2 / 400 > 0 THEN 1 ELSE 0 END AS sign
       FROM (SELECT *, value - 40 AS x1, value / 3 AS x2 FROM events)""",
)
def fn_math(spark, root):
    v = F.col("value")
    x1, x2 = v - 40, v / 3
    cubic = x1 * x1 * x1 / 100 - x1 * x2 / 2 + x2 * x2 / 400
    return table(spark, root, "events").select(
        "event_id", F.abs(v - 50).alias("dev"), r(v, 1).alias("rounded"), r(F.sqrt(v)).alias("root"),
        r(F.pow(v, F.lit(2)), 4).alias("squared"), (F.col("event_id") % 7).alias("remainder"),
        F.when(cubic > 0, 1).otherwise(0).alias("sign"),
    )


@query(
    "fn_array_map_json",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS first, 2 AS size,
       event_type = 'click' AS has_click, CAST(user_id AS VARCHAR) AS looked_up FROM events""",
)
def fn_array_map_json(spark, root):
    e = table(spark, root, "events")
    pair = F.array("event_type", F.col("user_id").cast("string"))
    as_map = F.from_json(F.to_json(F.struct(F.struct("user_id").alias("who"))), "map<string,struct<user_id:string>>")
    return e.select(
        "event_id",
        F.from_json("props", "struct<k:bigint>").k.alias("k"),
        F.element_at(pair, 1).alias("first"),
        F.size(pair).alias("size"),
        F.array_contains(pair, "click").alias("has_click"),
        F.element_at(as_map, "who").user_id.alias("looked_up"),
    )


@query(
    "fn_poly_expand",
    """SELECT l_orderkey, l_linenumber, l_partkey, 1e0 AS bias, l_quantity AS a, l_discount AS b,
       round(l_quantity * l_quantity, 6) AS aa, round(l_quantity * l_discount, 6) AS ab,
       round(l_discount * l_discount, 6) AS bb FROM lineitem""",
)
def fn_poly_expand(spark, root):
    li = table(spark, root, "lineitem")
    feats = poly2([F.col("l_quantity"), F.col("l_discount")])
    names = ("bias", "a", "b", "aa", "ab", "bb")
    cols = [f.alias(n) if len(n) != 2 else r(f).alias(n) for f, n in zip(feats, names)]
    return li.select("l_orderkey", "l_linenumber", "l_partkey", *cols)


def poly2(cols: list) -> list:
    """All monomials up to degree 2 with the constant: 1, x_i, x_i * x_j for i <= j."""
    pairs = [a * b for i, a in enumerate(cols) for b in cols[i:]]
    return [F.lit(1.0), *cols, *pairs]


@query(
    "fn_boolean_numeric",
    "SELECT event_id, CAST(failed AS DOUBLE) AS failed_num, CAST(delay_s > 60 AS INTEGER) AS late FROM visits",
)
def fn_boolean_numeric(spark, root):
    return B.visits(spark, root).select(
        "event_id", F.col("failed").cast("double").alias("failed_num"), (F.col("delay_s") > 60).cast("int").alias("late")
    )


# ---- UDF surface ---------------------------------------------------------------------------


@F.pandas_udf(T.StringType())
def lower_arrow(s: pd.Series) -> pd.Series:
    return s.str.lower()


@query("udf_scalar", "SELECT c_custkey, lower(c_name) AS via_udf, lower(c_name) AS via_builtin FROM customer")
def udf_scalar(spark, root):
    """A vectorised Python function beside the built-in; the built-in is the one to use."""
    return table(spark, root, "customer").select(
        "c_custkey", lower_arrow("c_name").alias("via_udf"), F.lower("c_name").alias("via_builtin")
    )


def shift_by(delta: float):
    """A column function that captures a constant; plain column arithmetic needs no UDF."""
    return lambda column: F.col(column) + F.lit(float(delta))


@query(
    "udf_closure",
    "SELECT event_id, delay_s + 12.5e0 AS q50, delay_s + 40e0 AS q90 FROM visits",
)
def udf_closure(spark, root):
    return B.visits(spark, root).select(
        "event_id", shift_by(12.5)("delay_s").alias("q50"), shift_by(40)("delay_s").alias("q90")
    )


@query(
    "udf_grouped_map",
    "SELECT event_id, round(value - avg(value) OVER (PARTITION BY user_id), 9) AS centred FROM events",
)
def udf_grouped_map(spark, root):
    """A per-group transform as aggregate plus join, so no group has to fit one Python worker."""
    e = table(spark, root, "events").select("event_id", "user_id", "value")
    means = e.groupBy("user_id").agg(F.avg("value").alias("m"))
    return e.join(means, "user_id").select("event_id", r(F.col("value") - F.col("m"), 9).alias("centred"))


def squares_of_batches(batches):
    """Sequence step: fold one Arrow batch at a time into (key, partial)."""
    for pdf in batches:
        pdf["p"] = pdf["value"] ** 2
        yield pdf.groupby("user_id", as_index=False)["p"].sum()


@query("udaf_custom", "SELECT user_id, round(sum(value * value), 4) AS sum_sq FROM events GROUP BY user_id")
def udaf_custom(spark, root):
    """A user aggregate: the sequence step in Python per batch, the combine step built in.

    Partials shrink before the shuffle and no key is ever gathered in Python.
    """
    e = table(spark, root, "events").select("user_id", "value")
    partial = e.mapInPandas(squares_of_batches, "user_id bigint, p double")
    return partial.groupBy("user_id").agg(r(F.sum("p"), 4).alias("sum_sq"))


@query(
    "udtf_flatmap",
    "SELECT p_partkey, i AS pos, substr(p_name, CAST(i AS INTEGER), 3) AS gram FROM (SELECT p_partkey, p_name,"
    " unnest(range(1, length(p_name) - 1)) AS i FROM part)",
)
def udtf_flatmap(spark, root):
    p = table(spark, root, "part")
    starts = F.sequence(F.lit(1), F.length("p_name") - 2)
    rows = p.where(F.length("p_name") >= 3).select("p_partkey", "p_name", F.explode(starts).alias("i"))
    return rows.select("p_partkey", bigint("i").alias("pos"), F.substring("p_name", F.col("i"), F.lit(3)).alias("gram"))
