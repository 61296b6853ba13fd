"""Projections, filters and row shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline import bindings as B
from tramline.operators import shaping
from tramline.plans.sources import NESTED, nested_events
from tramline.registry import query
from tramline.session import scratch_path, table
from tramline.sources import readers


@query("project_nested", "SELECT event_id // 50 AS block, event_id AS valid_time_gmt, value AS temp FROM events")
def project_nested(spark, root):
    df = readers.read_json(spark, nested_events(spark, root), NESTED)
    flat = df.select("block", F.explode("observations").alias("observation"))
    return flat.select("block", "observation.valid_time_gmt", "observation.temp")


@query(
    "cast_columns",
    "SELECT doc_id, TRY_CAST(birth_year AS DOUBLE) AS birth, TRY_CAST(death_year AS DOUBLE) AS death,"
    " CAST(doc_id AS VARCHAR) AS id_text FROM meta",
)
def cast_columns(spark, root):
    return B.meta(spark, root).select(
        "doc_id",
        F.col("birth_year").try_cast("double").alias("birth"),
        F.col("death_year").try_cast("double").alias("death"),
        F.col("doc_id").cast("string").alias("id_text"),
    )


@query("rename_drop_reorder", "SELECT c_name AS name, c_custkey AS id, c_acctbal FROM customer")
def rename_drop_reorder(spark, root):
    df = table(spark, root, "customer").withColumnsRenamed({"c_custkey": "id", "c_name": "name"})
    return df.drop("c_nationkey", "c_mktsegment").select("name", "id", "c_acctbal")


@query(
    "filter_predicates",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity BETWEEN 10 AND 20"
    " AND l_returnflag IN ('A', 'N') AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_discount IS NOT NULL"
    " AND NOT (l_linestatus = 'F') AND l_tax < 0.05",
)
def filter_predicates(spark, root):
    c = F.col
    return (
        table(spark, root, "lineitem")
        .where(c("l_quantity").between(10, 20) & c("l_returnflag").isin("A", "N"))
        .where(c("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        .where(c("l_discount").isNotNull() & ~(c("l_linestatus") == "F"))
        .where("l_tax < 0.05D")
        .select("l_orderkey", "l_linenumber", "l_partkey")
    )


@query(
    "filter_boundary_times",
    "SELECT event_id, ts FROM events WHERE (strftime(ts, '%m-%d') = '01-01' AND hour(ts) < 2)"
    " OR (CAST(ts AS DATE) = DATE '2024-01-29' AND hour(ts) >= 22) OR strftime(ts, '%H:%M') = '23:59'",
)
def filter_boundary_times(spark, root):
    ts = F.col("ts")
    new_year = (F.date_format(ts, "MM-dd") == "01-01") & (F.hour(ts) < 2)
    night = (F.to_date(ts) == F.lit("2024-01-29").cast("date")) & (F.hour(ts) >= 22)
    return table(spark, root, "events").where(
        new_year | night | (F.date_format(ts, "HH:mm") == "23:59")
    ).select("event_id", "ts")


@query(
    "full_periods_only",
    """SELECT event_id, user_id FROM events WHERE user_id IN
       (SELECT user_id FROM (SELECT DISTINCT user_id, day(ts) AS dd FROM events)
        GROUP BY 1 HAVING count(*) >= 28)""",
)
def full_periods_only(spark, root):
    e = table(spark, root, "events").select("event_id", "user_id", "ts")
    return shaping.complete_periods(e, "user_id", [F.month("ts"), F.dayofmonth("ts")], 28).select(
        "event_id", "user_id"
    )


@query(
    "case_when",
    "SELECT event_id, CASE WHEN value > 100 THEN 'high' WHEN value > 20 THEN 'mid' ELSE 'low' END AS band,"
    " CASE WHEN value > 100 THEN 1 ELSE 0 END AS label FROM events",
)
def case_when(spark, root):
    v = F.col("value")
    return table(spark, root, "events").select(
        "event_id",
        F.when(v > 100, "high").when(v > 20, "mid").otherwise("low").alias("band"),
        F.when(v > 100, 1).otherwise(0).alias("label"),
    )


@query(
    "classify_format",
    """SELECT CASE WHEN regexp_full_match(stop_code, '[0-9]+') THEN 'plain'
              WHEN regexp_full_match(stop_code, 'Parent[0-9]+') THEN 'parent'
              WHEN regexp_full_match(stop_code, '[0-9]+:[^:]*:[^:]*') THEN 'platform'
              ELSE 'other' END AS id_class, count(*) AS n FROM stops GROUP BY 1""",
)
def classify_format(spark, root):
    return shaping.format_classes(B.stops(spark, root), "stop_code")


@query("limit_take", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def limit_take(spark, root):
    return (
        table(spark, root, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(25)
    )


@query(
    "sample_rows",
    """SELECT 'keys' AS method, event_id, value FROM events WHERE (event_id * 7919) % 100 < 20 UNION ALL
       SELECT 'blocks', event_id, value FROM events
       WHERE CAST('0x' || substr(md5('block=' || (event_id % 50)), 1, 8) AS BIGINT) < 0.2 * 4294967296""",
)
def sample_rows(spark, root):
    """A fifth of the keys, and a fifth of the blocks of the same rows laid out in 50 blocks."""
    e = table(spark, root, "events").select("event_id", "value")
    keys = shaping.key_sample(e, "event_id", 20)
    path = scratch_path(spark, "blocks")
    e.withColumn("block", F.col("event_id") % 50).repartition("block").write.partitionBy("block").parquet(path)
    blocks = readers.block_sample(spark, path, 0.2).select("event_id", "value")
    return keys.withColumn("method", F.lit("keys")).unionByName(blocks.withColumn("method", F.lit("blocks")))


@query("sample_seeded")
def sample_seeded(spark, root):
    return table(spark, root, "events").select("event_id", "value").sample(False, 0.2, seed=42)


@query("random_split")
def random_split(spark, root):
    e = table(spark, root, "events").select("event_id", "value")
    return shaping.hash_split(e, "event_id", {"train": 70, "valid": 15, "test": 15})


@query("distinct_rows", "SELECT DISTINCT trip_id, CAST(operating_day AS VARCHAR) AS operating_day FROM visits")
def distinct_rows(spark, root):
    return B.visits(spark, root).select("trip_id", F.col("operating_day").cast("string")).distinct()


@query(
    "drop_duplicates",
    "SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2",
)
def drop_duplicates(spark, root):
    li = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return shaping.one_per_key(li, ["l_orderkey", "l_linenumber"], ["l_partkey"])


@query(
    "latest_per_key",
    "SELECT * EXCLUDE rn FROM (SELECT user_id, event_id, ts, value, row_number() OVER"
    " (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
)
def latest_per_key(spark, root):
    e = table(spark, root, "events").select("user_id", "event_id", "ts", "value")
    return shaping.one_per_key(e, ["user_id"], ["ts", "event_id"], latest=True)


@query("explode_array", "SELECT doc_id, unnest(string_split(source || '/' || lang, '/')) AS piece FROM documents")
def explode_array(spark, root):
    d = table(spark, root, "documents")
    return d.select("doc_id", F.explode(F.split(F.concat_ws("/", "source", "lang"), "/")).alias("piece"))


@query(
    "unpivot_structs",
    """SELECT event_id, 'arr' AS evt_type, arr_actual AS evt_time FROM visits UNION ALL
       SELECT event_id, 'dep', dep_actual FROM visits""",
)
def unpivot_structs(spark, root):
    v = B.visits(spark, root)
    return shaping.typed_events(v, ["event_id"], {"arr": "arr_actual", "dep": "dep_actual"})


# wide sensor file: one column per sensor and measure, names with a dot
_WIDE = {
    "1.temperature": "CASE WHEN event_type = 'click' THEN value END",
    "1.humidity": "CASE WHEN event_type = 'view' THEN value END",
    "2.temperature": "CASE WHEN event_type = 'error' THEN value END",
    "2.humidity": "CASE WHEN event_type = 'signup' THEN value END",
}
_WIDE_SQL = " UNION ALL ".join(
    f"SELECT event_id AS t, '{k.split('.')[0]}' AS sensor, '{k.split('.')[1]}' AS measure, {v} AS value FROM events"
    for k, v in _WIDE.items()
)


def wide_sensors(spark, root):
    e = table(spark, root, "events")
    return e.select(F.col("event_id").alias("t"), *[F.expr(v).alias(k) for k, v in _WIDE.items()])


@query("unpivot_wide", f"SELECT * FROM ({_WIDE_SQL}) WHERE value IS NOT NULL")
def unpivot_wide(spark, root):
    return shaping.wide_to_long(wide_sensors(spark, root), "t").where("value IS NOT NULL")


@query(
    "pivot_long",
    f"SELECT t, sensor, max(CASE WHEN measure = 'temperature' THEN value END) AS temperature,"
    f" max(CASE WHEN measure = 'humidity' THEN value END) AS humidity FROM ({_WIDE_SQL}) GROUP BY t, sensor",
)
def pivot_long(spark, root):
    long = shaping.wide_to_long(wide_sensors(spark, root), "t")
    return long.groupBy("t", "sensor").pivot("measure", ["temperature", "humidity"]).agg(F.max("value"))


@query(
    "pivot_dynamic",
    "SELECT user_id, "
    + ", ".join(
        f"count(*) FILTER (WHERE event_type = '{t}') AS \"{t}\""
        for t in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM events GROUP BY user_id",
)
def pivot_dynamic(spark, root):
    e = table(spark, root, "events").select("user_id", "event_type")
    wide = shaping.pivot_discovered(e, ["user_id"], "event_type", F.count(F.lit(1)))
    return wide.na.fill(0)


@query(
    "compose_key",
    "SELECT event_id, trip_id || '_' || strftime(operating_day, '%Y-%m-%d') AS journey_id,"
    " concat_ws(', ', product_id, CAST(line_id AS VARCHAR)) AS label FROM visits",
)
def compose_key(spark, root):
    return B.visits(spark, root).select(
        "event_id",
        F.concat_ws("_", "trip_id", F.date_format("operating_day", "yyyy-MM-dd")).alias("journey_id"),
        F.concat_ws(", ", "product_id", "line_id").alias("label"),
    )


@query("row_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS idx FROM orders")
def row_id(spark, root):
    o = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    return shaping.dense_index(o, ["o_totalprice", "o_orderkey"], "idx").select("o_orderkey", "idx")


@query(
    "fill_nulls",
    "SELECT from_stop, to_stop, COALESCE(min_transfer_time, 120) AS min_transfer_time FROM transfers",
)
def fill_nulls(spark, root):
    return B.transfers(spark, root).na.fill({"min_transfer_time": 120})


@query(
    "filter_metadata_quality",
    "SELECT doc_id, last_name, birth_year FROM meta WHERE title IS NOT NULL AND first_name IS NOT NULL"
    " AND last_name IS NOT NULL AND birth_year IS NOT NULL AND birth_year NOT LIKE '%BC%'"
    " AND COALESCE(death_year, '') NOT LIKE '%BC%'",
)
def filter_metadata_quality(spark, root):
    return shaping.usable_metadata(B.meta(spark, root)).select("doc_id", "last_name", "birth_year")


@query("rdd_map_filter", "SELECT event_id, event_id * event_id AS squared FROM events WHERE (event_id * event_id) % 3 = 1")
def rdd_map_filter(spark, root):
    x = table(spark, root, "events").select("event_id", (F.col("event_id") * F.col("event_id")).alias("squared"))
    return x.where("squared % 3 = 1")


@query(
    "repartition_by_key",
    """SELECT line_id, CAST(ceil(n / ceil((SELECT count(*) FROM visits) / 16e0)) AS BIGINT) AS partitions, n
       FROM (SELECT line_id, count(*) AS n FROM visits GROUP BY line_id)""",
)
def repartition_by_key(spark, root):
    v = B.visits(spark, root).select("line_id", "event_id")
    placed = shaping.spread_keys(v, ["line_id"], 16, ["event_id"]).withColumn("part", F.spark_partition_id())
    return placed.groupBy("line_id").agg(
        F.countDistinct("part").alias("partitions"), F.count(F.lit(1)).alias("n")
    )


@query("key_by", "SELECT event_id % 5 AS k, event_id AS v FROM events")
def key_by(spark, root):
    return table(spark, root, "events").select((F.col("event_id") % 5).alias("k"), F.col("event_id").alias("v"))


# ---- sorts, limits, top-k, set operations -------------------------------------------------


@query("sort_multi", "SELECT event_id, arr_time, delay_s FROM visits ORDER BY arr_time NULLS FIRST, delay_s DESC, event_id")
def sort_multi(spark, root):
    v = B.visits(spark, root).select("event_id", "arr_time", "delay_s")
    return v.orderBy(F.asc_nulls_first("arr_time"), F.desc_nulls_last("delay_s"), F.asc("event_id"))


@query("sort_by_value", "SELECT user_id % 5 AS k, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY 1")
def sort_by_value(spark, root):
    e = table(spark, root, "events")
    return e.groupBy((F.col("user_id") % 5).alias("k")).agg(F.sum("event_id").alias("total")).orderBy(F.desc("total"))


@query(
    "top_k",
    "SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 20",
)
def top_k(spark, root):
    counts = table(spark, root, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "user_id").limit(20)


@query(
    "top_k_per_key",
    "SELECT o_custkey, o_orderkey, o_totalprice, rn AS rank FROM (SELECT *, row_number() OVER"
    " (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3",
)
def top_k_per_key(spark, root):
    o = table(spark, root, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return shaping.top_per_key(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query(
    "union_by_name",
    "SELECT event_id, 'planned' AS kind, sched AS at FROM visits UNION ALL"
    " SELECT event_id, 'actual', dep_actual FROM visits WHERE dep_actual IS NOT NULL",
)
def union_by_name(spark, root):
    v = B.visits(spark, root)
    planned = v.select("event_id", F.lit("planned").alias("kind"), F.col("sched").alias("at"))
    actual = v.where("dep_actual IS NOT NULL").select(
        F.col("dep_actual").alias("at"), "event_id", F.lit("actual").alias("kind")
    )
    return planned.unionByName(actual)


@query(
    "concat_rows",
    "SELECT 'customer' AS origin, c_custkey AS id, c_acctbal AS balance FROM customer"
    " UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier",
)
def concat_rows(spark, root):
    c = table(spark, root, "customer").select(
        F.lit("customer").alias("origin"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")
    )
    s = table(spark, root, "supplier").select(
        F.lit("supplier").alias("origin"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")
    )
    return shaping.stack_rows([c, s])


@query("set_difference", "SELECT c_custkey AS id FROM customer EXCEPT SELECT stop_id FROM visits")
def set_difference(spark, root):
    all_ids = table(spark, root, "customer").select(F.col("c_custkey").alias("id"))
    return all_ids.subtract(B.visits(spark, root).select("stop_id"))


@query(
    "set_union_words",
    "SELECT unnest(string_split(p_name, ' ')) AS word FROM part UNION SELECT DISTINCT lower(p_type) FROM part",
)
def set_union_words(spark, root):
    p = table(spark, root, "part")
    words = p.select(F.explode(F.split("p_name", " ")).alias("word"))
    return words.union(p.select(F.lower("p_type"))).distinct()
