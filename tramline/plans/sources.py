"""Sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tramline import bindings as B
from tramline.plans.util import bigint, r
from tramline.registry import query
from tramline.session import cut_lineage, scratch_path, table
from tramline.sources import readers, writers


def unique_name(name: str) -> str:
    """A table name that no other run in the same catalog uses."""
    return f"tramline_{name}_{uuid.uuid4().hex[:12]}"


@query(
    "scan_parquet",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'",
)
def scan_parquet(spark, root):
    df = readers.read_parquet(spark, f"{root}/orders.parquet")
    return df.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "scan_partitioned",
    "SELECT event_id, user_id, month(ts) AS month, day(ts) AS day FROM events WHERE day(ts) BETWEEN 10 AND 12",
)
def scan_partitioned(spark, root):
    df = table(spark, root, "events").select("event_id", "user_id", "ts")
    path = writers.write_by_date(df, scratch_path(spark, "by_date"), "ts")
    part = readers.read_partitioned(spark, path, F.col("day").between(10, 12))
    return part.select("event_id", "user_id", bigint("month").alias("month"), bigint("day").alias("day"))


@query(
    "scan_csv",
    "SELECT s_suppkey, s_name, s_acctbal, CAST(DATE '2024-01-01' + CAST(s_suppkey % 28 AS INTEGER)"
    " AS VARCHAR)[:10] AS since FROM supplier",
)
def scan_csv(spark, root):
    df = table(spark, root, "supplier").select(
        "s_suppkey", "s_name", "s_acctbal",
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("s_suppkey") % 28).cast("int")),
                      "dd.MM.yyyy").alias("since"),
    )
    path = writers.write_csv(df, scratch_path(spark, "csv"), sep=";")
    schema = "s_suppkey bigint, s_name string, s_acctbal double, since date"
    got = readers.read_csv(spark, path, schema, sep=";", date_format="dd.MM.yyyy")
    return got.withColumn("since", F.col("since").cast("string"))


NESTED = "block bigint, observations array<struct<valid_time_gmt:bigint,temp:double,obs_name:string>>"


def nested_events(spark, root):
    """Documents of at most 50 observations each, written as JSON."""
    e = table(spark, root, "events").select(
        F.expr("event_id DIV 50").alias("block"),
        F.struct(
            F.col("event_id").alias("valid_time_gmt"), F.col("value").alias("temp"),
            F.col("event_type").alias("obs_name"),
        ).alias("o"),
    )
    docs = e.groupBy("block").agg(F.sort_array(F.collect_list("o")).alias("observations"))
    return writers.write_json(docs, scratch_path(spark, "nested"))


@query(
    "scan_json_nested",
    "SELECT event_id // 50 AS block, count(*) AS n, min(event_id) AS first_id,"
    " arg_min(event_type, event_id) AS first_name FROM events GROUP BY 1",
)
def scan_json_nested(spark, root):
    df = readers.read_json(spark, nested_events(spark, root), NESTED)
    first = F.col("observations")[0]
    return df.select(
        "block",
        bigint(F.size("observations")).alias("n"),
        first["valid_time_gmt"].alias("first_id"),
        first["obs_name"].alias("first_name"),
    )


@query("scan_kv_corpus", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, length(COALESCE(text, '')) AS chars FROM documents")
def scan_kv_corpus(spark, root):
    path = writers.write_sequence_file(table(spark, root, "documents"), scratch_path(spark, "corpus"), "doc_id", "text")
    return readers.read_sequence_file(spark, path).select("doc_id", bigint(F.length("text")).alias("chars"))


@query("scan_json_map", "SELECT CAST(doc_id AS VARCHAR) AS id, title, birth_year, language FROM meta")
def scan_json_map(spark, root):
    m = B.meta(spark, root)
    entry = F.struct(F.col("doc_id").cast("string"), F.struct("title", "birth_year", "language"))
    objects = m.groupBy(F.expr("doc_id DIV 100")).agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")
    )
    path = scratch_path(spark, "json_map")
    objects.select("value").write.text(path)
    return readers.read_json_map(spark, path, "struct<title:string,birth_year:string,language:string>")


# fixed values: words added to the stop-word list
EXTRA_STOP_WORDS = [
    "gutenbergtm", "gutenberg", "electronic", "foundation", "license", "copyright", "donation", "donations",
]


@query(
    "scan_word_list",
    "SELECT DISTINCT lower(word) AS word FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part"
    " UNION ALL SELECT unnest(["
    + ", ".join(f"'{w}'" for w in EXTRA_STOP_WORDS)
    + "])) WHERE word <> ''",
)
def scan_word_list(spark, root):
    words = table(spark, root, "part").select(F.explode(F.split("p_name", " ")).alias("value")).distinct()
    path = scratch_path(spark, "words")
    words.write.text(path)
    extra = spark.createDataFrame([(w,) for w in EXTRA_STOP_WORDS], "word string")
    return readers.read_word_list(spark, path, extra)


@query("scan_catalog", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_catalog(spark, root):
    name = unique_name("nation")
    writers.create_table_as(table(spark, root, "nation"), name, scratch_path(spark, "nation"))
    return readers.read_table(spark, f"spark_catalog.default.{name}")


@query(
    "scan_memory",
    "SELECT n_regionkey, count(*) AS nations, CAST(sum(w) AS BIGINT) AS weight FROM nation"
    " JOIN (VALUES (0, 10), (1, 20), (2, 30), (3, 40), (4, 50)) v(k, w) ON k = n_regionkey GROUP BY 1",
)
def scan_memory(spark, root):
    weights = spark.createDataFrame([(i, (i + 1) * 10) for i in range(5)], "k int, w int")
    n = table(spark, root, "nation")
    return (
        n.join(weights, n.n_regionkey == weights.k)
        .groupBy("n_regionkey")
        .agg(F.count(F.lit(1)).alias("nations"), F.sum("w").alias("weight"))
    )


@query("temp_view", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment")
def temp_view(spark, root):
    table(spark, root, "customer").createOrReplaceTempView("tramline_customer")
    return spark.sql("SELECT c_mktsegment, count(*) AS n FROM tramline_customer GROUP BY c_mktsegment")


@query(
    "describe_schema",
    """SELECT CAST(column_index - 1 AS INTEGER) AS position, column_name, CASE data_type WHEN 'INTEGER' THEN 'int'
       WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS data_type
       FROM duckdb_columns() WHERE table_name = 'lineitem'""",
)
def describe_schema(spark, root):
    return readers.describe(table(spark, root, "lineitem"))


@query("write_parquet", "SELECT event_id, event_type, value FROM events")
def write_parquet(spark, root):
    df = table(spark, root, "events").select("event_id", "event_type", "value")
    return readers.read_parquet(spark, writers.write_parquet(df, scratch_path(spark, "parquet")))


@query("write_csv", "SELECT p_partkey, p_name, p_retailprice FROM part")
def write_csv(spark, root):
    df = table(spark, root, "part").select("p_partkey", "p_name", "p_retailprice")
    path = writers.write_csv(df, scratch_path(spark, "csv"))
    return readers.read_csv(spark, path, "p_partkey bigint, p_name string, p_retailprice double")


@query(
    "write_partitioned",
    "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n,"
    " round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2",
)
def write_partitioned(spark, root):
    """Two runs over one folder: the second one finds the days of the first one finished."""
    df = table(spark, root, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    # one directory per month keeps the number of small files low at this scale
    monthly = df.withColumn("month_start", F.trunc("o_orderdate", "month"))
    path = scratch_path(spark, "by_date")
    writers.write_new_days(monthly.where("year(o_orderdate) < 1995"), path, "month_start")
    # old months come again with other prices and must not be written
    again = monthly.withColumn("o_totalprice", F.when(F.year("o_orderdate") < 1995, 0.0).otherwise(F.col("o_totalprice")))
    writers.write_new_days(again, path, "month_start")
    got = readers.read_partitioned(spark, path)
    return got.groupBy(bigint("year").alias("year"), bigint("month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "write_clustered",
    "SELECT event_id, stop_id, isodow(sched) AS weekday, hour(sched) // 6 AS band FROM visits",
)
def write_clustered(spark, root):
    v = B.visits(spark, root).select("event_id", "stop_id", "sched")
    path = writers.write_clustered(
        v,
        scratch_path(spark, "clustered"),
        {"weekday": F.weekday("sched") + 1, "band": F.floor(F.hour("sched") / 6)},
        ["stop_id", "sched"],
    )
    return readers.read_partitioned(spark, path).select(
        "event_id", "stop_id", bigint("weekday").alias("weekday"), bigint("band").alias("band")
    )


@query("ctas", "SELECT user_id, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY user_id")
def ctas(spark, root):
    df = table(spark, root, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), r(F.avg("value")).alias("mean_value")
    )
    return writers.create_table_as(df, unique_name("user_stats"), scratch_path(spark, "ctas"))


@query("insert_select", "SELECT stop_id, stop_name, lat FROM stops")
def insert_select(spark, root):
    df = B.stops(spark, root).select("stop_id", "stop_name", "lat")
    ddl = "stop_id BIGINT, stop_name STRING, lat DOUBLE"
    return writers.insert_select(df, unique_name("stops"), ddl, scratch_path(spark, "insert"))


@query("schema_ddl", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def schema_ddl(spark, root):
    """Create and use a schema of its own, fill a table by its bare name, read it back, drop all."""
    name, before = unique_name("lab"), spark.catalog.currentDatabase()
    writers.create_schema(spark, name, use=True)
    try:
        df = table(spark, root, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        return cut_lineage(writers.create_table_as(df, "event_counts", scratch_path(spark, "lab")))
    finally:
        spark.catalog.setCurrentDatabase(before)
        writers.drop_schema(spark, name)


@query("materialize", "SELECT sensor, count(value) AS n, round(max(value), 6) AS top FROM readings GROUP BY sensor")
def materialize(spark, root):
    rows = B.readings(spark, root).groupBy("sensor").agg(
        F.count("value").alias("n"), r(F.max("value")).alias("top")
    )
    return cut_lineage(rows)


@query("storage_report")
def storage_report(spark, root):
    df = table(spark, root, "orders")
    roots = {
        "parquet": writers.write_parquet(df, scratch_path(spark, "fmt")),
        "csv": writers.write_csv(df, scratch_path(spark, "fmt")),
        "json": writers.write_json(df, scratch_path(spark, "fmt")),
    }
    return readers.storage_report(spark, roots)
