"""Label tables of round-based searches, and route patterns of a timetable.

A label table keeps what a search has found so far, keyed by two columns. It is bucketed by
them, so that a round's candidates are shuffled once and meet the table where it lies;
a round appends its improvements and never rewrites what is there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.session import scratch_path

ROUND = "_round"


class LabelTable:
    """Rows by ``key``, in rounds; the files lie in the shared folder for stages."""

    def __init__(self, spark: SparkSession, key: list[str]):
        self.spark, self.key, self.rounds = spark, key, 0
        self.name = f"tramline_labels_{uuid.uuid4().hex}"
        self.path = scratch_path(spark, "labels")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def append(self, rows: DataFrame) -> DataFrame:
        """Write the rows of a new round and return them as they were written."""
        out = rows.withColumn(ROUND, F.lit(self.rounds)).repartition(self.buckets, *self.key)
        writer = out.write.format("parquet").option("path", self.path).mode("append" if self.rounds else "error")
        writer.partitionBy(ROUND).bucketBy(self.buckets, *self.key).saveAsTable(self.name)
        self.rounds += 1
        return self.latest()

    def all(self) -> DataFrame:
        return self.spark.table(self.name).drop(ROUND)

    def latest(self) -> DataFrame:
        return self.spark.table(self.name).where(F.col(ROUND) == self.rounds - 1).drop(ROUND)

    def better(self, rows: DataFrame, value: str) -> DataFrame:
        """Of ``rows`` (one per key) those whose ``value`` is below all in the table."""
        if not self.rounds:
            return rows
        old = self.all().select(*self.key, F.col(value).alias("_old"))
        rest = [c for c in rows.columns if c not in self.key]
        met = rows.hint("shuffle_hash").join(old, self.key, "left").groupBy(*self.key)
        # the candidate's columns are equal in all rows of a key
        met = met.agg(*[F.first(c).alias(c) for c in rest], F.min("_old").alias("_old"))
        return met.where(f"_old IS NULL OR {value} < _old").drop("_old")

    def least(self, value: str) -> DataFrame:
        return self.all().groupBy(*self.key).agg(F.min(value).alias(value))

    def drop(self) -> None:
        """Take the table out of the catalog; its files stay until the application's folder is dropped."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def route_patterns(timetable: DataFrame) -> DataFrame:
    """The timetable with ``pattern_id``, ``run_no`` and ``prev_dep``.

    Runs of a pattern call at the same stops in the same order and none overtakes another:
    ordered by ``run_no`` neither departures nor arrivals decrease at any stop. A run that
    is earlier somewhere than one that started before it is a pattern of its own. Whoever is
    ready after ``prev_dep`` (the departure of the run before; null for the first) and not
    after ``dep_s`` takes this run, so a label meets one run of a pattern.
    """
    start = F.min_by("dep_s", "seq").alias("first_dep")
    signs = [F.bit_xor(F.xxhash64(F.lit(i), "seq", "stop_id")).alias(f"_s{i}") for i in range(2)]
    runs = timetable.groupBy("run_id").agg(start, *signs, F.count(F.lit(1)).alias("_s2"))
    same = [f"_s{i}" for i in range(3)]
    named = runs.groupBy(*same).agg(F.min("run_id").alias("_first"))
    rows = timetable.join(runs.join(named, same).drop(*same), "run_id")
    ahead = Window.partitionBy("_first", "seq").orderBy("first_dep", "run_id").rowsBetween(Window.unboundedPreceding, -1)
    early = F.coalesce((F.col("arr_s") < F.max("arr_s").over(ahead)) | (F.col("dep_s") < F.max("dep_s").over(ahead)), F.lit(False))
    rows = rows.withColumn("_early", early)
    alone = rows.groupBy("run_id").agg(F.max("_early").alias("_alone"))
    rows = rows.join(alone, "run_id").withColumn(
        "pattern_id", F.when(F.col("_alone"), 2 * F.col("run_id") + 1).otherwise(2 * F.col("_first"))
    )
    at = Window.partitionBy("pattern_id", "seq").orderBy("first_dep", "run_id")
    placed = rows.withColumns({"run_no": F.row_number().over(at), "prev_dep": F.lag("dep_s").over(at)})
    return placed.drop("_first", "_early", "_alone")
