"""Writers: files, partitioned and clustered layouts, catalog tables, fitted models."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.session import broadcast_if_small
from tramline.sources import readers

DAY = ("year", "month", "day")


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_by_date(df: DataFrame, path: str, day: str) -> str:
    """Lay rows out as ``year=/month=/day=``; a second run replaces only its own days.

    Rebalancing on the day lets adaptive execution split a heavy day over several
    tasks and put light days together.
    """
    parts = {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}
    placed = df.withColumns(parts).hint("rebalance", "year", "month", "day")
    writer = placed.write.partitionBy("year", "month", "day").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return path


def finished_days(spark: SparkSession, path: str) -> DataFrame | None:
    """The days listed in the manifest of ``path``; none before the first run."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_days")
    exists = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema("year int, month int, day int").parquet(f"{path}/_days") if exists else None


def write_new_days(df: DataFrame, path: str, day: str) -> list[tuple[int, int, int]]:
    """Write the days of ``df`` that the manifest of ``path`` does not list; returns them.

    Rows of finished days are dropped before the shuffle. New days are written to a staging folder,
    each is published by renaming its directory, and then all are entered into the manifest. A run
    that breaks leaves whole days or none in sight; what it had not entered is written anew by
    the next run. Rows without a day are not written.
    """
    spark = df.sparkSession
    rows = df.where(F.col(day).isNotNull()).withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})
    done = finished_days(spark, path)
    if done is not None:
        rows = rows.join(broadcast_if_small(done.distinct()), list(DAY), "left_anti")
    staging = f"{path}/_staging-{uuid.uuid4().hex}"
    rows.hint("rebalance", *DAY).write.partitionBy(*DAY).parquet(staging)
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    new = []
    for year in readers.children(spark, staging):
        for month in readers.children(spark, f"{staging}/{year}"):
            for one in readers.children(spark, f"{staging}/{year}/{month}"):
                target = jvm.org.apache.hadoop.fs.Path(f"{path}/{year}/{month}/{one}")
                fs.mkdirs(target.getParent())
                # what lies there is of a run that broke before it entered the day
                fs.delete(target, True)
                if not fs.rename(jvm.org.apache.hadoop.fs.Path(f"{staging}/{year}/{month}/{one}"), target):
                    raise OSError(f"{target} could not be published")
                new.append(tuple(int(name.split("=")[1]) for name in (year, month, one)))
    if new:
        entered = spark.createDataFrame(new, "year int, month int, day int").coalesce(1)
        entered.write.mode("append").parquet(f"{path}/_days")
    return new


def write_sequence_file(df: DataFrame, path: str, key: str, value: str) -> str:
    """(key, value) pairs as a Hadoop sequence file; a missing value is written as empty text."""
    pairs = df.select(F.col(key).cast("string"), F.coalesce(F.col(value).cast("string"), F.lit("")))
    pairs.rdd.map(tuple).saveAsSequenceFile(path)
    return path


def write_clustered(df: DataFrame, path: str, partition: dict[str, Column], cluster: list[str]) -> str:
    """Partition directories by derived columns and range-cluster rows inside them.

    Range partitioning on the partition columns plus the cluster columns keeps a
    heavy directory in several files, each with a narrow key range whose footer
    statistics allow point look-ups to skip it.
    """
    keys = list(partition)
    placed = df.withColumns(partition).repartitionByRange(*keys, *cluster)
    placed.sortWithinPartitions(*keys, *cluster).write.mode("overwrite").partitionBy(*keys).parquet(path)
    return path


def create_table_as(df: DataFrame, name: str, path: str) -> DataFrame:
    """CREATE OR REPLACE TABLE AS SELECT with the data at ``path``."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.mode("overwrite").option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def insert_select(df: DataFrame, name: str, ddl: str, path: str) -> DataFrame:
    """Declare a table and fill it from a query, columns matched by position."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION '{path}'")
    df.write.insertInto(name, overwrite=True)
    return spark.table(name)


def create_schema(spark: SparkSession, name: str, use: bool = False) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
    if use:
        spark.catalog.setCurrentDatabase(name)


def drop_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def model_key(regions: list[str], weekdays: list[int]) -> str:
    """Stable hash of normalised region names and weekdays."""
    names = sorted(r.strip().lower() for r in regions)
    text = "|".join([*names, *[str(d) for d in sorted(weekdays)]])
    return hashlib.sha256(text.encode()).hexdigest()


def load_or_train(
    spark: SparkSession, folder: str, key: str, train: Callable[[], PipelineModel]
) -> PipelineModel:
    """The model stored under ``folder/key``; trained and stored if absent."""
    path = f"{folder}/{key}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/metadata")
    exists = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
    if not exists:
        train().write().overwrite().save(path)
    return PipelineModel.load(path)
