"""Session helpers: a local session for tests, table access and checkpoint set-up."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tramline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.maxResultSize", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Unlike cached blocks the rows survive the loss of executors, and the file
    sizes give the planner exact statistics for the next join.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when at most ``max_rows`` rows were counted.

    Beyond the bound the frame is returned unhinted, so the same equi join runs
    as a shuffled join.
    """
    seen = df.limit(max_rows + 1).count()
    return F.broadcast(df) if seen <= max_rows else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores for heavy work per row when the input has fewer splits than cores.

    Inputs with enough splits, as on a cluster, are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for written data, one folder per application so that it can be dropped
    as a whole afterwards.

    It lies in the shared folder that ``spark.checkpoint.dir`` names. Where that
    is unset it lies below the session's warehouse, which every executor writes
    tables to as well; a warehouse on a local disk is refused on a cluster.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/_stages"
        if base.startswith(("file:", "/")) and not sc.master.startswith("local"):
            raise ValueError("stages need a folder that all executors share: set spark.checkpoint.dir")
    return f"{base}/tramline-{sc.applicationId}/{name}-{uuid.uuid4().hex}"
