"""Readers for the file layouts the library works with."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.session import broadcast_if_small, cut_lineage


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_partitioned(spark: SparkSession, root: str, predicate: Column | None = None) -> DataFrame:
    """Hive layout; a predicate on directory columns prunes files before reading."""
    df = spark.read.option("basePath", root).parquet(root)
    return df if predicate is None else df.where(predicate)


def read_csv(
    spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True,
    timestamp_format: str | None = None, date_format: str | None = None,
) -> DataFrame:
    """CSV with a declared schema, so no inference pass over the data."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", header)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    return reader.csv(path)


def read_json(
    spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Nested JSON. ``multi_line`` reads pretty-printed files (not splittable)."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_map(spark: SparkSession, path: str, value_ddl: str, key: str = "id") -> DataFrame:
    """JSON objects keyed by id -> one row per id with the fields of its value."""
    text = spark.read.text(path)
    entry = F.explode(F.from_json("value", f"map<string,{value_ddl}>")).alias(key, "_v")
    return text.select(entry).select(key, "_v.*")


def read_word_list(spark: SparkSession, path: str, extra: DataFrame | None = None) -> DataFrame:
    """A text file of words, one per line, plus extra words; each word once."""
    words = spark.read.text(path).select(F.lower(F.trim("value")).alias("word")).where("word <> ''")
    return (words if extra is None else words.union(extra.select("word"))).distinct()


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_sequence_file(spark: SparkSession, path: str) -> DataFrame:
    """Hadoop sequence file of (id, text) pairs as a DataFrame."""
    return spark.sparkContext.sequenceFile(path).toDF("doc_id string, text string")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible files and directories in ``path``, from the file system's listing alone."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    return sorted(n for n in (s.getPath().getName() for s in found) if not n.startswith(("_", ".")))


def block_sample(spark: SparkSession, path: str, fraction: float, seed: str = "") -> DataFrame:
    """A share of the blocks of a Parquet data set; blocks that are not drawn are neither opened nor listed further.

    Blocks are the directories of a partitioned layout, or the files of a plain one. A block is
    drawn by a hash of its name, so the same on every run and independent of other blocks; rows
    of one block come together, which makes the sample cheap and, for clustered data, uneven.
    """
    drawn = [n for n in children(spark, path) if int(hashlib.md5((seed + n).encode()).hexdigest()[:8], 16) < fraction * 2**32]
    reader = spark.read.option("basePath", path)
    if not drawn:
        return reader.parquet(path).limit(0)
    return reader.parquet(*[f"{path}/{n}" for n in drawn])


def read_with_row_id(spark: SparkSession, path: str, out: str = "row_id") -> DataFrame:
    """A Parquet data set with consecutive row numbers in the order it was written.

    A number is the row's own index in its file, which the reader knows, plus the rows of the
    files before it (by the number in their names). No row is sorted or moved.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    sizes = rows.groupBy("_file").agg((F.max("_at") + 1).alias("_n"))
    part = F.regexp_extract("_file", r"part-(\d+)", 1).cast("bigint")
    # one row per file
    ahead = Window.orderBy(part, "_file").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_file", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    placed = rows.join(broadcast_if_small(cut_lineage(before)), "_file")
    return placed.withColumn(out, F.col("_before") + F.col("_at")).drop("_file", "_at", "_before")


def describe(df: DataFrame) -> DataFrame:
    """Column position, name and type as rows."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def iterate_batches(frames: list[DataFrame], batch_rows: int = 100) -> Iterator[list[tuple]]:
    """Rows of several queries in batches, each query opened by its header.

    One partition at a time is on the driver.
    """
    for df in frames:
        yield [tuple(df.columns)]
        batch: list[tuple] = []
        for row in df.toLocalIterator(prefetchPartitions=True):
            batch.append(tuple(row))
            if len(batch) == batch_rows:
                yield batch
                batch = []
        if batch:
            yield batch


def storage_report(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """Files and bytes per named folder; file content is not read."""
    parts = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.lit(name).alias("format"), "length")
        for name, path in roots.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("format").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
