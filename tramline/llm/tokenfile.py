"""Token ids in ORC files in ascending document order.

A file holds a range of documents: ``doc_id``, ``first`` (ids before the document in the
file), ``n_tokens`` and ``ids``. ORC stores the integers run-length encoded in stripes,
which readers take in parallel, keeps an index of every ``row_index_stride`` rows with the
smallest and largest ids, and a Bloom filter on ``doc_id``, so that a look-up of documents
reads only the row groups that may hold them, and counts need no ids at all.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm import tokens
from tramline.session import broadcast_if_small, cut_lineage

END_ID = 2
SCHEMA = "doc_id long, first long, n_tokens long, ids array<int>"


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, row_index_stride: int = 2000
) -> None:
    """Encode every whole text (null: empty), append ``end_id`` and write all in ascending order.

    Documents are dealt out by ranges of (``doc_id``, hash of the text), so rows that share an
    id, or have none (these come first), spread over files too. Rows with equal ids are ordered
    by that hash. Other columns are not read. An empty table gives a folder without rows.
    """

    def encode(batches):
        worker, before = tokens.encoder(tokenizer), 0
        for batch in tokens.slices(batches):
            flat, counts = worker.encode_column(batch.column("text"))
            flat = np.insert(flat, np.cumsum(counts), end_id).astype(np.int32, copy=False)
            counts += 1
            ends = np.cumsum(counts)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            first = pa.array(before + ends - counts)
            before += int(ends[-1]) if len(ends) else 0
            doc_id = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays([doc_id, first, pa.array(counts), ids], ["doc_id", "first", "n_tokens", "ids"])

    order = ("doc_id", "_h")
    (
        docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("_h"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(encode, SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", row_index_stride)
        .option("orc.stripe.size", 16 << 20)
        .option("maxRecordsPerFile", 0)
        .option("compression", "zstd")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``start``, the number of ids of all documents before.

    File names ascend with the ranges; what stands before a file is summed from the counts
    alone, one row per file.
    """
    rows = spark.read.schema(SCHEMA).orc(path).withColumn("_file", F.col("_metadata.file_name"))
    totals = rows.groupBy("_file").agg(F.sum("n_tokens").alias("_sum"))
    # by the number in the name, which has five digits or more
    number = F.regexp_extract("_file", r"part-(\d+)", 1).cast("long")
    ahead = Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_file", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_before"))
    # written and counted first: as one row per file it is sent to all tasks, and the ids are not shuffled
    totals = broadcast_if_small(cut_lineage(totals))
    return rows.join(totals, "_file").withColumn("start", F.col("_before") + F.col("first")).drop("_file", "_before")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of a few documents; row groups are skipped by their index and Bloom filter."""
    return spark.read.schema(SCHEMA).orc(path).filter(F.col("doc_id").isin(list(doc_ids)))


def digest(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of rows read back, from their ids."""

    def crc(batches):
        for batch in tokens.slices(batches, 2048):
            ids = batch.column("ids")
            values = ids.values.to_numpy().astype(np.uint32)
            raw = memoryview((values.byteswap() if sys.byteorder == "big" else values).tobytes())
            ends = ids.offsets.to_numpy().tolist()
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:], strict=False)]
            counts = [b - a for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return rows.select("doc_id", "start", "ids").mapInArrow(crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
