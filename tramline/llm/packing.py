"""Best-fit packing of tokenised documents into sequences, with certified sequence counts.

Documents are cut into pieces of at most ``capacity`` tokens and dealt out to
partitions of bounded size, each of which runs best-fit decreasing. Dual feasible functions
give a lower bound of the sequences that all pieces need, from one histogram of their
lengths, and another one for each partition. A partition above its own bound has a gap; but
bins that are optimal in their partition may still waste room that others could use. So
full sequences are kept for good, and as long as the whole is above its bound by more than
``GAP``, the pieces of all other sequences are exchanged: dealt out anew to as many partitions
as they still fill and packed again. The exchange ends when it saves nothing more.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import tokens
from tramline.operators import ordered
from tramline.session import cut_lineage

CAPACITY = 2048
#: Pieces of a partition on average; bounds the memory of a task.
PIECES_PER_PARTITION = 4096
#: Share of sequences above the lower bound at which exchanging ends.
GAP = 0.001
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: all full but the first, which takes the rest."""
    first = n % capacity or min(n, capacity)
    return [first] + [capacity] * ((n - first) // capacity)


def tokenize_pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Pieces of every document: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``, packed).

    A document is its whole text's ids and then ``end_id``; a null or empty text is the
    end id alone. Rows are taken as they come: a repeated row gives its pieces again,
    a null ``doc_id`` stays null, columns besides ``doc_id`` and ``text`` are not read.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
    names = [field.split()[0] for field in schema.split(", ")]

    def cut(batches):
        worker = tokens.encoder(tokenizer)
        for batch in tokens.slices(batches):
            columns: list[list] = [[] for _ in names]
            flat, counts = worker.encode_column(batch.column("text"))
            raw, at = memoryview(np.insert(flat, np.cumsum(counts), end_id).tobytes()), 0
            for doc_id, n in zip(batch.column("doc_id").to_pylist(), (counts + 1).tolist(), strict=True):
                ids, start = raw[4 * at : 4 * (at + n)], 0
                at += n
                for piece, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, piece, start, length, zlib.crc32(part), *([bytes(part)] * with_ids))
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    start += length
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Fewest sequences that could hold ``lengths``: the best of several dual feasible functions.

    A function f from lengths to weights is dual feasible if the weights of any set that fits
    one sequence add up to one at most; the sum of all weights then bounds the count from below.
    Taken are the identity, the functions that round lengths above ``capacity - t`` up to a
    whole sequence and drop those below ``t``, for every t, and the stepwise functions
    u_k(x) = floor((k + 1) x) / k (x itself where (k + 1) x is whole) for k up to 20.
    """
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity)


def bound_of_counts(counts: np.ndarray, capacity: int) -> int:
    """``lower_bound`` from the number of pieces of each length."""
    sizes = np.arange(capacity + 1, dtype=np.int64)
    total = int((counts * sizes).sum())
    best = -(-total // capacity)
    number, amount = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * sizes)])
    t = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - t + 1]
    middle = amount[capacity - t + 1] - amount[t]
    if len(t):
        best = max(best, int((whole - (-middle // capacity)).max()))
    for k in range(1, 21):
        scaled = (k + 1) * sizes
        # in units of 1 / (k * capacity)
        weight = np.where(scaled % capacity == 0, k * sizes, scaled // capacity * capacity)
        best = max(best, -(-int((counts * weight).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset in it and, for each bin, what it holds; equal lengths go in their given order.

    A set of bits marks the remainders for which an open bin exists, so that the tightest
    fitting bin is found without a search.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    remainders, held = 0, []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = remainders >> n
        if fitting:
            rest = n + (fitting & -fitting).bit_length() - 1
            b = open_bins[rest].pop()
            if not open_bins[rest]:
                remainders &= ~(1 << rest)
        else:
            b, rest = len(held), capacity
            held.append(0)
        bins[i], offsets[i] = b, held[b]
        held[b] += n
        if rest > n:
            open_bins[rest - n].append(b)
            remainders |= 1 << (rest - n)
    return bins, offsets, np.array(held, np.int64)


def _pack_partition(capacity: int, step: int):
    """Pack one partition; ``full`` marks the pieces of full sequences."""

    def pack(group: pa.Table) -> pa.Table:
        lengths = group["length"].to_numpy()
        bins, offsets, held = best_fit_decreasing(lengths, capacity)
        base = (step << 56) + (group["part"][0].as_py() << 28)
        out = group.select(PIECE).append_column("sequence_id", pa.array(base + bins)).append_column("offset", pa.array(offsets))
        return out.append_column("full", pa.array((held == capacity)[bins]))

    return pack


PIECE = ["doc_id", "piece", "start", "length", "ids_crc32", "row"]


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, pieces_per_partition: int = PIECES_PER_PARTITION, gap: float = GAP
) -> DataFrame:
    """Place pieces (``doc_id, piece, start, length, ids_crc32``) into sequences.

    Adds ``sequence_id`` (any numbers) and ``offset``; a sequence is filled without gaps from 0.
    Lengths must lie between 1 and ``capacity``. An empty table gives an empty table. Equal
    rows are pieces of their own, told apart by a number that is written with them; pieces are dealt
    out by their rank of length, so equal ones go to all partitions. The data that moves is these few numbers per piece.
    """
    rows = pieces.select(*PIECE[:-1]).withColumn("row", F.monotonically_increasing_id())
    left, done, kept, step, least = cut_lineage(rows), [], 0, 0, None
    found = left.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    counts[[r.length for r in found]] = [r.n for r in found]
    bound, count = bound_of_counts(counts, capacity), int(counts.sum())
    while True:
        parts = max(1, -(-count // pieces_per_partition))
        # dealt by rank of length, so that every partition has the lengths of the whole
        ranked = ordered.row_numbers(left.withColumn("_all", F.lit(0)), ["_all"], ["length", "row"], "rank")
        schema = PLACED.replace(", sequence_id", ", row long, sequence_id") + ", full boolean"
        dealt = ranked.select(*PIECE, F.pmod("rank", F.lit(parts)).cast("long").alias("part"))
        packed = dealt.groupBy("part").applyInArrow(_pack_partition(capacity, step), schema)
        packed = cut_lineage(packed)
        # a sequence begins with one piece at offset 0
        opens = F.col("offset") == 0
        seen = packed.agg(
            F.count_if(opens & F.col("full")).alias("full"), F.count_if(opens).alias("all"), F.count_if(~F.col("full")).alias("rest")
        ).first()
        total = kept + seen["all"]
        # nothing saved, near the bound, or all that is left was packed together
        if (least is not None and total >= least) or total <= bound * (1 + gap) or parts == 1:
            done.append(packed)
            break
        done.append(packed.filter("full"))
        left = packed.filter("NOT full").drop("full", "sequence_id", "offset")
        kept, count, step, least = kept + seen["full"], seen["rest"], step + 1, total
    return reduce(DataFrame.unionByName, done).drop("full", "row")


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY
) -> DataFrame:
    """Tokenise whole documents and pack them: one row per piece with its sequence and place."""
    return pack_pieces(tokenize_pieces(docs, tokenizer, end_id, capacity), capacity)
