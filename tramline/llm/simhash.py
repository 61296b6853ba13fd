"""Near-duplicate groups by SimHash fingerprints, pivot distance tables and linked components.

1. A document's fingerprint takes the majority of the bits of its word shingles' hashes.
   Copies share one; all later steps work on distinct fingerprints.
2. For every distinct fingerprint the Hamming distances to many reference fingerprints
   (pivots) are precomputed. By the triangle inequality two fingerprints within ``radius``
   differ by at most ``radius`` in every one of these coordinates.
3. Pairs are compared only where they can be near: the bits are cut into ``radius + equal``
   blocks, so ``equal`` of the blocks at least are equal in any near pair, which makes an equi
   join over all choices of so many blocks exact. More equal blocks give longer keys and more
   choices. Buckets of one fingerprint are dropped; large ones are dealt out as pairs of
   bounded chunks.
4. Inside a chunk pair those of too large a coordinate difference are discarded, survivors
   verified on all bits, and only a spanning forest of the links leaves the task.
5. Components come from the links by alternating star contraction.
"""

from __future__ import annotations

from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import tokens
from tramline.session import cut_lineage

SEED = 42
BITS = 64
#: Fingerprints of a chunk; two chunks meet in one group.
CHUNK = 512
#: Shingles of one text that are hashed together.
HASHED_AT_ONCE = 1 << 16
#: Reference fingerprints: hashes of their numbers.
PIVOTS = np.array([xxhash.xxh64_intdigest(str(i).encode(), 7) for i in range(16)], np.uint64)


def fingerprint(text: str, shingle_words: int) -> int:
    """SimHash of a text, A-Z in lower case; words end at ASCII white space.

    Repeated shingles count each time. A text of fewer words than a shingle is one shingle;
    without words the fingerprint is zero.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle_words)), strict=False))
        n = len(words) - shingle_words + 1
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    return majority(np.fromiter(hashes, np.uint64, min(HASHED_AT_ONCE, n - s)) for s in range(0, n, HASHED_AT_ONCE))


def majority(parts) -> int:
    """The bits that are set in over half of all hashes of ``parts``."""
    ones, n = np.zeros(BITS, np.int64), 0
    for part in parts:
        n += len(part)
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (a signed long) of every row; a null text has no words."""

    def compute(batches):
        for batch in tokens.slices(batches):
            prints = np.array([fingerprint(text, shingle_words) for text in tokens.texts_of(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fingerprint"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(compute, "doc_id long, fingerprint long")


def block_masks(radius: int, equal: int) -> list[int]:
    """Bits (as signed longs) of all choices of ``equal`` out of ``radius + equal`` blocks."""
    edges = np.linspace(0, BITS, radius + equal + 1).astype(int).tolist()
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [int(np.uint64(sum(chosen)).astype(np.int64)) for chosen in combinations(masks, equal)]


def _block_keys(radius: int, equal: int):
    """All choices of ``equal`` out of ``radius + equal`` blocks: number of the choice and the blocks' bits."""
    return F.explode(
        F.array(*[
            F.struct(F.lit(i).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("bits"))
            for i, mask in enumerate(block_masks(radius, equal))
        ])
    )


def pivot_distances(prints: np.ndarray) -> np.ndarray:
    """Differing bits of every fingerprint to every pivot."""
    return np.bitwise_count(prints[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def may_be_near(pivots: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs of rows the distances to the pivots do not rule out."""
    apart = np.zeros((len(pivots), len(pivots)), np.uint8)
    for column in pivots.T:
        np.maximum(apart, np.abs(column[:, None] - column[None, :]).astype(np.uint8), out=apart)
    return apart <= radius


def _links_of(prints, pivots, side, crossed, radius):
    """A spanning forest of the near pairs of one group: positions and the positions of their roots."""
    near = may_be_near(pivots, radius)
    if crossed:
        near &= side[:, None] != side[None, :]
    a, b = np.nonzero(np.triu(near, 1))
    verified = np.bitwise_count(prints[a] ^ prints[b]) <= radius
    a, b = a[verified], b[verified]
    root = np.arange(len(prints))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return np.nonzero(root != np.arange(len(root)))[0], root


def _match(radius: int):
    def match(batches):
        held: list[pa.RecordBatch] = []
        keys = ("choice", "bits", "low", "high")

        def links(table: pa.Table):
            numbers = {k: table[k].to_numpy() for k in (*keys, "fingerprint", "chunk")}
            prints = numbers["fingerprint"].view(np.uint64)
            pivots = pivot_distances(prints)
            changed = np.any([np.diff(numbers[k]) != 0 for k in keys], axis=0)
            starts = [0, *(np.nonzero(changed)[0] + 1).tolist(), len(prints)]
            out_a, out_b = [], []
            for s, e in zip(starts, starts[1:], strict=False):
                if e - s > 1:
                    crossed = numbers["low"][s] != numbers["high"][s]
                    child, root = _links_of(prints[s:e], pivots[s:e], numbers["chunk"][s:e], crossed, radius)
                    out_a.append(numbers["fingerprint"][s:e][child])
                    out_b.append(numbers["fingerprint"][s:e][root[child]])
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_a, out_b))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        def last_start(table: pa.Table) -> int:
            changed = np.any([np.diff(table[k].to_numpy()) != 0 for k in keys], axis=0)
            return int(np.nonzero(changed)[0][-1]) + 1 if changed.any() else 0

        # groups are contiguous; the last of a batch may go on in the next one
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            cut = last_start(table)
            if cut:
                yield links(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield links(pa.Table.from_batches(held))

    return match


def near_links(prints: DataFrame, radius: int, equal: int = 2, chunk: int = CHUNK) -> DataFrame:
    """Links ``a, b`` between distinct ``fingerprint`` values within ``radius`` bits.

    Not every near pair is returned, but every near pair is connected through links.
    """
    rows = prints.select("fingerprint", _block_keys(radius, equal).alias("k")).select("fingerprint", "k.*")
    shared = rows.groupBy("choice", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    dealt = (
        rows.join(shared, ["choice", "bits"])
        .withColumn("chunk", F.pmod(F.xxhash64("fingerprint"), chunks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select(
            "choice", "bits", "fingerprint", "chunk",
            F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
        )
    )
    group = ["choice", "bits", "low", "high"]
    return dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(_match(radius), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected ``links`` (``a, b``) but the roots.

    The root is the smallest node of a component. Alternates large and small stars until the
    edges stay the same; each round is written to the shared folder.
    """
    edges = cut_lineage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    )
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges
        state = now
        # large star: every neighbour above a node is tied to the smallest node around it
        both = edges.select(F.col("node").alias("u"), F.col("root").alias("v")).union(edges.select("root", "node"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("node"), F.col("m").alias("root")).distinct()
        large = cut_lineage(large)
        # small star: a node and all below it are tied to the smallest of them
        least = large.groupBy("node").agg(F.min("root").alias("m"))
        tied = large.join(least, "node").select(F.col("root").alias("node"), F.col("m").alias("root"))
        edges = tied.union(least.select("node", "m")).filter("node <> root").distinct()
        edges = cut_lineage(edges)


def near_duplicates(docs: DataFrame, shingle_words: int = 5, radius: int = 3, equal: int = 2) -> DataFrame:
    """``doc_id, fingerprint`` (hex) ``, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most ``radius``
    differing bits; it is null only where no row of the component has an id. Documents without
    words share the fingerprint zero. Repeated rows stay. Only ``doc_id`` and ``text`` are read.
    """
    rows = cut_lineage(with_fingerprint(docs, shingle_words))
    prints = cut_lineage(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    tied = components(near_links(prints, radius, equal)).withColumnRenamed("node", "fingerprint")
    member = prints.join(tied, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = member.join(ids, "root").select("fingerprint", "component_id")
    return rows.join(classes, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
