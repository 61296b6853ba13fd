"""Near-duplicate documents: candidates by SimHash fingerprints, links by exact Jaccard similarity of word shingles.

1. Documents with the same set of shingles share one 64-bit number; later steps work on distinct sets.
2. Every set has a SimHash fingerprint of all its shingles, whose candidates are those within
   ``RADII[0]`` bits. At a similarity of 0.8 whole fingerprints differ by some ten bits, so there
   are ``BANDS`` more, each of ``ROWS`` shingles drawn from the set by the smallest hash under a
   multiplier; there candidates are equal. Two sets of similarity s draw the same shingles for one of
   them with probability ``1 - (1 - s^ROWS)^BANDS``, which is 0.9999 at 0.8.
3. As in ``simhash``, fingerprints within a radius meet in an equi join on equal blocks of bits,
   pairs of too large a difference of their distances to the pivots are discarded, and the
   survivors are compared on all bits. A pair is also left out before verification if its sizes
   cannot reach the similarity, or if fewer than ``AGREE`` of all drawn shingles agree (4.8
   standard deviations below the mean at 0.8).
4. First, every set is compared with the most similar set before it in each of its buckets, and these
   pairs are verified by the size of the intersection of the whole sets, in equi joins on the set's number.
5. Then the buckets that still hold several components are compared in full, in pairs of bounded chunks:
   the whole sets of these members come to the task, which verifies the candidates of different
   components, each in the first bucket that they share, and sends a spanning forest of the links it
   finds. So the rows that leave grow with the sets, however many pairs lie just below the similarity.
6. Components come from star contraction.
"""

from __future__ import annotations

from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import tokens
from tramline.llm.simhash import HASHED_AT_ONCE, SEED, block_masks, components, majority, may_be_near, pivot_distances
from tramline.session import broadcast_if_small, cut_lineage

BANDS, ROWS = 24, 5
#: Bits by which fingerprints of candidates differ at most: of whole sets, and of drawn shingles.
RADII = [3] + [0] * BANDS
#: Number of the fingerprint and equal blocks of each bucket in which a set stands.
BLOCKS = [(i, mask) for i, radius in enumerate(RADII) for mask in block_masks(radius, 1 if i else 2)]
#: Of all drawn shingles so many agree in a candidate pair; they are compared by one byte each.
AGREE = 75
#: Sets of a chunk, and shingles of a chunk; two chunks meet in one group.
CHUNK, CHUNK_SHINGLES = 1024, 1 << 19
#: Shingles whose columns of the incidence matrix are multiplied together.
COLUMNS = 4096
#: Shingles whose minima are taken together, and pairs looked up in earlier buckets.
TOGETHER, TOGETHER_PAIRS = 512, 1 << 13
#: Rows of a group whose pairs are compared in all columns at once.
FEW = 32
#: Odd multipliers of the hashes, one per drawn shingle, and what takes a product back to its hash.
FACTORS = np.array([xxhash.xxh64_intdigest(str(i).encode(), 11) | 1 for i in range(BANDS * ROWS)], np.uint64)
INVERSES = np.array([pow(int(f), -1, 1 << 64) for f in FACTORS], np.uint64)


def shingle_set(text: str, shingle_words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles, A-Z in lower case; words end at ASCII white space.

    A text of fewer words than a shingle is one shingle; without words the set is empty.
    """
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < shingle_words:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle_words)), strict=False))
        n = len(words) - shingle_words + 1
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    parts = [np.fromiter(hashes, np.uint64, min(HASHED_AT_ONCE, n - s)) for s in range(0, n, HASHED_AT_ONCE)]
    return np.unique(np.concatenate(parts))


def set_number(shingles: np.ndarray) -> int:
    """Signed number of a shingle set."""
    digest = xxhash.xxh64_intdigest(shingles.astype("<u8").tobytes(), SEED)
    return digest - (1 << 64) if digest >> 63 else digest


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest hash of the set under each multiplier."""
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), TOGETHER):
        np.minimum(least, (shingles[start : start + TOGETHER, None] * FACTORS).min(0), out=least)
    return least


def fingerprints(shingles: np.ndarray, least: np.ndarray) -> np.ndarray:
    """SimHash of the whole set, and of each ``ROWS`` shingles of smallest products ``least``."""
    whole = majority(shingles[s : s + HASHED_AT_ONCE] for s in range(0, len(shingles), HASHED_AT_ONCE))
    drawn = (least * INVERSES).astype("<u8").view(np.uint8).reshape(BANDS, ROWS, 8)
    ones = np.unpackbits(drawn, axis=2, bitorder="little").sum(1)
    parts = np.packbits(2 * ones > ROWS, axis=1, bitorder="little").reshape(-1).view("<u8")
    return np.concatenate([np.array([whole], np.uint64), parts])


def with_signature(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``doc_id, version, set, n``, fingerprints ``keys`` and ``bytes`` of the drawn shingles of every row.

    A null text has no words.
    """

    def compute(batches):
        for batch in tokens.slices(batches):
            numbers, sizes, keys, low = [], [], [], []
            for text in tokens.texts_of(batch):
                shingles = shingle_set(text, shingle_words)
                least = minima(shingles)
                numbers.append(set_number(shingles))
                sizes.append(len(shingles))
                keys.append(fingerprints(shingles, least).view(np.int64))
                low.append((least & np.uint64(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("version"), pa.array(numbers, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(low, pa.binary()),
                ],
                ["doc_id", "version", "set", "n", "keys", "bytes"],
            )

    schema = "doc_id long, version long, set long, n long, keys array<long>, bytes binary"
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("version"))
    return rows.mapInArrow(compute, schema)


def _agreement(low: np.ndarray, sizes: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """How many drawn shingles agree for each pair of rows, and which pairs (the later row first) may be similar enough."""
    if len(low) <= FEW:
        agree = (low[:, None, :] == low[None, :, :]).sum(2, dtype=np.uint8)
    else:
        agree = np.zeros((len(low), len(low)), np.uint8)
        for column in low.T:
            agree += column[:, None] == column[None, :]
    near = np.tril(agree >= AGREE, -1)
    near &= np.minimum.outer(sizes, sizes) >= similarity * np.maximum.outer(sizes, sizes) - 1e-9
    return agree, near


def _near_prints(group: pa.Table, near: np.ndarray) -> np.ndarray:
    """Those of the pairs ``near`` whose fingerprints are within the radius: what the pivots leave is compared on all bits."""
    prints, radius = group["print"].to_numpy().view(np.uint64), RADII[BLOCKS[group["bucket"][0].as_py()][0]]
    # the key of a bucket without radius is the fingerprint
    if radius and near.any():
        near = near & may_be_near(pivot_distances(prints), radius)
        a, b = np.nonzero(near)
        near[a, b] = np.bitwise_count(prints[a] ^ prints[b]) <= radius
    return near


def _met_before(keys: np.ndarray, bucket: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows are candidates in a bucket of a smaller number."""
    met, differ = np.zeros(len(a), bool), keys[a] ^ keys[b]
    near = np.bitwise_count(differ.view(np.uint64)) <= np.array(RADII)
    for fingerprint, mask in BLOCKS[:bucket]:
        met |= near[:, fingerprint] & (differ[:, fingerprint] & mask == 0)
    return met


def _closest(similarity: float):
    """Of each row of a group the most similar candidate before it; of equal ones the last."""

    def pairs_of(group: pa.Table) -> list[tuple[int, int]]:
        agree, near = _agreement(_low(group), group["n"].to_numpy(), similarity)
        near = _near_prints(group, near)
        best = len(near) - 1 - np.argmax(np.where(near, agree, 0)[:, ::-1], axis=1)
        rows = np.nonzero(near.any(1))[0]
        return list(zip(rows.tolist(), best[rows].tolist(), strict=True))

    return pairs_of


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs: products of blocks of the incidence matrix of shared shingles."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # a shingle of one set alone is in no intersection
    number = np.cumsum(times > 1) - 1
    shared = times[column] > 1
    owner, column = owner[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int((times > 1).sum()), COLUMNS):
        s, e = np.searchsorted(column, [start, start + COLUMNS])
        block = np.zeros((len(sets), COLUMNS), np.float32)
        block[owner[s:e], column[s:e] - start] = 1
        common += block @ block.T
    return common


def _forest(similarity: float):
    """Verified links between rows of different roots of a group, as few as connect the same roots."""

    def pairs_of(group: pa.Table) -> list[tuple[int, int]]:
        sizes, root, chunk = (group[k].to_numpy() for k in ("n", "root", "chunk"))
        _, near = _agreement(_low(group), sizes, similarity)
        near &= root[:, None] != root[None, :]
        if group["low"][0].as_py() != group["high"][0].as_py():
            near &= chunk[:, None] != chunk[None, :]
        if not near.any():
            return []
        near = _near_prints(group, near)
        keys, (a, b) = np.stack([k.values.to_numpy() for k in group["keys"]]), np.nonzero(near)
        for start in range(0, len(a), TOGETHER_PAIRS):
            part = slice(start, start + TOGETHER_PAIRS)
            near[a[part], b[part]] = ~_met_before(keys, group["bucket"][0].as_py(), a[part], b[part])
        rows = np.nonzero(near.any(0) | near.any(1))[0]
        if not len(rows):
            return []
        column = group["shingles"].combine_chunks()
        common = common_counts([column[i].values.to_numpy() for i in rows.tolist()])
        either = sizes[rows][:, None] + sizes[rows][None, :] - common
        a, b = np.nonzero(near[np.ix_(rows, rows)] & (common >= similarity * either - 1e-9))
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        out = []
        for i, j in zip(rows[a].tolist(), rows[b].tolist(), strict=True):
            x, y = top(root[i]), top(root[j])
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((i, j))
        return out

    return pairs_of


def _low(group: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(group["bytes"].to_pylist()), np.uint8).reshape(-1, len(FACTORS))


def _in_groups(pairs_of):
    """Apply ``pairs_of`` to each group (bucket, key, low, high) of sorted rows; pairs of set numbers."""
    keys = ("bucket", "key", "low", "high")

    def run(batches):
        held: list[pa.RecordBatch] = []

        def pairs(table: pa.Table):
            changed = np.any([np.diff(table[k].to_numpy()) != 0 for k in keys], axis=0)
            starts = [0, *(np.nonzero(changed)[0] + 1).tolist(), len(table)]
            numbers, out = table["set"].to_numpy(), []
            for s, e in zip(starts, starts[1:], strict=False):
                if e - s > 1:
                    out += [(int(numbers[s + i]), int(numbers[s + j])) for i, j in pairs_of(table.slice(s, e - s))]
            a, b = [min(p) for p in out], [max(p) for p in out]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        # groups are contiguous; the last of a batch may go on in the next one
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            changed = np.any([np.diff(table[k].to_numpy()) != 0 for k in keys], axis=0)
            if changed.any():
                cut = int(np.nonzero(changed)[0][-1]) + 1
                yield pairs(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield pairs(pa.Table.from_batches(held))

    return run


def _whole_sets(needed: DataFrame, sets: DataFrame, docs: DataFrame, shingle_words: int) -> DataFrame:
    """``set, shingles`` of the needed set numbers, from the texts."""

    def compute(batches):
        for batch in tokens.slices(batches):
            found = [shingle_set(text, shingle_words) for text in tokens.texts_of(batch)]
            arrays = pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([set_number(s) for s in found], pa.int64()), arrays], ["set", "shingles"])

    versions = broadcast_if_small(cut_lineage(sets.join(needed, "set", "left_semi").select("version")))
    texts = docs.select(F.xxhash64("text").alias("version"), "text").join(versions, "version", "left_semi").distinct()
    return cut_lineage(texts.select("text").mapInArrow(compute, "set long, shingles array<long>").dropDuplicates(["set"]))


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, shingle_words: int, similarity: float) -> DataFrame:
    """The pairs whose whole shingle sets are similar enough."""
    pairs = cut_lineage(pairs.distinct())
    needed = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct()
    found = _whole_sets(needed, sets, docs, shingle_words)
    a = found.select(F.col("set").alias("a"), F.col("shingles").alias("of_a"))
    b = found.select(F.col("set").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - common
    return cut_lineage(pairs.join(a, "a").join(b, "b").filter(common >= similarity * either - 1e-9).select("a", "b"))


def near_links(sets: DataFrame, docs: DataFrame, shingle_words: int, similarity: float, chunk: int = CHUNK) -> DataFrame:
    """Links ``a, b`` between distinct sets of at least this similarity.

    Not every candidate pair is returned, but every one that is similar enough is connected.
    """
    blocks = [
        F.struct(F.lit(i).alias("bucket"), F.col("keys")[at].bitwiseAND(F.lit(mask)).alias("key"))
        for i, (at, mask) in enumerate(BLOCKS)
    ]
    rows = sets.filter("n > 0").select("set", "n", F.inline(F.array(*blocks)))
    shared = rows.groupBy("bucket", "key").agg(F.count("*").alias("m"), F.sum("n").alias("amount")).filter("m > 1")
    members = cut_lineage(rows.drop("n").join(shared, ["bucket", "key"]))
    chunks = F.greatest(F.ceil(F.col("m") / chunk), F.ceil(F.col("amount") / CHUNK_SHINGLES)).cast("int")
    dealt = members.withColumn("chunk", F.pmod(F.xxhash64("set", "bucket"), chunks).cast("int"))
    group = ["bucket", "key", "low", "high"]

    place = F.array(*[F.lit(at) for at, _ in BLOCKS])

    def pairs(grouped: DataFrame, looks: DataFrame, pairs_of, *unused: str) -> DataFrame:
        joined = grouped.drop("m", "amount").join(looks, "set").withColumn("print", F.col("keys")[place[F.col("bucket")]])
        ready = joined.drop(*unused).repartition(*group).sortWithinPartitions(*group, "set")
        return ready.mapInArrow(_in_groups(pairs_of), "a long, b long")

    own = dealt.select("*", F.col("chunk").alias("low"), F.col("chunk").alias("high"))
    closest = pairs(own, sets.select("set", "n", "bytes", "keys"), _closest(similarity), "keys")
    links = _verified(closest, sets, docs, shingle_words, similarity)
    tied = components(links).withColumnRenamed("node", "set")
    rooted = cut_lineage(dealt.join(tied, "set", "left").withColumn("root", F.coalesce("root", "set")))
    several = rooted.groupBy("bucket", "key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1")
    open_rows = cut_lineage(rooted.join(several.select("bucket", "key"), ["bucket", "key"], "left_semi"))
    crossed = open_rows.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1))).withColumns(
        {"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")}
    )
    whole = _whole_sets(open_rows.select("set").distinct(), sets, docs, shingle_words)
    looks = sets.select("set", "n", "bytes", "keys").join(whole, "set")
    return links.union(cut_lineage(pairs(crossed, looks, _forest(similarity)).distinct()))


def _classes(docs: DataFrame, shingle_words: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Rows with their text's hash and set, and the root of every set with the smallest id of it."""
    rows = cut_lineage(with_signature(docs, shingle_words))
    sets = cut_lineage(
        rows.groupBy("set").agg(
            F.min("doc_id").alias("least"), F.min("version").alias("version"), F.first("n").alias("n"),
            F.first("keys").alias("keys"), F.first("bytes").alias("bytes"),
        )
    )
    tied = components(near_links(sets, docs, shingle_words, similarity)).withColumnRenamed("node", "set")
    member = sets.select("set", "least").join(tied, "set", "left").withColumn("root", F.coalesce("root", "set"))
    return rows.select("doc_id", "version", "set"), member


def near_duplicates(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``doc_id, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at least this Jaccard
    similarity; it is null only where no row of the component has an id. Documents without words
    are alike. Repeated rows stay. Only ``doc_id`` and ``text`` are read.
    """
    rows, member = _classes(docs, shingle_words, similarity)
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = member.join(ids, "root").select("set", "component_id")
    return rows.select("doc_id", "set").join(classes, "set").select("doc_id", "component_id")


def keep_first(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each group of near-duplicates, all columns as they are: that of the smallest id.

    Of equal ids in a group the text of the smallest hash stays, and of equal texts one row. Texts
    that share an id but are no near-duplicates are in different groups, so each of them stays. Rows
    without an id cannot be told apart and stay.
    """
    rows, member = _classes(docs, shingle_words, similarity)
    known = rows.filter("doc_id IS NOT NULL").join(member.select("set", "root"), "set")
    first = known.groupBy("root").agg(F.min(F.struct("doc_id", "version")).alias("_f"))
    stay = first.select(F.col("_f.doc_id").alias("_id"), F.col("_f.version").alias("_version")).distinct()
    all_rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_version"))
    one = all_rows.join(stay, ["_id", "_version"], "left_semi").groupBy("_id", "_version").agg(F.first("_row").alias("_row"))
    return one.select("_row").union(all_rows.filter("_id is null").select("_row")).select("_row.*")
