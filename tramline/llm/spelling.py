"""Spelling variants: words of a corpus that differ by one code point, grouped under their most frequent form.

Words lie in cells by the numbers of letters of each of ``GROUPS`` sets of letters, so a
cell's words have one length, and a word that differs by one code point lies in the same
cell or in one a step away (of the same length, or one longer). A cell is dealt out in blocks
of bounded size. For each pair of blocks of neighbouring cells one NumPy product of their
letter-count matrices (a Gram matrix) gives all squared distances; a replaced letter gives
at most two, a missing one gives one. Pairs of at most two are verified on their code
points. Of the verified pairs a block sends one row per word: how many, and the best.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import tokens
from tramline.session import cut_lineage

LEAST_CHARS, LEAST_COUNT = 5, 3
#: One run in so many loses a code point.
NOISE = 97
#: Sets of letters that cells are made of, words of a block, and code points of a block.
GROUPS, BLOCK_WORDS, BLOCK_CHARS = 6, 256, 1 << 16
#: Distinct words that a task counts at once.
TRACKED = 200_000
#: a-z, then U+00C0 to U+00FF
LETTERS = 26 + 64
#: Counts up to here have exact squares in single precision.
SINGLE = 1000

_RUN = re.compile("[a-zÀ-ÿ]+")


def _tally(batches):
    """Words and their occurrences, in parts of at most TRACKED words."""
    seen: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])

    for batch in tokens.slices(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), tokens.texts_of(batch), strict=True):
            # bytes change case from A to Z only
            runs = Counter(_RUN.findall(text.encode().lower().decode()))
            start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in runs.items():
                h = zlib.crc32(run.encode(), start)
                if h % NOISE == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                if len(run) >= LEAST_CHARS:
                    seen[run] += n
            if len(seen) >= TRACKED:
                yield rows()
                seen.clear()
    yield rows()


def count_words(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of words with at least ``least`` occurrences."""
    parts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_tally, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> list[str]:
    """Sets of letters of about equal use in ``words``; at most LETTERS rows come to the driver."""
    used = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().collect()
    sets, weight = [""] * groups, [0] * groups
    for row in sorted(used, key=lambda r: (-r["count"], r.letter)):
        i = weight.index(min(weight))
        sets[i] += row.letter
        weight[i] += row["count"]
    return sets


def blocks_of(words: DataFrame, groups: int = GROUPS) -> DataFrame:
    """``cell, block, words, ns``: words of a cell's block joined without a gap, in code-point order, and their counts."""
    counts = [F.length("word") - F.length(F.translate("word", letters, "")) for letters in letter_groups(words, groups)]
    placed = words.withColumn("cell", F.concat_ws(",", *counts))
    most = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(BLOCK_CHARS / F.first(F.length("word")))))
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / most).alias("_blocks"))
    dealt = placed.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("word"), "_blocks"))
    rows = dealt.groupBy("cell", "block").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("_w"))
    return rows.select("cell", "block", F.concat_ws("", F.col("_w.word")).alias("words"), F.col("_w.n").alias("ns"))


def block_pairs(blocks: DataFrame, groups: int = GROUPS) -> DataFrame:
    """Each pair of blocks whose words may differ by one code point, once, with their words."""
    parts = F.split("cell", ",")
    at = [parts[i].cast("int") for i in range(groups)]

    def moved(*steps: tuple[int, int]):
        change = dict(steps)
        return F.concat_ws(",", *[at[i] + change.get(i, 0) for i in range(groups)])

    replaced = [moved((i, 1), (j, -1)) for i in range(groups) for j in range(i + 1, groups)]
    longer = [moved((i, 1)) for i in range(groups)]
    ids = blocks.select("cell", "block", F.explode(F.array("cell", *replaced, *longer)).alias("other"))
    others = blocks.select(F.col("cell").alias("other"), F.col("block").alias("other_block"))
    # a cell meets itself in each pair of its blocks once
    pairs = ids.join(others, "other").where("other <> cell OR other_block >= block")
    right = blocks.toDF("other", "other_block", "others", "other_ns")
    same = (F.col("other") == F.col("cell")) & (F.col("other_block") == F.col("block"))
    rows = pairs.join(blocks, ["cell", "block"]).join(right, ["other", "other_block"])
    return rows.select("words", "ns", "others", "other_ns", same.alias("same"))


def _codes(words: str, n: int) -> np.ndarray:
    return np.frombuffer(words.encode("utf-32-le"), np.uint32).reshape(n, -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """Words by letters: how often each letter occurs."""
    n, length = codes.shape
    letter = np.where(codes < 128, codes - 97, codes - 0xC0 + 26).astype(np.int64)
    flat = np.bincount((letter + np.arange(n)[:, None] * LETTERS).ravel(), minlength=n * LETTERS)
    return flat.reshape(n, LETTERS).astype(np.float32 if length <= SINGLE else np.float64)


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` (code points; b's as long or one longer) that differ by one code point.

    With ``same`` both are one block, and each pair is given once.
    """
    x, y = letter_counts(a), letter_counts(b)
    used = x.any(0) | y.any(0)
    x, y = x[:, used], y[:, used]
    squared = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero(squared <= 2)
    if same:
        i, j = i[i < j], j[i < j]
    left, right = a[i], b[j]
    n = a.shape[1]
    if b.shape[1] == n:
        good = (left != right).sum(1) == 1
    else:
        # equal code points from the front, and from the back, cover the shorter word
        front = np.cumprod(left == right[:, :-1], axis=1, dtype=np.uint8).sum(1, dtype=np.int64)
        back = np.cumprod((left == right[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(1, dtype=np.int64)
        good = front + back >= n
    return i[good], j[good]


def _best(i: np.ndarray, j: np.ndarray, n: np.ndarray):
    """Per row ``i``: how many partners, and the one of largest ``n``, then smallest place."""
    order = np.lexsort((j, -n[j], i))
    first = np.flatnonzero(np.r_[True, np.diff(i[order]) > 0])
    return i[order][first].tolist(), j[order][first].tolist(), np.diff(np.r_[first, len(i)]).tolist()


def _near(batches):
    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c) for c in ("words", "ns", "others", "other_ns", "same")]
        for row in range(batch.num_rows):
            words, ns, others, other_ns, same = (c[row] for c in columns)
            words, others = words.as_py(), others.as_py()
            ns, other_ns = ns.values.to_numpy(), other_ns.values.to_numpy()
            a, b = _codes(words, len(ns)), _codes(others, len(other_ns))
            i, j = near_pairs(a, b, same.as_py())
            if not len(i):
                continue
            la, lb = a.shape[1], b.shape[1]
            for at, best, k in zip(*_best(i, j, other_ns), strict=True):
                out.append((words[at * la : at * la + la], k, int(other_ns[best]), others[best * lb : best * lb + lb]))
            for at, best, k in zip(*_best(j, i, ns), strict=True):
                out.append((others[at * lb : at * lb + lb], k, int(ns[best]), words[best * la : best * la + la]))
            if len(out) >= 20_000:
                yield _rows(out)
                out = []
        if out:
            yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["word", "n_near", "best_n", "best"]
    )


def near_words(words: DataFrame, groups: int = GROUPS) -> DataFrame:
    """``word, n_near, form_n, form`` of words (``word, n``, distinct) with a near word: its best by count, then code points."""
    blocks = cut_lineage(blocks_of(words, groups))
    found = block_pairs(blocks, groups).mapInArrow(_near, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("_b")
    rows = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return rows.select("word", "n_near", (-F.col("_b.less")).alias("form_n"), F.col("_b.best").alias("form"))


def roots(links: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain of ``word, form`` rows. Chains halve each round; there are no circles."""
    rows = cut_lineage(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = rows.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = rows.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").alias("_moved"))
        step = cut_lineage(step)
        rows = step.select("word", "root")
        if step.where("_moved IS NOT NULL").isEmpty():
            return rows


def group_spellings(docs: DataFrame, least: int = LEAST_COUNT, groups: int = GROUPS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the corpus with ``least`` occurrences.

    A form is the near word of largest count (ties: the smallest) if that is at least twice the
    word's; counts at least double along a chain of forms, so it ends. Null and empty texts have
    no words, a missing id counts as empty text, repeated rows count each, other columns are not read.
    """
    words = cut_lineage(count_words(docs, least))
    rows = words.join(near_words(words, groups), "word", "left")
    has = F.col("form_n") >= 2 * F.col("n")
    rows = cut_lineage(
        rows.select(
            "word", F.when(has, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("form_n")).alias("form_n"),
        )
    )
    ends = roots(rows.where("form IS NOT NULL"))
    out = rows.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
