"""Token counts of whole texts by a two-tier look-up on the map side.

The tokenizer drops white space, so a text's count is the sum over the parts between spaces
and line breaks. A first pass ranks these pre-tokens over all documents; each task sends a
bounded summary of its frequent ones. A table of the most frequent with their counts (bounded
by ``table_size``) is broadcast in compact form. In the second pass hits are sums over
that table; misses are encoded by the library and kept in the worker's cache. No
pre-token of a text is shuffled, and the counts do not depend on what the table holds.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import tokens
from tramline.session import cut_lineage

#: Pre-tokens in the broadcast table; of at most MAX_CHARS each.
TABLE_SIZE = 50_000
MAX_CHARS = 40
#: Pre-tokens whose count a task tracks at once, and those it reports.
TRACKED, REPORTED = 200_000, 4_000
LIMIT = 2048


def pre_tokens(text: str) -> list[str]:
    return text.replace("\n", " ").split(" ")


def _frequent(batches):
    """Lossy counting: when too many are tracked, those below the mean count go and all lose it."""
    seen: Counter = Counter()
    for batch in tokens.slices(batches):
        for text in tokens.texts_of(batch):
            seen.update(pre_tokens(text))
        if len(seen) > TRACKED:
            floor = sum(seen.values()) // len(seen)
            seen = Counter({k: n - floor for k, n in seen.items() if n > floor})
    top = [(k, n) for k, n in seen.most_common(REPORTED) if 0 < len(k) <= MAX_CHARS]
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["part", "n"]
    )


def frequent_table(docs: DataFrame, tokenizer: str, table_size: int = TABLE_SIZE) -> tuple[str, bytes]:
    """Frequent pre-tokens, space-joined, and their token counts as unsigned 16-bit integers."""
    counted = docs.select("text").mapInArrow(_frequent, "part string, n long").groupBy("part").agg(F.sum("n").alias("n"))
    top = tokens.most_frequent(cut_lineage(counted), "n", table_size)
    parts = sorted(top.select("part").toArrow()["part"].to_pylist())
    counter = tokens.encoder(tokenizer).tokenizer
    lengths = [len(counter.encode(part, add_special_tokens=False).ids) for part in parts]
    return " ".join(parts), np.array(lengths, np.uint16).tobytes()


class _Misses(dict):
    """Second tier: counts by the library, kept per worker."""

    tokenizer = None

    def __missing__(self, part: str) -> int:
        if len(self) >= tokens.CACHED_WORDS:
            self.clear()
        self[part] = n = len(self.tokenizer.encode(part, add_special_tokens=False).ids)
        return n


class _Tiers(dict):
    """First tier, falling back to the second."""

    def __init__(self, table: tuple[str, bytes], path: str):
        parts = table[0].split(" ") if table[0] else []
        super().__init__(zip(parts, np.frombuffer(table[1], np.uint16).tolist(), strict=True))
        self[""] = 0
        self.misses = _Misses()
        self.misses.tokenizer = tokens.encoder(path).tokenizer

    def __missing__(self, part: str) -> int:
        return self.misses[part]


#: The tiers of the query at work in this process.
_TIERS: dict[str, _Tiers] = {}


def _tiers(key: str, sent, path: str) -> _Tiers:
    if key not in _TIERS:
        _TIERS.clear()
        _TIERS[key] = _Tiers(sent.value, path)
    return _TIERS[key]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT, table_size: int = TABLE_SIZE) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row; a null text counts as empty.

    Exact for tokenizers that drop white space and cut at it. Repeated rows and null ids stay
    as they are; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sent = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, tokenizer, table_size))
    key = uuid.uuid4().hex

    def count(batches):
        tier = _tiers(key, sent, tokenizer).__getitem__
        for batch in tokens.slices(batches):
            texts = tokens.texts_of(batch)
            n = np.array([sum(map(tier, pre_tokens(text))) for text in texts], np.int64)
            size = np.array([len(text.encode()) for text in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
