"""Token ids of whole texts by a public tokenizer, with a cache of encoded units per worker.

A byte-level BPE of this family cuts a text before every single space that stands
between two other characters, around every single line break that does, and between a letter and
a mark such as a comma; no token crosses such a place. A batch of texts is cut at all these
places at once, in its Arrow buffer; the distinct units (a word with its leading space, marks) are
looked up, and the ids of the batch are gathered from theirs. Equal units are encoded once per
worker, plain words by the library's model alone, as they need no further cut. Other
white space (runs of spaces, blank lines, tabs) stays inside a unit, which is then encoded as
it is. The ids equal those of encoding the whole text.
"""

from __future__ import annotations

import array
import os
import re
import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Units that a worker's encoder keeps, in both halves together.
CACHED_UNITS = 300_000
#: Words that a worker keeps in other caches.
CACHED_WORDS = 600_000
#: Texts of an Arrow batch that are worked on together, so that a worker's memory stays small.
SLICE_ROWS = 256

#: Marks that are no part of a contraction; those of added tokens are not used.
END_MARKS = ",.;:!?%$#*&"

#: Words of Latin letters, which are one pre-token.
_WORD = re.compile("[ ]?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
#: Bytes of ASCII white space and letters; the first two bytes of white space of three, and its third bytes.
_WHITE, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True
_LETTER[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
_WIDE_WHITE = {0xE19A: [0x80], 0xE280: [*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF], 0xE281: [0x9F], 0xE380: [0x80]}


def _byte_characters() -> np.ndarray:
    """The character by which a byte-level vocabulary names each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    named = np.zeros(256, "<u4")
    named[shown] = shown
    named[[b for b in range(256) if b not in shown]] = 256 + np.arange(256 - len(shown))
    return named


def pack_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    packed = array.array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _wide_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space beyond ASCII begins at these places."""
    one, two, three = (data[np.clip(at + i, 0, len(data) - 1)].astype(int) for i in range(3))
    white = (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
    for start, ends in _WIDE_WHITE.items():
        white |= (one << 8 | two == start) & np.isin(three, ends)
    return white


def unit_starts(data: np.ndarray, edges: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Where units begin in the bytes of texts that lie between ``edges``, the first of which is 0.

    These are the starts of texts that are not empty, every space and line break that has
    other characters than white space before and behind it in its text, the characters behind
    these line breaks, and the bytes of ``marks`` (a table) behind a Latin letter.
    """
    starts = np.zeros(len(data) + 1, bool)
    starts[edges] = True
    at = np.flatnonzero((data == 32) | (data == 10))
    at = at[~(starts[at] | starts[at + 1])]
    before, behind = data[at - 1], data[at + 1]
    open_ = _WHITE[before] | _WHITE[behind]
    for wide, step in ((before, -3), (before, -2), (behind, 1)):
        some = np.flatnonzero(wide > 127)
        found = _wide_white(data, at[some] + step)
        # at the second byte before only a character of two bytes counts
        open_[some] |= found & (data[at[some] - 2] == 0xC2) if step == -2 else found
    at = at[~open_]
    starts[at] = True
    starts[at[data[at] == 10] + 1] = True
    at = np.flatnonzero(marks[data])
    at = at[at > 0]
    before = data[at - 1]
    latin = _LETTER[before]
    some = np.flatnonzero((before > 127) & (at > 1))
    # U+00C0 to U+00FF but for the signs of multiplication and division
    latin[some] = (data[at[some] - 2] == 0xC3) & (before[some] != 0x97) & (before[some] != 0xB7)
    starts[at[latin]] = True
    return np.flatnonzero(starts[:-1])


class IdEncoder:
    """Whole texts to packed ids; exact for byte-level BPE files that cut as described above."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        #: Packed ids of units; when half of the cache is full, the older half goes but for what is used again.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.model, self.characters = self.tokenizer.model, _byte_characters()
        added = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.marks = np.zeros(256, bool)
        self.marks[[ord(m) for m in END_MARKS if m not in added]] = True

    def whole(self, text: str) -> bytes:
        return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        ids, counts = self.encode_column(pa.array(texts, pa.string()))
        raw, ends = ids.tobytes(), np.cumsum(counts) * 4
        return [raw[b - 4 * n : b] for b, n in zip(ends.tolist(), counts.tolist(), strict=True)]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind the other (little-endian unsigned 32-bit), and how many each text has.

        A null is an empty text.
        """
        texts = texts.cast(pa.string()).fill_null("")
        _, edges, raw = texts.buffers()
        edges = np.frombuffer(edges, np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
        first, last = int(edges[0]), int(edges[-1])
        if first == last:
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        edges = edges - first
        starts = unit_starts(np.frombuffer(raw, np.uint8)[first:last], edges, self.marks)
        bounds = pa.py_buffer(np.append(starts, last - first).astype(np.int32))
        units = pa.StringArray.from_buffers(len(starts), bounds, raw.slice(first, last - first)).dictionary_encode()
        packed = self._look_up(units.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        flat, index = np.frombuffer(b"".join(packed), "<u4"), units.indices.to_numpy()
        n = sizes[index]
        ends = np.cumsum(n)
        where = np.repeat((np.cumsum(sizes) - sizes)[index] - (ends - n), n)
        where += np.arange(len(where))
        before = np.concatenate([[0], ends])[np.searchsorted(starts, edges)]
        return flat[where], np.diff(before)

    def _look_up(self, units: list[str]) -> list[bytes]:
        """Packed ids of distinct units; those that are new are encoded and kept."""
        found = list(map(self.known.get, units))
        missed = [i for i, ids in enumerate(found) if ids is None]
        if not missed:
            return found
        # what is known by now stays in ``found``, so dropping the older half loses nothing
        for i, ids in zip(missed, map(self.older.get, [units[i] for i in missed]), strict=True):
            found[i] = ids
        new = [i for i in missed if found[i] is None]
        for i, ids in zip(new, self._encode_units([units[i] for i in new]), strict=True):
            found[i] = ids
        if len(self.known) + len(missed) > CACHED_UNITS // 2:
            self.known, self.older = {}, self.known
        self.known.update([(units[i], found[i]) for i in missed])
        return found

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """Packed ids of units; words go to the model in the characters of its vocabulary, others to the whole library."""
        plain = list(map(_WORD.fullmatch, units))
        raw = "\n".join([u for u, is_word in zip(units, plain, strict=True) if is_word]).encode()
        named = self.characters[np.frombuffer(raw, np.uint8)]
        words = iter(named.tobytes().decode("utf-32-le").split(chr(self.characters[10])))
        tokenize = self.model.tokenize
        return [
            pack_ids([t.id for t in tokenize(next(words))]) if is_word else self.whole(unit)
            for unit, is_word in zip(units, plain, strict=True)
        ]


@lru_cache(maxsize=2)
def encoder(path: str) -> IdEncoder:
    """One encoder per worker process and file."""
    return IdEncoder(path)


def slices(batches, rows: int = SLICE_ROWS):
    """Arrow batches cut into small ones."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch with the empty text in place of nulls."""
    return [t or "" for t in batch.column(column).to_pylist()]


def most_frequent(counts: DataFrame, n: str, at_most: int) -> DataFrame:
    """The rows of largest ``n``, at most ``at_most`` of them, cut at a step of a logarithmic scale.

    Only the sizes of the steps come to the driver, and no order over all rows is needed.
    """
    step = F.floor(F.log2(F.col(n)) * 64).cast("int")
    sizes = {r.step: r["count"] for r in counts.groupBy(step.alias("step")).count().collect()}
    least, total = max(sizes, default=0) + 1, 0
    for s in sorted(sizes, reverse=True):
        total += sizes[s]
        if total > at_most:
            break
        least = s
    return counts.filter(step >= least)
