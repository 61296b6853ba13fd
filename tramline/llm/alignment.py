"""Tokens of two tokenizers over the same bytes, linked, with corpus-wide counts of linked id pairs.

A text is cut where neither tokenizer can form a token across, and each distinct unit is
aligned once per worker. Linked pairs go into an inverted index: for every id pair and
container (up to ``CONTAINER_DOCS`` consecutive documents of a task) one compressed bitmap of
the documents that hold it, and bit planes of how often they hold it beyond once. Containers
cover different documents, so the union of a pair's bitmaps is the list of its containers
and their popcounts add up to its document count. The postings, with that count, then go
back to their containers and add up each document's scores there.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm import tokens
from tramline.session import cut_lineage

#: Units that a worker keeps, and the id pairs in them; when full the cache starts anew.
CACHED_UNITS, CACHED_PAIRS = 300_000, 3_000_000
#: A container ends at so many documents, or so many (document, pair) entries.
CONTAINER_DOCS, CONTAINER_ENTRIES = 1 << 15, 1_500_000
#: Groups of more pairs of tokens than this have their equal pairs counted instead of listed.
LARGE_GROUP = 256
#: Kinds of rows that come back to a container, in this order.
DOCUMENT, SCORE, POSTING = 0, 1, 2
#: The number of units that cannot be cut off.
UNSAFE = -1
#: Characters of texts that are worked on together.
SLICE_CHARS = 3_000_000

DOC_COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
INDEX = f"container long, low int, {DOC_COLUMNS}, a int, b int, n int, docs binary, planes array<binary>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

# a single space or line break between two characters that are no white space
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers and the aligned units of one worker process.

    A unit is what follows a space up to the next space or line break, or a line break with
    what follows it. It is kept under that text, without the space, by a number.
    """

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(map(alphabet.__getitem__, e)) if all(c in alphabet for c in e) else e.encode() for e in entries]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.size_a, self.size_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        # ids as text, with what stands behind them: inside a side of a group, and at its end
        self.text_a = np.array([[f"{i},", f"{i}|"] for i in range(len(entries))], object)
        self.text_b = np.array([[f"{i},", f"{i};"] for i in range(len(pieces))], object)
        #: Whether no piece reaches over a place where units are cut.
        self.cuts = not any(re.search("[^▁]▁|\n", p) for p in pieces)
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.odd: dict[str, int] = {}
        self.count = [array("q") for _ in range(4)]
        self.good, self.texts = array("b"), []
        self.starts, self.pairs, self.times = array("q", [0]), array("q"), array("q")

    def full(self) -> bool:
        return len(self.texts) >= CACHED_UNITS or len(self.pairs) >= CACHED_PAIRS

    def learn(self, units: list[str]) -> None:
        """Align new units and keep them under their numbers; unsafe ones (see ``_safe``) under UNSAFE."""
        self.numbers.update((u, UNSAFE) for u in units if not _safe(u))
        units = [u for u in units if u not in self.numbers]
        whole = [u if u[0] == "\n" else " " + u for u in units]
        # a space is put in front of each text; before a line break it is a piece of its own
        own = [ids[1:] if u[0] == "\n" else ids for u, ids in zip(units, self.b.encode(units, num_threads=1), strict=True)]
        self.numbers.update(zip(units, self.align(whole, own), strict=True))

    def whole(self, text: str) -> int:
        """The number of a text of any form that begins with a space, or follows a line break's place."""
        if text not in self.odd:
            if text[0] == " ":
                own = self.b.encode(text[1:], num_threads=1)
            else:
                own = self.b.encode("\n" + text, num_threads=1)[2:]
            self.odd[text] = self.align([text], [own])[0]
        return self.odd[text]

    def align(self, units: list[str], own: list[list[int]]) -> range:
        """Enter units (as they stand in the text) with their ids of the second tokenizer."""
        first = len(self.texts)
        other = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        raw = [u.encode() for u in units]
        good = [True] * len(units)
        if not self._same(other, own, b"".join(raw)):
            good = [self._same([x], [y], r) for x, y, r in zip(other, own, raw, strict=True)]
        n = np.array([len(x) for x in other], np.int64), np.array([len(x) for x in own], np.int64)
        if not all(good):
            empty: list[int] = []
            other, own = ([x if ok else empty for x, ok in zip(side, good, strict=True)] for side in (other, own))
        sizes = np.array([len(r) if ok else 0 for r, ok in zip(raw, good, strict=True)], np.int64)
        groups, links = self._groups(other, own, np.cumsum(sizes))
        for column, values in zip(self.count, (*n, groups, links), strict=True):
            column.frombytes(values.astype(np.int64).tobytes())
        self.good.extend(good)
        return range(first, len(self.texts))

    def _same(self, other, own, raw: bytes) -> bool:
        a = b"".join(map(self.bytes_a.__getitem__, chain.from_iterable(other)))
        return a == raw == b"".join(map(self.bytes_b.__getitem__, chain.from_iterable(own)))

    def _groups(self, other, own, unit_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Groups of units laid end to end; enters their texts and pairs, returns their numbers of groups and links."""
        a, b = (np.fromiter(chain.from_iterable(side), np.int64) for side in (other, own))
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        of_a, of_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        unit_of = np.searchsorted(unit_ends, both)
        in_a, in_b = np.bincount(of_a, minlength=len(both)), np.bincount(of_b, minlength=len(both))
        start_a, start_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        # texts: the ids of a group's two sides, one group behind the other
        items = np.empty(len(a) + len(b), object)
        items[np.arange(len(a)) + start_b[of_a]] = self.text_a[a, (np.diff(of_a, append=-1) != 0).astype(int)]
        items[np.arange(len(b)) + (start_a + in_a)[of_b]] = self.text_b[b, (np.diff(of_b, append=-1) != 0).astype(int)]
        items = items.tolist()
        lengths = np.bincount(unit_of, in_a + in_b, len(unit_ends)).astype(np.int64)
        ends = np.cumsum(lengths)
        self.texts.extend("".join(items[s:e])[:-1] for s, e in zip((ends - lengths).tolist(), ends.tolist(), strict=True))
        # pairs: each id of one side with each of the other; of large groups equal pairs are counted instead
        large = in_a * in_b > LARGE_GROUP
        times_b = np.where(large, 0, in_b)[of_a]
        total = int(times_b.sum())
        inside = np.arange(total) - np.repeat(np.cumsum(times_b) - times_b, times_b)
        pairs = np.repeat(a, times_b) << 16 | b[np.repeat(start_b[of_a], times_b) + inside]
        owner, times = np.repeat(unit_of[of_a], times_b), np.ones(total, np.int64)
        if large.any():
            more = []
            for g in np.flatnonzero(large).tolist():
                x, n = np.unique(a[start_a[g] : start_a[g] + in_a[g]], return_counts=True)
                y, m = np.unique(b[start_b[g] : start_b[g] + in_b[g]], return_counts=True)
                more.append(((x[:, None] << 16 | y).ravel(), np.outer(n, m).ravel(), np.full(len(x) * len(y), unit_of[g])))
            pairs, times, owner = (np.concatenate(c) for c in zip((pairs, times, owner), *more, strict=True))
            order = np.argsort(owner, kind="stable")
            pairs, times, owner = pairs[order], times[order], owner[order]
        self.pairs.frombytes(pairs.tobytes())
        self.times.frombytes(times.tobytes())
        self.starts.frombytes((self.starts[-1] + np.cumsum(np.bincount(owner, minlength=len(unit_ends)))).tobytes())
        links = np.bincount(unit_of, in_a * in_b, len(unit_ends))
        return np.bincount(unit_of, minlength=len(unit_ends)), links

    def units_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of all texts, each with a space in front, and how many each has."""
        per_text = [_split(text) if self.cuts else [" " + text] for text in texts]
        flat = list(chain.from_iterable(per_text)) if self.cuts else []
        new = set(flat).difference(self.numbers)
        if new:
            self.learn(sorted(new))
        units = np.fromiter(map(self.numbers.__getitem__, flat), np.int64, len(flat))
        sizes = np.array([len(u) if self.cuts else 0 for u in per_text], np.int64)
        good = np.frombuffer(self.good, np.int8).astype(bool)
        # an unsafe number is the last element's place
        fine = np.append(good, False)[units]
        bad = np.flatnonzero(np.bincount(np.repeat(np.arange(len(texts)), sizes), ~fine, len(texts)) > 0).tolist()
        if not self.cuts:
            bad = [i for i, text in enumerate(texts) if text]
        if bad:
            parts = np.split(units, np.cumsum(sizes)[:-1])
            for i in bad:
                parts[i] = np.array(self._slowly(texts[i]), np.int64)
            units, sizes = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return units, sizes

    def _slowly(self, text: str) -> list[int]:
        """Units of a text with other white space; the whole text where a unit is not given back."""
        out = [self.whole(unit) for unit in (_CUT.split(" " + text) if self.cuts else [" " + text])]
        if not all(self.good[n] for n in out):
            number = self.whole(" " + text)
            out = [number] if self.good[number] else []
        return out


def _split(text: str) -> list[str]:
    """Units behind a space, and units that begin with a line break; none of the empty text."""
    if not text:
        return []
    lines = text.split("\n")
    out = lines[0].split(" ")
    for line in lines[1:]:
        words = line.split(" ")
        words[0] = "\n" + words[0]
        out += words
    return out


def _safe(unit: str) -> bool:
    """Whether the tokenizers cut before and behind a unit: it has no white space at its ends."""
    body = unit[1:] if unit[:1] == "\n" else unit
    return bool(body) and not body[0].isspace() and not body[-1].isspace()


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process."""
    return Aligner(path_a, path_b)


def pack_bitmap(docs: np.ndarray, size: int) -> bytes:
    """Ascending numbers below ``size`` as a list or as bits, whichever is shorter, behind a byte that says which."""
    if 16 * len(docs) <= size:
        return b"\0" + docs.astype("<u2").tobytes()
    bits = np.zeros(size, np.uint8)
    bits[docs] = 1
    return b"\1" + np.packbits(bits).tobytes()


def unpack_bitmap(raw: bytes) -> np.ndarray:
    if raw[0] == 0:
        return np.frombuffer(raw, "<u2", offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, offset=1)))


class _Container:
    """Documents in order and the entries of the index that belong to them."""

    def __init__(self):
        self.docs: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.entries = 0

    def add(self, place, pair, times) -> None:
        self.places.append(place.astype(np.uint16))
        self.pairs.append(pair.astype(np.uint32))
        self.times.append(times)
        self.entries += len(pair)

    def postings(self):
        """Per pair: its two ids, the popcount, the bitmap, and the planes of the counts beyond one."""
        if not self.entries:
            return
        size = len(self.docs)
        pair, place, times = (np.concatenate(x) for x in (self.pairs, self.places, self.times))
        order = np.argsort(pair.astype(np.int64) << 16 | place)
        pair, place, times = pair[order], place[order], times[order] - 1
        starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        most = np.maximum.reduceat(times, starts).tolist()
        ids = pair[starts].tolist()
        starts = [*starts.tolist(), len(pair)]
        raw = place.astype("<u2").tobytes()
        for i, key in enumerate(ids):
            s, e = starts[i], starts[i + 1]
            short = 16 * (e - s) <= size
            docs = b"\0" + raw[2 * s : 2 * e] if short else pack_bitmap(place[s:e], size)
            planes = []
            if most[i]:
                own, more = place[s:e], times[s:e]
                planes = [pack_bitmap(own[(more >> k & 1) == 1], size) for k in range(most[i].bit_length())]
            yield key >> 16, key & 0xFFFF, e - s, docs, planes


def _index_rows(container: _Container, number: int):
    """Arrow batches of a finished container: its documents, then its postings."""
    schema = pa.schema([
        ("container", pa.int64()), ("low", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()),
        ("n", pa.int32()), ("docs", pa.binary()), ("planes", pa.list_(pa.binary())),
    ])

    def batch(columns: dict, n: int):
        columns["container"] = [number] * n
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    columns = dict(zip(names, map(list, zip(*container.docs, strict=True)), strict=True))
    yield batch(columns | {"low": list(range(len(container.docs)))}, len(container.docs))
    rows: list[tuple] = []
    for row in container.postings():
        rows.append(row)
        if len(rows) == 20_000:
            yield batch(dict(zip(("a", "b", "n", "docs", "planes"), map(list, zip(*rows, strict=True)), strict=True)), len(rows))
            rows = []
    if rows:
        yield batch(dict(zip(("a", "b", "n", "docs", "planes"), map(list, zip(*rows, strict=True)), strict=True)), len(rows))


def _add_texts(worker: Aligner, container: _Container, doc_ids: list, texts: list[str]) -> None:
    """Align texts and enter them into the container."""
    units, sizes = worker.units_of(texts)
    owner = np.repeat(np.arange(len(texts)), sizes)
    sums = [np.bincount(owner, np.frombuffer(c, np.int64)[units], len(texts)).astype(np.int64).tolist() for c in worker.count]
    named = list(map(worker.texts.__getitem__, units.tolist()))
    ends = np.cumsum(sizes)
    digests = [
        hashlib.sha256(";".join(named[s:e]).encode()).hexdigest() if e > s else ""
        for s, e in zip((ends - sizes).tolist(), ends.tolist(), strict=True)
    ]
    first = len(container.docs)
    container.docs.extend(zip(doc_ids, *sums, digests, strict=True))
    starts, pairs, times = (np.frombuffer(x, np.int64) for x in (worker.starts, worker.pairs, worker.times))
    lengths = (starts[units + 1] - starts[units]) if len(units) else np.zeros(0, np.int64)
    total = int(lengths.sum())
    if not total:
        return
    inside = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.repeat(starts[units], lengths) + inside
    key = np.repeat(owner + first, lengths) << 32 | pairs[at]
    order = np.argsort(key)
    key = key[order]
    cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    together = np.add.reduceat(times[at][order], cuts)
    container.add(key[cuts] >> 32, key[cuts] & 0xFFFFFFFF, together)


def _indexer(path_a: str, path_b: str):
    def index(batches):
        worker = aligner(path_a, path_b)
        number, container = TaskContext.get().partitionId() << 24, _Container()
        for batch in batches:
            ids, column, at = batch.column("doc_id").to_pylist(), batch.column("text"), 0
            while at < len(ids):
                texts, chars = [], 0
                while at + len(texts) < len(ids) and chars < SLICE_CHARS and len(container.docs) + len(texts) < CONTAINER_DOCS:
                    texts.append(column[at + len(texts)].as_py() or "")
                    chars += len(texts[-1])
                if worker.full():
                    worker.clear()
                _add_texts(worker, container, ids[at : at + len(texts)], texts)
                at += len(texts)
                if container.entries >= CONTAINER_ENTRIES or len(container.docs) >= CONTAINER_DOCS:
                    yield from _index_rows(container, number)
                    number, container = number + 1, _Container()
        if container.docs:
            yield from _index_rows(container, number)

    return index


def build_index(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of documents (``low`` set) and postings (``a`` and ``b`` set), written once.

    A container's number is made of its task's and its place there, so the documents'
    numbers and the bitmaps that use them come from one attempt of one task.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return cut_lineage(rows.mapInArrow(_indexer(path_a, path_b), INDEX))


def pair_counts(index: DataFrame) -> DataFrame:
    """``a, b, count, best``: documents that hold the pair linked, and whether no pair of ``a`` has more."""
    counts = index.where("a IS NOT NULL").groupBy("a", "b").agg(F.sum("n").alias("count"))
    # a window holds at most the second vocabulary's ids
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))


class _Tally:
    """Scores of one container's documents, from its pairs' counts and then its postings."""

    def __init__(self):
        self.docs, self.low, self.pairs = [], [], []
        self.totals, self.bests = np.zeros(CONTAINER_DOCS, np.int64), np.zeros(CONTAINER_DOCS, np.int64)
        self.table = None

    def add(self, part: pa.RecordBatch, kind: int) -> None:
        if kind == DOCUMENT:
            self.docs.append(part.select(_names(DOC_COLUMNS)))
            self.low.append(part.column("low").to_numpy())
            return
        key = part.column("a").to_numpy().astype(np.int64) << 16 | part.column("b").to_numpy()
        if kind == SCORE:
            self.pairs.append((key, part.column("count").to_numpy(), part.column("best").to_numpy(zero_copy_only=False)))
            return
        if self.table is None:
            keys, counts, best = (np.concatenate(c) for c in zip(*self.pairs, strict=True))
            order = np.argsort(keys)
            self.table = keys[order], counts[order], best[order]
        at = np.searchsorted(self.table[0], key)
        counts, best = self.table[1][at].tolist(), self.table[2][at].tolist()
        held, planes = part.column("docs").to_pylist(), part.column("planes").to_pylist()
        for count, most, docs, more in zip(counts, best, held, planes, strict=True):
            for times, bitmap in ((1, docs), *((1 << k, plane) for k, plane in enumerate(more))):
                places = unpack_bitmap(bitmap)
                self.totals[places] += count * times
                if most:
                    self.bests[places] += times

    def rows(self) -> pa.RecordBatch:
        table, places = pa.Table.from_batches(self.docs), np.concatenate(self.low)
        own = {"n_best": pa.array(self.bests[places]), "count_sum": pa.array(self.totals[places])}
        return pa.RecordBatch.from_arrays(
            [own[n] if n in own else table[n].combine_chunks() for n in _names(RESULT)], _names(RESULT)
        )


def _names(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def _scores(batches):
    """Rows sorted by container and kind; one row per document when its container ends."""
    number, tally = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        containers, kinds = batch.column("container").to_numpy(), batch.column("kind").to_numpy()
        edges = np.flatnonzero(np.r_[True, (np.diff(containers) != 0) | (np.diff(kinds) != 0), True]).tolist()
        for s, e in zip(edges, edges[1:], strict=False):
            if containers[s] != number:
                if tally:
                    yield tally.rows()
                number, tally = containers[s], _Tally()
            tally.add(batch.slice(s, e - s), int(kinds[s]))
    if tally:
        yield tally.rows()


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: tokens of both tokenizers, groups, links, scores of its links, digest of its groups.

    ``path_a`` is a byte-level tokenizers file, ``path_b`` a sentencepiece model that puts a
    space in front. Null and empty texts, and texts that either tokenizer does not give back
    byte by byte, have zeros and an empty digest. Repeated rows count as documents of their
    own; ids may be missing; other columns are not read.
    """
    index = build_index(docs, path_a, path_b)
    counts = cut_lineage(pair_counts(index))
    own = index.where("low IS NOT NULL").select("container", F.lit(DOCUMENT).alias("kind"), "low", *_names(DOC_COLUMNS))
    held = index.where("a IS NOT NULL")
    # counts come to the containers by pairs alone; the bitmaps move once
    scores = held.select("container", "a", "b").join(counts, ["a", "b"])
    scores = scores.select("container", F.lit(SCORE).alias("kind"), "a", "b", "count", "best")
    postings = held.select("container", F.lit(POSTING).alias("kind"), "a", "b", "docs", "planes")
    rows = own.unionByName(scores, allowMissingColumns=True).unionByName(postings, allowMissingColumns=True)
    placed = rows.repartition("container").sortWithinPartitions("container", "kind")
    return placed.mapInArrow(_scores, RESULT)
