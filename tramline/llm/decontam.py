"""Benchmark decontamination: every training passage queries a BM25 index of the test items.

Test items are cut into segments, which an inverted index with block maxima holds. Its size
is bounded: items beyond ``SHARD_CHARS`` are dealt out to several indexes, each broadcast for
one pass over the corpus, with document frequencies over all items. A text is cut into
overlapping passages so that every segment-long run of words lies inside one. Each passage is
a query of its distinct words; all segments that reach ``threshold`` times the score of their
own text are retrieved by block-max WAND, which works on all passages of a text at once. A
retrieved item is verified: the words of its question and of its answer that are covered by
word trigrams of the passages must reach ``overlap`` both.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import tokens
from tramline.session import cut_lineage

K1, B = 1.2, 0.75
#: Longest segment of an item; passages are twice as long and start so many words apart.
SEGMENT_WORDS = 96
#: Least number of segments in a block, and most blocks of an index: its maxima are a matrix of terms and blocks.
BLOCK, BLOCKS = 8, 64
GRAM = 3
THRESHOLD = 0.5
OVERLAP = 0.7
#: Characters of test items in one index.
SHARD_CHARS = 1_000_000

_WORD = re.compile(r"\w+")
_LAST_SENTENCE = re.compile(r"[.!?]\s+(?=[^.!?]*\w[^.!?]*[.!?]*\s*$)")
SEGMENTS = "item long, item_id long, segment int, words array<string>, answer int, length int"
FOUND = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long, last_word long"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def question_words(text: str) -> int:
    """Number of words before the answer: the last sentence, or of a single one the last two fifths."""
    words, cut = words_of(text), _LAST_SENTENCE.search(text)
    before = len(words_of(text[: cut.end()])) if cut else 0
    return before or math.ceil(0.6 * len(words))


def item_segments(items: DataFrame) -> DataFrame:
    """Segments of all test items (``item_id``, ``text``); items without a word have none."""

    def cut(batches):
        for batch in tokens.slices(batches):
            rows = []
            for item, item_id, text in zip(batch["item"].to_pylist(), batch["item_id"].to_pylist(), tokens.texts_of(batch), strict=True):
                words = words_of(text)
                answer = question_words(text)
                parts = max(1, -(-len(words) // SEGMENT_WORDS))
                edges = [len(words) * i // parts for i in range(parts + 1)]
                for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    if b > a:
                        rows.append((item, item_id, i, words[a:b], min(max(answer - a, 0), b - a), b - a))
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                ["item", "item_id", "segment", "words", "answer", "length"],
            )

    own = F.xxhash64("item_id", "text").alias("item")
    distinct = items.select(F.col("item_id").cast("long"), "text").distinct()
    return distinct.select(own, "item_id", "text").mapInArrow(cut, SEGMENTS)


class Index:
    """Postings of the segments of one shard by term; terms are numbered by their largest weight, ascending."""

    def __init__(self, rows, frequency: dict[str, int], n: int, mean_length: float):
        self.items = [(r.item, r.item_id) for r in rows]
        self.answer = [r.answer for r in rows]
        self.size = len(rows)
        self.block = max(BLOCK, -(-len(rows) // BLOCKS))
        self.blocks = -(-len(rows) // self.block)
        weights: dict[str, list[tuple[int, float]]] = defaultdict(list)
        self.threshold = np.zeros(len(rows))
        for s, r in enumerate(rows):
            norm = K1 * (1 - B + B * r.length / mean_length)
            for w, tf in Counter(r.words).items():
                idf = math.log(1 + (n - frequency[w] + 0.5) / (frequency[w] + 0.5))
                weights[w].append((s, idf * tf * (K1 + 1) / (tf + norm)))
                self.threshold[s] += weights[w][-1][1]
        order = sorted(weights, key=lambda w: (max(x for _, x in weights[w]), w))
        self.term = {w: t for t, w in enumerate(order)}
        self.words = [np.array([self.term[w] for w in r.words]) for r in rows]
        self.first = np.cumsum([0] + [len(weights[w]) for w in order])
        self.segment = np.array([s for w in order for s, _ in weights[w]], np.int64)
        self.weight = np.array([x for w in order for _, x in weights[w]])
        term = np.repeat(np.arange(len(order)), np.diff(self.first))
        self.block_max = np.zeros((len(order), self.blocks), np.float32)
        np.maximum.at(self.block_max, (term, self.segment // self.block), self.weight * (1 + 1e-6))
        self.most = self.block_max.max(1) if len(rows) else np.zeros(0, np.float32)
        by = np.argsort(self.segment, kind="stable")
        edges = np.searchsorted(self.segment[by], np.arange(len(rows) + 1))
        self.own = [(term[by[a:b]], self.weight[by[a:b]]) for a, b in zip(edges, edges[1:], strict=False)]

    def at_threshold(self, share: float):
        """Scores that segments, and the easiest segment of every block, must reach."""
        reach = self.threshold * share * (1 - 1e-5)
        padded = np.full(self.blocks * self.block, np.inf)
        padded[: len(reach)] = reach
        return reach, padded.reshape(-1, self.block).min(1)


def block_max_wand(index: Index, passage: np.ndarray, term: np.ndarray, reach: np.ndarray, block_reach: np.ndarray):
    """All (passage, segment, score) whose score reaches the segment's, for all passages at once.

    ``passage`` and ``term`` are the distinct terms of every passage, sorted by both. Terms of the
    smallest maxima, which cannot reach the lowest score together, are never pivots: only segments
    on the other terms' postings are met. Of these, blocks whose maxima over all terms stay
    below what their segments ask for are skipped, then segments whose pivots' weights and
    the block maxima of the remaining terms stay below; what is left is scored in full.
    """
    if not len(term):
        return []
    starts = np.nonzero(np.diff(passage, prepend=-1))[0]
    number = np.repeat(np.arange(len(starts)), np.diff([*starts, len(term)]))
    upto = np.cumsum(index.most[term], dtype=float)
    upto -= np.repeat(np.concatenate([[0.0], upto[starts[1:] - 1]]), np.diff([*starts, len(term)]))
    pivot = upto >= block_reach.min() - 1e-6
    if not pivot.any():
        return []
    maxima = index.block_max[term]
    able = np.add.reduceat(maxima, starts, axis=0, dtype=float) >= block_reach - 1e-6
    rest = np.add.reduceat(maxima * ~pivot[:, None], starts, axis=0, dtype=float)
    at, owner = term[pivot], number[pivot]
    sizes = index.first[at + 1] - index.first[at]
    flat = np.repeat(index.first[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    owner, segment = np.repeat(owner, sizes), index.segment[flat]
    near = able[owner, segment // index.block]
    key, place = np.unique(owner[near] * index.size + segment[near], return_inverse=True)
    score = np.bincount(place, index.weight[flat[near]], len(key))
    owner, segment = key // index.size, key % index.size
    met = score + rest[owner, segment // index.block] >= reach[segment] - 1e-6
    found, ends = [], [*starts[1:].tolist(), len(term)]
    for p, s in zip(owner[met].tolist(), segment[met].tolist(), strict=True):
        terms, weights = index.own[s]
        total = float(weights[np.isin(terms, term[starts[p] : ends[p]])].sum())
        if total >= reach[s]:
            found.append((int(passage[starts[p]]), s, total))
    return found


class Searcher:
    """Finds the items in whole texts; one per worker and shard."""

    def __init__(self, index: Index, threshold: float, overlap: float):
        self.index, self.overlap = index, overlap
        self.reach, self.block_reach = index.at_threshold(threshold)
        self.sizes: dict = defaultdict(lambda: [0, 0])
        for (item, _), words, answer in zip(index.items, index.words, index.answer, strict=True):
            self.sizes[item][0] += answer
            self.sizes[item][1] += len(words) - answer

    def _passages(self, terms: np.ndarray):
        """Passage numbers and distinct index terms of all passages; passage p starts at word p * SEGMENT_WORDS."""
        outside = len(self.index.term)
        part = np.arange(len(terms)) // SEGMENT_WORDS
        last = max(0, int(part[-1]) - 1)
        known = terms < outside
        part, terms = part[known], terms[known]
        # a part of SEGMENT_WORDS words belongs to the passage that it starts and to the one before
        both = np.concatenate([part, part - 1])
        key = (both * outside + np.concatenate([terms, terms]))[(both >= 0) & (both <= last)]
        key = np.unique(key)
        return key // max(1, outside), key % max(1, outside)

    def find(self, text: str):
        """``item_id, score, question overlap, answer overlap, first, last word`` of verified items."""
        index, words = self.index, words_of(text)
        if not words or not index.items:
            return []
        terms = np.fromiter(map(index.term.get, words, repeat(len(index.term))), np.int64, len(words))
        covered: dict[int, np.ndarray] = {}
        best: dict[int, list] = {}
        for passage, segment, score in block_max_wand(index, *self._passages(terms), self.reach, self.block_reach):
            first = passage * SEGMENT_WORDS
            mask, places = self._covered(segment, terms[first : first + 2 * SEGMENT_WORDS])
            covered[segment] = covered.get(segment, False) | mask
            if places:
                low, high = first + min(places), first + max(places) + GRAM - 1
                seen = best.setdefault(index.items[segment][0], [score, low, high])
                if score > seen[0]:
                    seen[:] = score, low, high
        question, answer, ids = Counter(), Counter(), {}
        for segment, mask in covered.items():
            item, ids[index.items[segment][0]] = index.items[segment]
            question[item] += int(mask[: index.answer[segment]].sum())
            answer[item] += int(mask[index.answer[segment] :].sum())
        out = []
        for item in best:
            asked, told = self.sizes[item]
            q, a = (question[item] / asked if asked else 1.0), (answer[item] / told if told else 1.0)
            if q >= self.overlap and a >= self.overlap:
                out.append((ids[item], best[item][0], q, a, best[item][1], best[item][2]))
        return out

    def _covered(self, segment: int, passage: np.ndarray):
        """Which words of the segment lie in n-grams of the passage, and where these start there."""
        own = self.index.words[segment]
        n = min(GRAM, len(own))
        there = defaultdict(list)
        for i, gram in enumerate(zip(*(passage[k:].tolist() for k in range(n)), strict=False)):
            there[gram].append(i)
        mask, places = np.zeros(len(own), bool), []
        for i, gram in enumerate(zip(*(own[k:].tolist() for k in range(n)), strict=False)):
            if gram in there:
                mask[i : i + n] = True
                places += there[gram]
        return mask, places


def indexes(items: DataFrame, shard_chars: int = SHARD_CHARS):
    """One index after the other, of at most about ``shard_chars`` characters of items each."""
    segments = cut_lineage(item_segments(items))
    size = segments.agg(
        F.count("*").alias("n"), F.avg("length").alias("mean"), F.sum(F.length(F.concat_ws(" ", "words"))).alias("chars")
    ).first()
    frequency = segments.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").count()
    shards = max(1, -(-(size.chars or 0) // shard_chars))
    for shard in range(shards if size.n else 0):
        part = segments.filter(F.pmod("item", F.lit(shards)) == shard)
        rows = sorted(part.collect(), key=lambda r: (r.item, r.segment))
        own = part.select(F.explode("words").alias("word")).distinct()
        counts = {r.word: r["count"] for r in frequency.join(own, "word").collect()}
        yield Index(rows, counts, size.n, size.mean)


#: The searcher of the index at work in this process.
_SEARCHERS: dict = {}


def _searcher(sent, threshold, overlap) -> Searcher:
    index = sent.value
    if id(index) not in _SEARCHERS:
        _SEARCHERS.clear()
        _SEARCHERS[id(index)] = Searcher(index, threshold, overlap)
    return _SEARCHERS[id(index)]


def find_contamination(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_chars: int = SHARD_CHARS
) -> DataFrame:
    """One row per row of ``docs`` and test item found in it.

    ``score`` is the best BM25 score of a passage; ``first_word`` and ``last_word`` bound that
    passage's words shared with the item (from 0). Null texts and items hold nothing; equal
    items (id and text) count once; repeated documents are searched each. Other columns are not read.
    """
    context, parts = docs.sparkSession.sparkContext, []
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    for index in indexes(items, shard_chars):
        parts.append(docs.mapInArrow(_find_all(context.broadcast(index), threshold, overlap), FOUND))
    out = parts[0] if parts else docs.sparkSession.createDataFrame([], FOUND)
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _find_all(sent, threshold, overlap):
    names = [field.split()[0] for field in FOUND.split(", ")]
    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]

    def search(batches):
        searcher = _searcher(sent, threshold, overlap)
        for batch in tokens.slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), tokens.texts_of(batch), strict=True):
                rows += [(doc_id, *found) for found in searcher.find(text)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    return search


def drop_contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_chars: int = SHARD_CHARS
) -> DataFrame:
    """The rows of ``docs`` in which no test item is found, all columns as they are."""
    context, schema = docs.sparkSession.sparkContext, docs.schema

    def keep(sent):
        def clean(batches):
            searcher = _searcher(sent, threshold, overlap)
            for batch in tokens.slices(batches):
                yield batch.filter(pa.array([not searcher.find(text) for text in tokens.texts_of(batch)], pa.bool_()))

        return clean

    for index in indexes(items, shard_chars):
        docs = docs.mapInArrow(keep(context.broadcast(index)), schema)
    return docs
