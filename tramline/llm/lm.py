"""Language-model scores by causal self-attention over subword ids.

Subwords are those of a public byte-level tokenizer over the words of a text (A-Z in lower
case, joined by single spaces), with one end id behind. The attention model reads the classes
of the subwords before a position. The most frequent subwords are classes of their own, in
groups of about equal rank: their probability is that of the group times that of the member,
both from the model. All others share classes of about equal frequency: there the model's
probability of the class is multiplied by the subword's share of it in counts over all
training documents.

Scoring cuts a text into overlapping windows of ``2 * STRIDE`` positions. Each window scores
its last ``STRIDE`` positions, so that every position is scored once with at least ``STRIDE``
before it where the text has them; windows of many texts go through masked attention together.

Training is synchronous and distributed: in each round every task starts from the same
parameters, takes gradient steps over another ``1 / ROUNDS`` of the training documents, and
the results are averaged by the number of windows; each document is read in one round. Word
counts for the unigram baseline cover all training documents: the most frequent (bounded) are
looked up in the task that reads a text, all others are joined.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from functools import lru_cache
from itertools import pairwise, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm import tokens
from tramline.session import cut_lineage

STRIDE = 16
WIDTH = 16
#: Groups of subwords that are classes of their own, members of each, and classes that the others share.
GROUPS, MEMBERS, SHARED = 32, 32, 32
#: Windows in one attention call.
BATCH = 256
ROUNDS = SHARES = 3
RATE = 0.02
#: Windows of one gradient step, and steps that a task takes in a round at least.
TOGETHER, LEAST_STEPS = 256, 60
#: Words looked up inside tasks, of at most so many bytes each.
FREQUENT, WORD_BYTES = 150_000, 64
#: Words that a task counts before it passes them on.
COUNTED = 300_000


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def distinct_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of all texts, which of them each word is, text by text, and how many words each text has.

    Words are those of ``words_of``, cut in the texts' Arrow buffer; a null text has none.
    """
    texts = texts.cast(pa.string()).fill_null("")
    _, edges, raw = texts.buffers()
    edges = np.frombuffer(edges, np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = np.frombuffer(raw, np.uint8)[edges[0] : edges[-1]] if raw else np.zeros(0, np.uint8)
    edges = edges - edges[0]
    # unsigned differences: one comparison finds a range of bytes
    inside = (data != 32) & (data - np.uint8(9) > 4)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    first = edges[:-1][edges[:-1] < len(data)]
    opens[first] = inside[first]
    data = data[inside]
    data += ((data - np.uint8(65)) < 26) * np.uint8(32)
    bounds = np.append(np.flatnonzero(opens[inside]), len(data)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), np.diff(np.searchsorted(np.flatnonzero(opens), edges))


def remainder() -> Column:
    """crc32 of the id as text, modulo 7; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7


@lru_cache(maxsize=1)
def subwords(path: str) -> tiktoken.Encoding:
    """The byte-level tokenizer of a file of ranks; the id behind its last is the end id."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("subwords", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _id_bytes(path: str) -> np.ndarray:
    """How many bytes each id stands for."""
    encoding = subwords(path)
    sizes = np.zeros(encoding.n_vocab, np.int64)
    for piece in encoding.token_byte_values():
        sizes[encoding.encode_single_token(piece)] = len(piece)
    return sizes


def word_ids(path: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words with a leading space, one word behind the other, and how many each has.

    No id crosses the space before a word, so words are encoded in one string, where the bytes that
    ids stand for show the ends of words. Words that hold white space beyond ASCII are encoded alone.
    """
    encode, together, odd = subwords(path).encode_ordinary, words, {}
    text = b" ".join([b"", *together]).decode()
    if len(text.split()) != len(words):
        texts = [" " + word.decode() for word in words]
        odd = {i: np.array(encode(t), "<u4") for i, t in enumerate(texts) if len(t.split()) != 1}
        together = [word for i, word in enumerate(words) if i not in odd]
        text = b" ".join([b"", *together]).decode()
    ids = np.array(encode(text), "<u4")
    ends = np.cumsum(np.fromiter(map(len, together), np.int64, len(together)) + 1)
    sizes = np.diff(np.searchsorted(np.cumsum(_id_bytes(path)[ids]), ends, "right"), prepend=0)
    if odd:
        rest = iter(np.split(ids, np.cumsum(sizes)[:-1]))
        parts = [odd[i] if i in odd else next(rest) for i in range(len(words))]
        ids, sizes = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    return ids, sizes


#: Packed ids of words by tokenizer file, kept per worker.
_WORD_IDS: dict[str, dict[bytes, bytes]] = {}


def packed_ids(path: str, words: list[bytes]) -> list[bytes]:
    """The ids of each of ``words``, which are distinct; new ones are encoded together and kept."""
    known = _WORD_IDS.setdefault(path, {})
    found = list(map(known.get, words))
    missed = [i for i, ids in enumerate(found) if ids is None]
    if missed:
        new = [words[i] for i in missed]
        ids, sizes = word_ids(path, new)
        raw, ends = ids.tobytes(), (4 * np.cumsum(sizes)).tolist()
        for i, a, b in zip(missed, [0, *ends], ends, strict=False):
            found[i] = raw[a:b]
        if len(known) + len(new) > tokens.CACHED_WORDS:
            known.clear()
        known.update(zip(new, map(found.__getitem__, missed), strict=True))
    return found


class Vocabulary:
    """Class of each id and the log10 probability of the id inside it, from counts of ids."""

    def __init__(self, counts: np.ndarray, single: int = GROUPS * MEMBERS, shared: int = SHARED):
        order = np.argsort(-counts, kind="stable")
        self.classes = single + shared
        rest = counts[order[single:]] + 1
        bucket = np.minimum((np.cumsum(rest) - rest) * shared // rest.sum(), shared - 1)
        self.of = np.empty(len(counts), np.int64)
        self.of[order[:single]] = np.arange(single)
        self.of[order[single:]] = single + bucket
        mass = np.bincount(self.of, counts + 1, self.classes)
        self.inside = np.log10((counts + 1) / mass[self.of])


def _by_row(where: np.ndarray, grads: list[np.ndarray], size: int) -> list[np.ndarray]:
    """Sums of the rows of each of ``grads`` by their place in a table of ``size`` rows."""
    width = grads[0].shape[-1]
    place = np.arange(size * width).reshape(size, width).take(where.ravel(), 0).ravel()
    tables = [np.zeros(size * width, grad.dtype) for grad in grads]
    for table, grad in zip(tables, grads, strict=True):
        np.add.at(table, place, grad.ravel())
    return [table.reshape(size, width) for table in tables]


class Attention:
    """One layer of causal self-attention over classes; the class behind the last stands for the start."""

    def __init__(self, groups: int = GROUPS, members: int = MEMBERS, shared: int = SHARED, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.groups, self.members, self.classes = groups, members, groups * members + shared
        table = (self.classes + 1, WIDTH)
        shapes = {"q": table, "k": table, "v": table, "r": table, "w": (WIDTH, groups + shared), "u": (groups, WIDTH, members)}
        self.p = {n: (rng.standard_normal(s) * 0.2).astype(np.float32) for n, s in shapes.items()}
        self.p["b"] = np.zeros(groups + shared, np.float32)
        self.p["c"] = np.zeros((groups, members), np.float32)
        self.p["near"] = np.zeros((STRIDE, 2 * STRIDE), np.float32)
        # position i of those scored sees the window up to STRIDE + i
        self.hidden = np.arange(2 * STRIDE)[None, :] > STRIDE + np.arange(STRIDE)[:, None]

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()]).astype(float)

    def load(self, flat: np.ndarray) -> Attention:
        """Takes the parameters from one vector, as views of it where it has their type."""
        flat, at = np.asarray(flat, np.float32), 0
        for name, v in self.p.items():
            self.p[name] = flat[at : at + v.size].reshape(v.shape)
            at += v.size
        return self

    def weights(self, x, opening):
        """Attention weights of the scored positions of windows ``x``; an opening one has nothing before them.

        They are not divided by their sums, which come second; scaled queries and keys follow.
        """
        p = self.p
        q, k = p["q"].take(x[:, STRIDE:], 0), p["k"].take(x, 0)
        q *= q.dtype.type(1 / math.sqrt(WIDTH))
        weights = q @ k.transpose(0, 2, 1)
        weights += np.where(self.hidden, q.dtype.type(-1e9), p["near"])
        weights[opening, :, :STRIDE] = -1e9
        sums = self._exp(weights.reshape(-1, 2 * STRIDE))
        return weights, sums.reshape(-1, STRIDE, 1), q, k

    def states(self, x, weights, sums):
        """States at the scored positions, one row each with a last column of ones, and what was attended, and values."""
        v = self.p["v"].take(x, 0)
        attended = weights @ v
        attended /= sums
        # tanh by way of exp, which takes less time; the limits keep it finite
        tanh = attended + self.p["r"].take(x[:, STRIDE:], 0)
        np.clip(tanh, -20, 20, out=tanh)
        tanh *= 2
        np.exp(tanh, out=tanh)
        tanh += 1
        np.divide(-2, tanh, out=tanh)
        tanh += 1
        state = np.ones((tanh.size // WIDTH, WIDTH + 1), tanh.dtype)
        state[:, :WIDTH] = tanh.reshape(-1, WIDTH)
        return state, attended, v

    def _outputs(self):
        """Weights of the first choice and of the members, the constants as their last rows."""
        p = self.p
        return np.concatenate([p["w"], p["b"][None]]), np.concatenate([p["u"], p["c"][:, None]], axis=1)

    def _by_group(self, target):
        """Outcome of the first choice for every target; places of targets in groups, by group, its edges and the members."""
        single = self.groups * self.members
        outcome = np.where(target < single, target // self.members, target - single + self.groups)
        order = np.argsort(outcome.astype(np.int16), kind="stable")
        edges = np.searchsorted(outcome[order], np.arange(self.groups + 1))
        places = order[: edges[-1]]
        edges = [(g, slice(a, b)) for g, (a, b) in enumerate(pairwise(edges.tolist())) if a < b]
        return outcome, places, edges, target[places] - outcome[places] * self.members

    def _members(self, own, u, edges):
        """Scores of the members at states ``own``, which are sorted by group."""
        scores = np.empty((len(own), self.members), own.dtype)
        for g, at in edges:
            np.matmul(own[at], u[g], out=scores[at])
        return scores

    @staticmethod
    def _exp(scores, which=None):
        """exp in place; its sum in each row, and with ``which`` the log of its share at one place of each row.

        Rows are shifted only where large numbers ask for it.
        """
        if scores.size and scores.max() > 40:
            scores -= scores.max(-1, keepdims=True)
        chosen = 0 if which is None else scores[np.arange(len(which)), which]
        np.exp(scores, out=scores)
        sums = np.maximum(scores @ np.ones(scores.shape[-1], scores.dtype), scores.dtype.type(1e-30))
        return sums if which is None else (sums, chosen - np.log(sums))

    def _lean(self, scores, which, counts) -> float:
        """Puts the gradient of the loss in place of the scores; ``counts`` are the weights of the rows."""
        sums, logs = self._exp(scores, which)
        scores *= (counts / sums)[:, None]
        scores[np.arange(len(which)), which] -= counts
        return -float(counts @ logs)

    def log10(self, x, opening, target):
        """log10 probability of the target class at every scored position."""
        state, (w, u) = self.states(x, *self.weights(x, opening)[:2])[0], self._outputs()
        outcome, places, edges, member = self._by_group(target.ravel())
        logs = self._exp(state @ w, outcome)[1]
        logs[places] += self._exp(self._members(state.take(places, 0), u, edges), member)[1]
        return (logs / logs.dtype.type(math.log(10))).reshape(target.shape)

    def gradient(self, x, opening, target, inside):
        """Mean loss over the positions that count (``inside``) and its gradient."""
        weights, sums, q, k = self.weights(x, opening)
        state, attended, v = self.states(x, weights, sums)
        w, u = self._outputs()
        outcome, places, edges, member = self._by_group(target.ravel())
        counts = inside.ravel().astype(state.dtype) / state.dtype.type(max(1, int(inside.sum())))
        prob = state @ w
        loss = self._lean(prob, outcome, counts)
        dw, dh = state.T @ prob, prob @ w[:WIDTH].T
        own = state.take(places, 0)
        scores = self._members(own, u, edges)
        loss += self._lean(scores, member, counts[places])
        du, inner = np.zeros_like(u), np.empty((len(places), WIDTH), state.dtype)
        for g, at in edges:
            np.matmul(own[at].T, scores[at], out=du[g])
            np.matmul(scores[at], u[g, :WIDTH].T, out=inner[at])
        dh[places] += inner
        h = state[:, :WIDTH]
        dh *= 1 - h * h
        ds = dh.reshape(attended.shape)
        shared = ds / sums
        lean = shared @ v.transpose(0, 2, 1)
        lean -= np.einsum("bij,bij->bi", shared, attended)[:, :, None]
        lean *= weights
        g = {"w": dw[:WIDTH], "b": dw[WIDTH], "u": du[:, :WIDTH], "c": du[:, WIDTH], "near": lean.sum(0)}
        size = len(self.p["q"])
        g["q"], g["r"] = _by_row(x[:, STRIDE:], [lean @ k, ds], size)
        g["q"] *= state.dtype.type(1 / math.sqrt(WIDTH))
        g["k"], g["v"] = _by_row(x, [lean.transpose(0, 2, 1) @ q, weights.transpose(0, 2, 1) @ shared], size)
        return loss, g


def windows(sequences: list[np.ndarray], start: int):
    """Inputs, opening marks, targets, counting positions and owners of the windows of class sequences."""
    sizes = np.array([len(s) for s in sequences])
    per = -(-sizes // STRIDE)
    owner = np.repeat(np.arange(len(sequences)), per)
    padded = np.zeros(int(per.sum()) * STRIDE, np.int64)
    first = np.concatenate([[0], np.cumsum(per)[:-1]]) * STRIDE
    place = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(int(sizes.sum()))
    padded[place] = np.concatenate(sequences) if len(sequences) else []
    inside = np.zeros(len(padded), bool)
    inside[place] = True
    before = np.concatenate([[start], padded[:-1]])
    before[first] = start
    now = before.reshape(-1, STRIDE)
    opening = np.zeros(len(owner), bool)
    opening[first // STRIDE] = True
    past = np.concatenate([now[:1], now[:-1]])
    return np.concatenate([past, now], axis=1), opening, padded.reshape(-1, STRIDE), inside.reshape(-1, STRIDE), owner


class TextModel:
    """All that scores a text: the tokenizer's file, the vocabulary and the attention."""

    def __init__(self, path: str, vocabulary: Vocabulary):
        self.path, self.vocabulary = path, vocabulary
        self.attention = Attention()
        #: Windows that the training has read.
        self.read = 0

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, float]:
        """Classes of a text's subwords and the sum of their log10 probabilities inside the classes."""
        classes, _, inside = self.encode_all(words, np.arange(len(words)), np.array([len(words)]))
        return classes, float(inside[0])

    def encode_all(self, words: list[bytes], index: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``encode`` of texts with ``n`` words each, which are ``words`` at ``index``.

        The classes lie one text behind the other, and come with their numbers in each text.
        """
        end = np.array([len(self.vocabulary.of) - 1], "<u4").tobytes()
        packed = [*packed_ids(self.path, words), end]
        ids = np.frombuffer(b"".join(packed), "<u4")
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        first = np.cumsum(sizes) - sizes
        inside = np.add.reduceat(self.vocabulary.inside[ids], first)
        # behind its words each text has the end
        ends = np.cumsum(n + 1) - 1
        which = np.full(len(index) + len(n), len(words))
        which[np.delete(np.arange(len(which)), ends)] = index
        own = sizes[which]
        behind = np.cumsum(own)
        place = np.repeat(first[which] - (behind - own), own)
        place += np.arange(len(place))
        totals = np.bincount(np.repeat(np.arange(len(n)), n + 1), inside[which], len(n))
        return self.vocabulary.of.astype("<i2")[ids][place], np.diff(behind[ends], prepend=0), totals

    def score(self, sequences: list[np.ndarray]) -> np.ndarray:
        """log10 probability of class sequences."""
        total = np.zeros(len(sequences))
        x, opening, target, inside, owner = windows(sequences, self.vocabulary.classes)
        for a in range(0, len(x), BATCH):
            b = slice(a, a + BATCH)
            np.add.at(total, owner[b], (self.attention.log10(x[b], opening[b], target[b]) * inside[b]).sum(1))
        return total

    def windows(self, sequences: list[np.ndarray]):
        """Inputs, opening marks, targets and counting positions of class sequences, in small types."""
        x, opening, target, inside, _ = windows(sequences, self.vocabulary.classes)
        return x.astype(np.int16), opening, target.astype(np.int16), inside

    def train(self, parts, rate: float) -> int:
        """Adam steps over all windows in ``parts``, again from the first if these make fewer than ``LEAST_STEPS``."""
        x, opening, target, inside = (np.concatenate(p) for p in zip(*parts, strict=True))
        model, rng, order = self.attention, np.random.default_rng(len(x)), np.zeros(0, int)
        flat = model.flat().astype(np.float32)
        # the parameters are views of one vector, so a step on it moves them all
        model.load(flat)
        mean, square = np.zeros_like(flat), np.zeros_like(flat)
        for n in range(1, max(LEAST_STEPS, -(-len(x) // TOGETHER)) + 1):
            while len(order) < min(TOGETHER, len(x)):
                order = np.concatenate([order, rng.permutation(len(x))])
            take, order = order[:TOGETHER], order[TOGETHER:]
            _, grads = model.gradient(x[take].astype(np.int64), opening[take], target[take].astype(np.int64), inside[take])
            grad = np.concatenate([grads[name].ravel() for name in model.p])
            mean *= 0.9
            mean += 0.1 * grad
            grad *= grad
            grad *= 0.01
            square *= 0.99
            square += grad
            # both are divided by what their weights add up to
            scale = math.sqrt(1 - 0.99**n)
            root = np.sqrt(square, out=grad)
            root += 1e-8 * scale
            move = np.divide(mean, root, out=root)
            move *= rate * scale / (1 - 0.9**n)
            flat -= move
        return len(x)


def word_counts(train: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``n`` over all texts of ``train``."""

    def count(batches):
        seen: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for batch in tokens.slices(batches):
            words, index, _ = distinct_words(batch.column("text"))
            for word, n in zip(words.to_pylist(), np.bincount(index, minlength=len(words)).tolist(), strict=True):
                seen[word] += n
            if len(seen) > COUNTED:
                yield rows()
                seen.clear()
        yield rows()

    return train.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def subword_counts(counts: DataFrame, path: str, ends: int) -> np.ndarray:
    """Occurrences of every id in the training texts, from the counts of their words; the last is the end id."""
    size = subwords(path).n_vocab + 1

    def count(batches):
        total = np.zeros(size)
        for batch in batches:
            ids, sizes = word_ids(path, batch.column("word").to_pylist())
            total += np.bincount(ids, np.repeat(batch.column("n").to_numpy(), sizes), size)
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some].astype(np.int64))], ["id", "n"])

    total = np.zeros(size, np.int64)
    for row in counts.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        total[row.id] = row.n
    total[size - 1] += ends
    return total


def sequences_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Class sequences of a batch, which are stored as two bytes each."""
    return [np.frombuffer(raw, "<i2") for raw in batch.column("classes").to_pylist()]


def train_rounds(train: DataFrame, model: TextModel, rounds: int = ROUNDS, shares: int = SHARES) -> TextModel:
    """Rounds of local steps in every task and averaging; each reads other shares, and together they read all rows.

    ``train`` has the columns ``share`` (below ``shares``) and ``classes``.
    """
    for step in range(rounds):
        flat, rate = model.attention.flat(), RATE * (1 - step / rounds)

        def learn(batches, flat=flat, rate=rate):
            own = TextModel(model.path, model.vocabulary)
            own.attention.load(flat)
            parts = [own.windows(sequences_of(batch)) for batch in tokens.slices(batches)]
            if parts:
                seen = own.train(parts, rate)
                weighted = pa.array([(own.attention.flat() * seen).tolist()], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([weighted, pa.array([float(seen)])], ["values", "weight"])

        own_share = F.col("share") % rounds == step % shares
        updates = train.filter(own_share).select("classes").mapInArrow(learn, "values array<double>, weight double")
        updates = cut_lineage(updates.withColumn("bucket", F.pmod(F.spark_partition_id(), F.lit(64))))
        if updates.isEmpty():
            continue
        # first within buckets of tasks, then over these
        rows = updates.select(array_to_vector("values").alias("v"), "weight", "bucket")
        sums = Summarizer.sum(F.col("v")).alias("v"), F.sum("weight").alias("weight")
        total = rows.groupBy("bucket").agg(*sums).agg(*sums).first()
        model.attention.load(total.v.toArray() / total.weight)
        model.read += int(total.weight)
    return model


def score_documents(docs: DataFrame, tokenizer: str, rounds: int = ROUNDS, shares: int = SHARES, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Learns from rows that are not held out. A null text has no words and scores its end alone;
    repeated rows count each time; other columns are not read. Without training rows the baseline
    knows nothing (N = V = 0) and the model is not trained.
    """
    share = F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(shares)).cast("int")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    docs = docs.select("doc_id", "text", (remainder() == 2).alias("held_out"), share.alias("share"))
    train = docs.filter(~F.col("held_out"))
    counts = cut_lineage(word_counts(train))
    ends = train.count()
    size = counts.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    n, v = (size.n or 0) + ends, size.v + (ends > 0)
    log_all = math.log10(n + 1 * (v + 1))
    model = TextModel(tokenizer, Vocabulary(subword_counts(counts, tokenizer, ends)))
    top = tokens.most_frequent(counts.filter(F.length("word") <= WORD_BYTES), "n", frequent).select("word", "n").toArrow()
    table = dict(zip(top["word"].to_pylist(), np.log10(top["n"].to_numpy() + 1).tolist(), strict=True))
    context = docs.sparkSession.sparkContext
    sent_model, sent_table = context.broadcast(model), context.broadcast(table)
    names = ["row", "doc_id", "held_out", "share", "n_tokens", "known", "logs", "rare", "within", "classes"]

    def encode(batches):
        own, common, row = sent_model.value, sent_table.value.get, TaskContext.get().partitionId() << 40
        for batch in tokens.slices(batches):
            distinct, index, n = distinct_words(batch.column("text"))
            words, texts = distinct.to_pylist(), len(n)
            found = np.fromiter(map(common, words, repeat(0.0)), float, len(words))[index]
            text = np.repeat(np.arange(texts), n)
            known = np.bincount(text, found > 0, texts).astype(np.int64)
            rare = np.append(0, np.cumsum(n - known)).astype(np.int32)
            classes, sizes, within = own.encode_all(words, index, n)
            bounds = np.append(0, 2 * np.cumsum(sizes)).astype(np.int32)
            rows = np.arange(row, row + texts)
            row += texts
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows), *(batch.column(c) for c in ("doc_id", "held_out", "share")),
                    pa.array(n + 1, pa.int64()), pa.array(known),
                    pa.array(np.bincount(text, found, texts), pa.float64()),
                    pa.ListArray.from_arrays(pa.array(rare), distinct.take(pa.array(index[found == 0]))),
                    pa.array(within, pa.float64()),
                    pa.Array.from_buffers(pa.binary(), texts, [None, pa.py_buffer(bounds), pa.py_buffer(classes)]),
                ],
                names,
            )

    schema = (
        "row long, doc_id long, held_out boolean, share int, n_tokens long, known long, logs double, "
        "rare array<binary>, within double, classes binary"
    )
    # each text is cut into subwords once; training and scoring read the classes
    encoded = cut_lineage(docs.mapInArrow(encode, schema))
    train_rounds(encoded.filter(~F.col("held_out")), model, rounds, shares)
    trained = context.broadcast(model)
    kept = ["row", "doc_id", "held_out", "n_tokens", "known", "logs"]

    def score(batches):
        for batch in tokens.slices(batches):
            total = batch.column("within").to_numpy() + trained.value.score(sequences_of(batch))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(total)], [*kept, "score"])

    schema = "row long, doc_id long, held_out boolean, n_tokens long, known long, logs double, score double"
    scored = encoded.select(*kept, "within", "classes").mapInArrow(score, schema)
    rare = encoded.select("row", F.explode("rare").alias("word")).join(counts, "word")
    rare = rare.groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("more_logs"))
    end = math.log10(ends + 1)
    return (
        scored.join(rare, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens",
            (F.col("known") + F.coalesce("more", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + F.lit(end) - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
            "score",
        )
    )
