"""Language identification by a bidirectional gated recurrent network over bytes.

The bytes of a whole text are read in windows of ``WINDOW`` bytes, forwards and backwards.
Every position gets a probability for each language from both states; a document's
probabilities are the mean over its positions. The network is trained in numpy by
backpropagation through time on a bounded sample of labelled windows (``SAMPLE_DOCS``
documents spread evenly over the languages, ``SAMPLE_WINDOWS`` windows spread evenly over
each). Prediction is one pass over the corpus without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm import tokens

WINDOW = 48
HIDDEN = 8
#: Windows that go through the network together.
BATCH = 4096
SAMPLE_DOCS = 2400
SAMPLE_WINDOWS = 8
STEPS = 500
TRAINED_TOGETHER = 256
RATE = 0.02
UNDETERMINED = "und"


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class ByteGru:
    """Parameters: per direction a table of gate inputs by byte and the recurrent weights; the output."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        shapes = {"xf": (256, 3 * hidden), "uf": (hidden, 3 * hidden), "xb": (256, 3 * hidden), "ub": (hidden, 3 * hidden)}
        self.p = {k: (rng.standard_normal(s) * 0.3).astype(np.float32) for k, s in shapes.items()}
        self.p["w"] = (rng.standard_normal((2 * hidden, len(languages))) * 0.3).astype(np.float32)
        self.p["b"] = np.zeros(len(languages), np.float32)

    def _states(self, x, table, recurrent, keep):
        """States after each step of ``x`` (steps, windows); with ``keep`` also what the gradient needs."""
        n = self.hidden
        states, kept = np.empty((*x.shape, n), table.dtype), []
        h = np.zeros((x.shape[1], n), table.dtype)
        for t in range(len(x)):
            own, past = table[x[t]], h @ recurrent
            gates = _sigmoid(own[:, : 2 * n] + past[:, : 2 * n])
            z, r, c = gates[:, :n], gates[:, n:], past[:, 2 * n :]
            new = np.tanh(own[:, 2 * n :] + r * c)
            if keep:
                kept.append((h, z, r, c, new))
            h = new + z * (h - new)
            states[t] = h
        return states, kept

    def probabilities(self, x, keep=False):
        """Of every position: (steps, windows, languages)."""
        forward, kept_f = self._states(x, self.p["xf"], self.p["uf"], keep)
        backward, kept_b = self._states(x[::-1], self.p["xb"], self.p["ub"], keep)
        both = np.concatenate([forward, backward[::-1]], axis=2)
        scores = both @ self.p["w"] + self.p["b"]
        scores = np.exp(scores - scores.max(2, keepdims=True))
        return scores / scores.sum(2, keepdims=True), both, kept_f, kept_b

    def gradient(self, x, labels):
        """Mean loss over the positions of windows (steps, windows) of one label each, and its gradient."""
        p, both, kept_f, kept_b = self.probabilities(x, True)
        count, n = x.size, self.hidden
        loss = -float(np.log(p[:, np.arange(x.shape[1]), labels] + 1e-12).mean())
        error = p.copy()
        error[:, np.arange(x.shape[1]), labels] -= 1
        error /= count
        grad = {"w": np.tensordot(both, error, ([0, 1], [0, 1])), "b": error.sum((0, 1))}
        back = error @ self.p["w"].T
        grad["xf"], grad["uf"] = self._through_time(x, back[:, :, :n], kept_f, self.p["uf"])
        grad["xb"], grad["ub"] = self._through_time(x[::-1], back[::-1, :, n:], kept_b, self.p["ub"])
        return loss, grad

    def _through_time(self, x, error, kept, recurrent):
        n = self.hidden
        inputs, weights = np.empty((*x.shape, 3 * n), error.dtype), np.zeros_like(recurrent)
        dh = np.zeros_like(error[0])
        for t in reversed(range(len(x))):
            h, z, r, c, new = kept[t]
            dh = dh + error[t]
            dn = dh * (1 - z) * (1 - new * new)
            dz = dh * (h - new) * z * (1 - z)
            dr = dn * c * r * (1 - r)
            inputs[t] = np.concatenate([dz, dr, dn], axis=1)
            past = np.concatenate([dz, dr, dn * r], axis=1)
            weights += h.T @ past
            dh = dh * z + past @ recurrent.T
        flat = inputs.reshape(-1, 3 * n)
        table = np.stack([np.bincount(x.ravel(), flat[:, i], 256) for i in range(3 * n)], axis=1)
        return table.astype(recurrent.dtype), weights

    def train(self, windows, labels, steps=STEPS, rate=RATE, seed=1):
        """Adam over random batches of ``windows`` (count, bytes)."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            take = rng.integers(0, len(windows), TRAINED_TOGETHER)
            _, grad = self.gradient(windows[take].T, labels[take])
            pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.p[k] -= (pace * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over all positions of each text; zeros for an empty one."""
        sizes = np.array([-(-len(t) // WINDOW) for t in texts])
        owner = np.repeat(np.arange(len(texts)), sizes)
        raw = b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, sizes.tolist(), strict=True))
        windows = np.frombuffer(raw, np.uint8).reshape(-1, WINDOW)
        filled = np.full(len(windows), WINDOW)
        some = sizes > 0
        filled[np.cumsum(sizes)[some] - 1] = np.array([len(t) for t in texts])[some] - (sizes[some] - 1) * WINDOW
        total = np.zeros((len(texts), len(self.languages)))
        for start in range(0, len(windows), BATCH):
            p = self.probabilities(np.ascontiguousarray(windows[start : start + BATCH].T))[0]
            inside = np.arange(WINDOW)[:, None] < filled[start : start + BATCH][None, :]
            np.add.at(total, owner[start : start + BATCH], np.einsum("twl,tw->wl", p, inside.astype(np.float32)))
        return total / np.maximum(1, [len(t) for t in texts])[:, None]


def held_out() -> Column:
    """Documents that take no part in learning; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _windows(batches):
    for batch in tokens.slices(batches):
        langs, parts = [], []
        for text, lang in zip(tokens.texts_of(batch), batch.column("lang").to_pylist(), strict=True):
            raw = text.encode()
            starts = np.linspace(0, max(0, len(raw) - WINDOW), SAMPLE_WINDOWS).astype(int).tolist()
            for start in dict.fromkeys(starts):
                parts.append(raw[start : start + WINDOW].ljust(WINDOW, b"\0"))
                langs.append(lang)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(parts, pa.binary())], ["lang", "part"])


def train_model(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, steps: int = STEPS) -> ByteGru | None:
    """A network for the languages of the documents that are not held out; none without such rows.

    The driver receives about ``sample_docs`` times ``SAMPLE_WINDOWS`` windows, however large
    the table is: of each language an equal number of documents, chosen by a hash.
    """
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample_docs / len(counts) / n))])
    place = F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 20)) / float(1 << 20)
    rows = known.filter(place < share[F.col("lang")]).select("text", "lang").mapInArrow(_windows, "lang string, part binary").collect()
    rows = sorted((r.lang, bytes(r.part)) for r in rows)
    languages = sorted(counts)
    number = {lang: i for i, lang in enumerate(languages)}
    windows = np.frombuffer(b"".join(part for _, part in rows), np.uint8).reshape(-1, WINDOW)
    labels = np.array([number[lang] for lang, _ in rows])
    # languages of few or short texts count as much as others
    order = np.concatenate([np.resize(np.nonzero(labels == i)[0], len(rows) // len(languages) + 1) for i in set(labels.tolist())])
    return ByteGru(languages).train(windows[order], labels[order], steps) if len(rows) else None


def predict(docs: DataFrame, model: ByteGru | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, from its whole text alone.

    A null text, one without a letter, and every text if nothing was learned is ``und`` with
    score 0. Repeated rows and missing ids are treated like others; other columns are not read.
    """

    def label(batches):
        for batch in tokens.slices(batches):
            texts = tokens.texts_of(batch)
            lettered = np.array([model is not None and any(map(str.isalpha, t)) for t in texts], bool)
            langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            own = np.nonzero(lettered)[0].tolist()
            if own:
                p = model.documents([texts[i].encode() for i in own])
                for i, row in zip(own, p, strict=True):
                    langs[i], scores[i] = model.languages[int(row.argmax())], min(1.0, float(row.max()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(label, "doc_id long, held_out boolean, lang_pred string, score double")


def identify_languages(docs: DataFrame) -> DataFrame:
    """Train on the documents that are not held out and predict all."""
    rows = docs.select("doc_id", "text", "lang")
    return predict(rows, train_model(rows))
