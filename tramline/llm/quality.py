"""Quality rules with risk-controlled cutoffs.

Every rule compares one measure of a text with a cutoff. The cutoffs come from labelled
documents in two halves that never mix. The design half lays down a ladder per stratum:
level by level the rules may reject a larger share of its good documents. The holdout half
tests the ladder from its mildest level on: a level is certified if the exact binomial
probability of seeing so few false rejections, were the true rate above ``max_false``, is
at most ``error / strata`` (Bonferroni over strata; inside a stratum the levels are a fixed
sequence, which ends at the first that fails and so needs no further correction). With
probability ``1 - error`` no stratum loses more than ``max_false`` of its good documents.
Of the certified levels the one with the best balance on the design half is used. A stratum
with too few labels to certify anything keeps all that passes the base rules.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import tokens
from tramline.session import cut_lineage

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Measures in [0, 1]; a rule rejects what lies above its cutoff.
MEASURES = ("symbols_per_word", "dup_lines", "repeat_words", "capitals", "exclamations_per_word", "long_words")
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
#: Cutoffs are multiples of 1 / STEPS.
STEPS = 200
#: Shares of the design half's good documents that the rules may reject, level by level.
LADDER = (0.0, 0.001, 0.002, 0.005, 0.01, 0.02)
MAX_FALSE = 0.02
ERROR = 0.05
#: Bad documents that weigh as much as one good document when a certified level is chosen.
GOOD_WEIGHT = 20


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that are found twice or more in the text, the first included."""
    n = len(words)
    if n < 4:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids, size = np.fromiter(map(number.__getitem__, words), np.int64, n), len(number)
    pairs = ids[:-1] * size + ids[1:]
    if size >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, where, count = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    twice = count[where] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : shift + n - 2] |= twice
    return int(covered.sum())


def measure(text: str) -> tuple:
    """The base counts and then the measures of one text."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    duplicates, repeated = len(lines) - len(set(lines)), repeated_words(words)
    letters = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(letters[65:91].sum()), int(letters[97:123].sum())
    per_word = max(1, n)
    return (
        n, word_chars, symbols, duplicates, repeated,
        min(1.0, symbols / per_word), duplicates / max(1, len(lines)), repeated / per_word,
        upper / max(1, upper + lower), min(1.0, text.count("!") / per_word), min(1.0, word_chars / per_word / 40),
    )


def base_failed(n_words, n_repeat_words):
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def _measured(batch: pa.RecordBatch) -> list[np.ndarray]:
    rows = np.array([measure(text) for text in tokens.texts_of(batch)], float).reshape(-1, len(BASE) + len(MEASURES))
    return [rows[:, i].astype(np.int64) for i in range(len(BASE))] + [rows[:, i] for i in range(len(BASE), rows.shape[1])]


def measures(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``doc_id, stratum``, base counts and measures for every row; a null text has no words."""
    schema = "doc_id long, stratum string, " + ", ".join([f"{c} long" for c in BASE] + [f"{c} double" for c in MEASURES])
    names = [field.split()[0] for field in schema.split(", ")]

    def compute(batches):
        for batch in tokens.slices(batches):
            columns = [batch.column("doc_id"), batch.column("stratum"), *map(pa.array, _measured(batch))]
            yield pa.RecordBatch.from_arrays(columns, names)

    named = F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), "text", named.alias("stratum")).mapInArrow(compute, schema)


def binomial_cdf(k: int, n: int, p: float) -> float:
    """Exact P(X <= k) for X of Binomial(n, p)."""
    i = np.arange(k + 1)
    choose = math.lgamma(n + 1) - np.array([math.lgamma(a + 1) + math.lgamma(n - a + 1) for a in i])
    return float(np.exp(choose + i * math.log(p) + (n - i) * math.log1p(-p)).sum().clip(0, 1))


@dataclass
class Cutoffs:
    """Per stratum one cutoff for every measure; a stratum that is not named has none."""

    by_stratum: dict[str, list[float]]

    def rejects(self, strata: list[str], values: list[np.ndarray]) -> np.ndarray:
        none = [math.inf] * len(MEASURES)
        limits = np.array([self.by_stratum.get(s, none) for s in strata]).reshape(-1, len(MEASURES))
        return np.any([np.floor(v * STEPS) / STEPS > limits[:, i] for i, v in enumerate(values)], axis=0)


def _ladder(design, strata) -> dict[str, list[list[float]]]:
    """Cutoffs of every level and measure from histograms ``(stratum, measure, bin) -> good documents``."""
    out = {}
    for s in strata:
        out[s] = []
        for share in LADDER:
            level = []
            for m in range(len(MEASURES)):
                good = np.zeros(STEPS + 1)
                for (_, _, b), n in ((k, n) for k, n in design.items() if k[:2] == (s, m)):
                    good[b] += n
                above = good.sum() - np.cumsum(good)
                level.append(int(np.argmax(above <= share * good.sum())) / STEPS if good.sum() else math.inf)
            out[s].append(level)
    return out


def _levels(ladder):
    """The mildest level that rejects a document; the number of levels where none does."""

    def compute(batches):
        never = [[math.inf] * len(MEASURES)] * len(LADDER)
        for batch in batches:
            limits = np.array([ladder.get(s, never) for s in batch.column("stratum").to_pylist()])
            limits = limits.reshape(-1, len(LADDER), len(MEASURES))
            over = [np.floor(batch.column(c).to_numpy() * STEPS)[:, None] / STEPS > limits[:, :, i] for i, c in enumerate(MEASURES)]
            hit = np.any(over, axis=0)
            level = np.where(hit.any(1), hit.argmax(1), len(LADDER)).astype(np.int32)
            columns = [batch.column(c) for c in ("stratum", "design", "good")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(level)], ["stratum", "design", "good", "level"])

    return compute


def fit_cutoffs(
    measured: DataFrame, labels: DataFrame, max_false: float = MAX_FALSE, error: float = ERROR
) -> Cutoffs:
    """Certified cutoffs from all ``labels`` (``doc_id``, ``quality`` 1 for good, 0 for bad).

    Labels without an id or a quality are left out; of several for a document the best counts.
    Only documents that pass the base rules take part. What reaches the driver are counts by
    stratum, measure and cutoff or level.
    """
    given = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long")).agg(
        (F.max("quality") > 0).alias("good")
    )
    half = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(2))
    known = measured.filter(~base_failed(F.col("n_words"), F.col("n_repeat_words"))).join(given, "doc_id")
    known = cut_lineage(known.withColumn("design", half == 0).select("stratum", "good", "design", *MEASURES))
    bins = F.explode(F.array(*[
        F.struct(F.lit(i).alias("m"), F.floor(F.col(c) * STEPS).cast("int").alias("bin")) for i, c in enumerate(MEASURES)
    ])).alias("b")
    counted = known.filter("design and good").select("stratum", bins).groupBy("stratum", "b.m", "b.bin").count().collect()
    strata = sorted({r.stratum for r in known.filter("good").select("stratum").distinct().collect()})
    ladder = _ladder({(r.stratum, r.m, r.bin): r["count"] for r in counted}, strata)
    seen = known.mapInArrow(_levels(ladder), "stratum string, design boolean, good boolean, level int")
    seen = seen.groupBy("stratum", "design", "good", "level").count().collect()
    tally = np.zeros((len(strata), 2, 2, len(LADDER) + 1), int)
    for r in seen:
        if r.stratum in strata:
            tally[strata.index(r.stratum), int(r.design), int(r.good), r.level] += r["count"]
    chosen = {}
    for s, name in enumerate(strata):
        rejected, certified = np.cumsum(tally[s], axis=-1), []
        n = int(rejected[0, 1, -1])
        for level in range(len(LADDER)):
            if not n or binomial_cdf(int(rejected[0, 1, level]), n, max_false) > error / len(strata):
                break
            certified.append(level)
        if certified:
            best = max(certified, key=lambda v: (rejected[1, 0, v] - GOOD_WEIGHT * rejected[1, 1, v], -v))
            chosen[name] = ladder[name][best]
    return Cutoffs(chosen)


def verdicts(measured: DataFrame, cutoffs: Cutoffs) -> DataFrame:
    """``doc_id``, base counts, ``base_failed`` and ``kept`` of measured rows."""
    names = ["doc_id", *BASE, "base_failed", "kept"]

    def judge(batches):
        for batch in batches:
            base = {c: batch.column(c).to_numpy() for c in BASE}
            failed = base_failed(base["n_words"], base["n_repeat_words"])
            values = [batch.column(c).to_numpy() for c in MEASURES]
            rejected = cutoffs.rejects(batch.column("stratum").to_pylist(), values)
            columns = [batch.column("doc_id"), *(batch.column(c) for c in BASE), pa.array(failed), pa.array(~failed & ~rejected)]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, kept boolean"
    return measured.mapInArrow(judge, schema)


def quality_verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """One verdict per row of ``docs``. Rows without an id are judged like all others."""
    measured = cut_lineage(measures(docs, stratum))
    return verdicts(measured, fit_cutoffs(measured, labels))


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the certified cutoffs, all columns as they are."""
    cutoffs = fit_cutoffs(cut_lineage(measures(docs, stratum)), labels)

    def keep(batches):
        for batch in tokens.slices(batches):
            values = _measured(batch)
            failed = base_failed(values[0], values[BASE.index("n_repeat_words")])
            strata = ["" if s is None else str(s) for s in batch.column(stratum).to_pylist()]
            yield batch.filter(pa.array(~failed & ~cutoffs.rejects(strata, values[len(BASE) :])))

    return docs.mapInArrow(keep, docs.schema)
