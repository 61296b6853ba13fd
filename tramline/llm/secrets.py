"""Secret scans: three fixed forms, and a battery of randomness tests for all other strings.

All of it is DataFrame expressions. The fixed forms (assignments, access keys, hex strings)
are found by their patterns. Every other run of at least ``SHORTEST`` characters of a base-64
alphabet with a digit in it is a candidate: its encoding (base 16, 32, 36 or 64) is inferred
from the characters it uses, and three tests are run on it.

* The chi-squared statistic of its characters against the uniform distribution over the
  encoding's alphabet. Strings that people write use their alphabet unevenly, by an excess that
  grows with the length (``EXCESS`` per character); the probability that such a string looks
  as even as this one is the candidate's p-value.
* The runs test of the characters in the upper and lower half of the alphabet and the serial
  correlation of neighbours, both of which a random string must not fail (``SERIAL_Z``).

A candidate is a secret if the Benjamini-Hochberg procedure over all candidates of its length
class in the corpus discovers it at rate ``RATE``. p-values are rounded up to steps of a
logarithmic scale, so counts per class and step are all that the procedure needs.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.session import cut_lineage

# fixed values of the forms: order, pattern and least length
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGNED_CHARS = 6
# a match of 20 or 24 characters is the same run that the pattern without a bound finds
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

SHORTEST = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Encodings in the order in which they are tried: expression of the strings, alphabet.
ENCODINGS = (
    (r"^[0-9a-f]+$", DIGITS + LOWER[:6]),
    (r"^[0-9A-F]+$", DIGITS + UPPER[:6]),
    (r"^[A-Z2-7]+=*$", UPPER + "234567"),
    (r"^[a-z0-9]+$", LOWER + DIGITS),
    (r"^[A-Za-z0-9_-]+=*$", UPPER + LOWER + DIGITS + "-_"),
    (r"", UPPER + LOWER + DIGITS + "+/"),
)
#: Relative excess of the squared frequencies of written strings, by size of the alphabet.
EXCESS = {16: 1.0, 32: 1.0, 36: 1.4, 64: 2.5}
SERIAL_Z = 3.3
RATE = 0.01
#: Lower ends of the length classes, and steps of the p-values per factor of two.
LENGTHS = (20, 28, 40, 64, 128)
STEPS = 8
LEAST_P = 1e-12
MASK = "[SECRET]"

SPAN = "array<struct<start:int,end:int,string:string>>"


def _found(text: Column, pattern: str) -> tuple[Column, Column]:
    """All matches, and what stands between them where there are any."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return matches, F.when(matches[0].isNotNull(), F.split(text, pattern, -1))


def _places(matches: Column, gaps: Column) -> Column:
    """Start, end (code points) and string of the matches."""

    def add(done: Column, i: Column) -> Column:
        start = done["at"] + F.length(F.element_at(gaps, i))
        match = F.element_at(matches, i)
        end = start + F.length(match)
        one = F.struct(start.alias("start"), end.alias("end"), match.alias("string"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(one)).alias("out"))

    none = F.array().cast(SPAN)
    begin = F.struct(F.lit(0).alias("at"), none.alias("out"))
    numbers = F.sequence(F.lit(1), F.size(matches))
    return F.when(F.size(matches) > 0, F.aggregate(numbers, begin, add, lambda done: done["out"])).otherwise(none)


def _lower_tail(z: Column) -> Column:
    """P(Z <= z) of the normal distribution for z below 0, else 1/2 (Zelen and Severo's polynomial)."""
    x = -F.least(z, F.lit(0.0))
    t = 1 / (1 + 0.2316419 * x)
    weights = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    polynomial = reduce(lambda total, b: (total + b) * t, reversed(weights), F.lit(0.0))
    return F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * polynomial


def _count(string: Column, part: str | Column, size: int = 1) -> Column:
    return (F.length(string) - F.length(F.replace(string, F.lit(part) if isinstance(part, str) else part, F.lit("")))) / size


def _p_value(string: Column, alphabet: str) -> Column:
    """p-value of a candidate in one encoding; 1 if it fails the runs or serial test."""
    k, half = len(alphabet), len(alphabet) // 2
    string = F.rtrim(F.translate(string, "=", " "))
    n = F.length(string).cast("double")
    squares = F.aggregate(
        F.array(*map(F.lit, alphabet)), F.lit(0.0), lambda total, c: total + F.pow(_count(string, c), F.lit(2.0))
    )
    chi = squares * k / n - n
    excess = EXCESS[k] * n
    p = _lower_tail((chi - (k - 1 + excess)) / F.sqrt(2.0 * (k - 1) + 4 * excess))
    sides = F.translate(string, alphabet, "0" * half + "1" * (k - half))
    ones = _count(sides, "1")
    runs = 1 + _count(sides, "01", 2) + _count(sides, "10", 2)
    mean = 2 * ones * (n - ones) / n
    runs_z = (runs - 1 - mean) / F.sqrt(F.greatest(mean * (mean - 1) / (n - 1), F.lit(1e-9)))
    # neighbours as positions in the alphabet around its middle
    values = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(alphabet), c) - (k + 1) / 2)
    products = F.zip_with(F.slice(values, F.lit(1), F.size(values) - 1), F.slice(values, F.lit(2), F.size(values) - 1), lambda a, b: a * b)
    serial_z = F.aggregate(products, F.lit(0.0), lambda total, x: total + x) / ((k * k - 1) / 12) / F.sqrt(n - 1)
    random = (F.abs(runs_z) <= SERIAL_Z) & (F.abs(serial_z) <= SERIAL_Z)
    return F.when(random, F.least(F.greatest(p, F.lit(LEAST_P)), F.lit(1.0))).otherwise(1.0)


def _step(string: Column) -> Column:
    """The p-value's step: p is at most 2 ** (-step / STEPS)."""
    p = F.lit(1.0)
    for expression, alphabet in reversed(ENCODINGS):
        own = _p_value(string, alphabet)
        p = own if not expression else F.when(string.rlike(expression), own).otherwise(p)
    return F.floor(-F.log2(p) * STEPS).cast("int")


def _length_class(length: Column) -> Column:
    return sum(((length >= low).cast("int") for low in LENGTHS[1:]), F.lit(0))


def _scan(rows: DataFrame) -> DataFrame:
    """Adds ``_base`` (start, kind number, end) and ``_candidates`` to rows with a ``_text``."""
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "other": CANDIDATE}
    found = {k: _found(F.col("_text"), p) for k, p in patterns.items()}
    rows = rows.withColumns({f"_m_{k}": m for k, (m, _) in found.items()})
    rows = rows.withColumns({f"_g_{k}": F.when(F.size(f"_m_{k}") > 0, F.split("_text", p, -1)) for k, p in patterns.items()})
    places = {k: _places(F.col(f"_m_{k}"), F.col(f"_g_{k}")) for k in patterns}
    assigned = F.filter(places["assign"], lambda m: F.length(F.regexp_extract(m["string"], ASSIGN, 2)) >= ASSIGNED_CHARS)

    def span(kind: int):
        return lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))

    base = F.concat(F.transform(assigned, span(1)), F.transform(places["access"], span(2)), F.transform(places["hex"], span(3)))
    rows = rows.withColumns({"_base": F.sort_array(base), "_other": places["other"]})
    free = F.filter(
        F.filter("_other", lambda m: m["string"].rlike("[0-9]")),
        lambda m: ~F.exists("_base", lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])),
    )
    tested = F.transform(
        free,
        lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"),
            _length_class(m["end"] - m["start"]).alias("size"), _step(m["string"]).alias("step"),
        ),
    )
    rows = rows.withColumn("_candidates", tested)
    return rows.drop("_other", *(f"_{x}_{k}" for x in "mg" for k in patterns))


def discovery_steps(candidates: DataFrame, rate: float = RATE) -> dict[int, int]:
    """For each length class the least step that Benjamini and Hochberg's procedure discovers.

    ``candidates`` has ``size`` and ``step``; only counts per class and step come to the driver.
    """
    counted: dict[int, dict[int, int]] = {}
    for row in candidates.groupBy("size", "step").count().collect():
        counted.setdefault(row["size"], {})[row["step"]] = row["count"]
    least = {}
    for size, by_step in counted.items():
        total, above = sum(by_step.values()), 0
        for step in sorted(by_step, reverse=True):
            above += by_step[step]
            if 2 ** (-step / STEPS) * total / above <= rate:
                least[size] = step
    return least


def _all_spans(least: dict[int, int]) -> Column:
    """Base spans and discovered candidates by start, then kind."""
    discovered = F.filter(
        "_candidates",
        lambda c: reduce(lambda hit, k: hit | ((c["size"] == k) & (c["step"] >= least[k])), least, F.lit(False)),
    )
    more = F.transform(discovered, lambda c: F.struct(c["start"].alias("start"), F.lit(4).alias("kind"), c["end"].alias("end")))
    return F.sort_array(F.concat("_base", more))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def find_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row of ``docs``.

    Spans are ``kind:start:end`` in code points, joined by commas. A null text holds none. Rows
    without an id and repeated rows are scanned like others; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("_text"))
    scanned = cut_lineage(_scan(rows).drop("_text"))
    least = discovery_steps(scanned.select(F.explode("_candidates").alias("c")).select("c.*"), rate)

    def number(kind: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")

    return scanned.select(
        "doc_id", number(1).alias("n_assign"), number(2).alias("n_access"), number(3).alias("n_hex"),
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"), _joined(_all_spans(least)).alias("spans"),
    )


def mask_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """``docs`` with every secret replaced by ``MASK``; spans that touch or overlap give one mask.

    All columns stay; ``n_chars``, where there is one, is counted anew for changed texts.
    """
    rows = docs.select(F.struct("*").alias("_row")).withColumn("_text", F.coalesce("_row.text", F.lit("")))
    scanned = _scan(rows)
    least = discovery_steps(scanned.select(F.explode("_candidates").alias("c")).select("c.*"), rate)

    def add(done: Column, s: Column) -> Column:
        fresh = (s["start"] > done["at"]) | (F.length(done["out"]) == 0)
        gap = F.substring(F.col("_text"), done["at"] + 1, s["start"] - done["at"])
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(done["out"], gap, F.lit(MASK))).otherwise(done["out"]).alias("out"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(
        _all_spans(least), begin, add,
        lambda done: F.concat(done["out"], F.substring(F.col("_text"), done["at"] + 1, F.length("_text"))),
    )
    scanned = scanned.withColumn("_spans", _all_spans(least)).withColumn("_new", F.when(F.size("_spans") > 0, rest))
    row = F.col("_row").withField("text", F.coalesce("_new", "_row.text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.coalesce(F.length("_new").cast(kind), F.col("_row.n_chars")))
    return scanned.select(row.alias("_row")).select("_row.*")
