"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# separators: ASCII punctuation and any Unicode white space
SEPARATORS = r"[\p{Punct}\s\x0B\x1C-\x1F\x{85}\p{Z}]+"

# fixed values: common English function words
STOP_WORDS = """
a about above after again against all am an and any are as at be because been before being below between both but by
can could did do does doing down during each few for from further had has have having he her here hers herself him
himself his how i if in into is it its itself just me more most my myself no nor not now of off on once only or other
our ours ourselves out over own same she should so some such than that the their theirs them themselves then there
these they this those through to too under until up very was we were what when where which while who whom why will
with would you your yours yourself yourselves
""".split()


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_number(text) -> Column:
    """The first run of digits as a number; NULL where there is none."""
    digits = F.regexp_extract(_c(text), "([0-9]+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def words(text) -> Column:
    """Lower-cased words; ASCII punctuation and white space separate them."""
    return F.array_remove(F.split(F.lower(_c(text)), SEPARATORS), "")


def ngrams(tokens, n: int, sep: str = " ") -> Column:
    """Consecutive ``n`` tokens joined by ``sep``; empty when there are fewer."""
    t = _c(tokens)
    starts = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - (n - 1))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.array_join(F.slice(t, i, F.lit(n)), sep))


def kmers(seq, k: int) -> Column:
    s = F.lower(_c(seq))
    starts = F.when(F.length(s) >= k, F.sequence(F.lit(1), F.length(s) - (k - 1))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.substring(s, i, F.lit(k)))


def reverse_complement(seq) -> Column:
    return F.reverse(F.translate(_c(seq), "acgt", "tgca"))


def canonical(seq) -> Column:
    """The smaller of a sequence and its reverse complement."""
    return F.least(_c(seq), reverse_complement(seq))


def capitalise_ends(word) -> Column:
    """First and last letter in upper case."""
    w = _c(word)
    n = F.length(w)
    return F.when(n < 2, F.upper(w)).otherwise(
        F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, F.lit(2), n - 2), F.upper(F.right(w, F.lit(1))))
    )
