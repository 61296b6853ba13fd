"""Corpus statistics: tokens, vocabulary, vectors, n-grams, k-mers, word use by year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions import text
from tramline.operators import timeseries
from tramline.operators.shaping import dense_index
from tramline.session import broadcast_if_small

VOCABULARY = 100_000


def tokens(docs: DataFrame, stop_words: DataFrame | None = None) -> DataFrame:
    """(doc_id, pos, word) of whole texts, stop words removed after numbering."""
    rows = docs.select("doc_id", F.posexplode(text.words("text")).alias("pos", "word"))
    return rows if stop_words is None else rows.join(stop_words, "word", "left_anti").select("doc_id", "pos", "word")


def word_counts(words: DataFrame) -> DataFrame:
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(counts: DataFrame, size: int = VOCABULARY) -> DataFrame:
    """The ``size`` most frequent words with their rank from 0; ties in word order."""
    top = counts.orderBy(F.desc("n"), "word").limit(size)
    ranked = dense_index(top.withColumn("_neg", -F.col("n")), ["_neg", "word"], "idx")
    return ranked.select("word", "idx", "n")


def vectorize(words: DataFrame, vocab: DataFrame) -> DataFrame:
    """Bag of words in long form: (doc_id, idx, n).

    Words are counted per document before they meet the vocabulary.
    """
    counts = words.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))
    return match_vocabulary(counts, vocab)


def match_vocabulary(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """(doc_id, word, n) -> (doc_id, idx, n); a vocabulary of counted size is broadcast, so
    frequent words do not become hot shuffle keys."""
    words = broadcast_if_small(vocab.select("word", "idx"))
    return counts.join(words, "word").select("doc_id", "idx", "n")


def ngrams(docs: DataFrame, sizes: list[int], vocab: DataFrame | None = None) -> DataFrame:
    """(doc_id, n, gram) for every run of ``n`` words, n from ``sizes``."""
    w = docs.select("doc_id", text.words("text").alias("w"))
    each = F.array(*[F.struct(F.lit(n).alias("n"), text.ngrams("w", n).alias("grams")) for n in sizes])
    rows = w.select("doc_id", F.explode(each).alias("e")).select("doc_id", "e.n", F.explode("e.grams").alias("gram"))
    return rows if vocab is None else rows.join(vocab, rows.gram == vocab.word, "left_semi")


def ngram_profile(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """Grams, distinct grams, first and last gram in word order per document and size.

    All grams of a document are in its row, so nothing is shuffled.
    """
    w = docs.select("doc_id", text.words("text").alias("w"))
    each = F.array(*[F.struct(F.lit(n).alias("n"), text.ngrams("w", n).alias("g")) for n in sizes])
    rows = w.select("doc_id", F.explode(each).alias("e")).select("doc_id", "e.n", F.col("e.g").alias("g"))
    return rows.where(F.size("g") > 0).select(
        "doc_id", "n", F.size("g").cast("bigint").alias("grams"),
        F.size(F.array_distinct("g")).cast("bigint").alias("distinct_grams"),
        F.array_min("g").alias("first_gram"), F.array_max("g").alias("last_gram"),
    )


def char_ngrams(df: DataFrame, key: str, column: str, k: int) -> DataFrame:
    return df.select(key, F.explode(text.kmers(column, k)).alias("gram"))


def publication_year(meta: DataFrame, age: int = 40, last: int = 2015) -> DataFrame:
    """max(mid-life, birth + age), or birth + age for the living; not after ``last``."""
    b, d = F.col("birth_year").try_cast("int"), F.col("death_year").try_cast("int")
    year = F.when(d.isNull(), b + age).otherwise(F.greatest(F.floor((b + d) / 2).cast("int"), b + age))
    return meta.select("doc_id", F.least(year, F.lit(last)).cast("bigint").alias("year")).where("year IS NOT NULL")


def year_sums(vectors: DataFrame, years: DataFrame) -> DataFrame:
    """(year, idx, n): partial sums per task, then one shuffle on (year, idx)."""
    return vectors.join(years, "doc_id").groupBy("year", "idx").agg(F.sum("n").alias("n"))


def word_trend(sums: DataFrame, word_idx: list[int], length: int = 11) -> DataFrame:
    """Use of chosen words per year: share, odds, and the smoothed odds.

    Years are few (one row each), so they can be numbered in one task.
    """
    totals = sums.groupBy("year").agg(F.sum("n").alias("total"))
    years = dense_index(totals, ["year"], "pos")
    wanted = years.withColumn("idx", F.explode(F.array(*[F.lit(i).cast("bigint") for i in word_idx])))
    used = sums.where(F.col("idx").isin(word_idx))
    t = wanted.join(used, ["year", "idx"], "left").na.fill({"n": 0})
    t = t.withColumns(
        {"share": F.col("n") / F.col("total"), "odds": F.try_divide(F.col("n"), F.col("total") - F.col("n"))}
    )
    return timeseries.hann_smooth(t, ["idx"], "pos", "odds", "smoothed", length)


def kmer_frequencies(seqs: DataFrame, k: int) -> DataFrame:
    """Canonical k-mers per sequence with count, relative frequency and whether the fixed
    vocabulary (k-mers smaller than their reverse complement) has them."""
    all_kmers = text.kmers(F.trim(F.regexp_replace("sequence", "\t", "")), k)
    rows = seqs.select("seq_id", F.size(all_kmers).alias("total"), F.explode(all_kmers).alias("_k"))
    counted = rows.groupBy("seq_id", "total", text.canonical("_k").alias("kmer")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "seq_id", "kmer", "n", (F.col("n") / F.col("total")).alias("freq"),
        (F.col("kmer") < text.reverse_complement("kmer")).alias("in_vocab"),
    )


def author(last: str = "last_name", first: str = "first_name") -> Column:
    return F.concat_ws(", ", last, first)
