"""Corpus queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline import bindings as B
from tramline.bindings import register_sql
from tramline.functions.text import STOP_WORDS
from tramline.operators import corpus, shaping
from tramline.plans.sources import EXTRA_STOP_WORDS
from tramline.plans.util import bigint, r
from tramline.registry import query
from tramline.session import broadcast_if_small, cut_lineage, spread, table

_ALL_STOP = STOP_WORDS + EXTRA_STOP_WORDS
_SPLIT = (
    "[x FOR x IN regexp_split_to_array(regexp_replace(lower(text), '[[:punct:]\\s\\x0B\\x1C-\\x1F\\x{85}\\pZ]+', ' ', 'g'),"
    " ' ') IF x <> '']"
)
register_sql("word_arrays", f"SELECT doc_id, lang, {_SPLIT} AS w FROM documents")
register_sql(
    "tokens",
    f"""SELECT doc_id, lang, pos, word FROM (SELECT doc_id, lang, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos
        FROM word_arrays) WHERE word NOT IN ({', '.join(f"'{x}'" for x in _ALL_STOP)})""",
)
register_sql(
    "vocab",
    """SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS idx, n FROM (SELECT word, count(*) AS n FROM tokens
       GROUP BY word ORDER BY n DESC, word LIMIT 100000)""",
)
register_sql(
    "vectors",
    "SELECT t.doc_id, v.idx, count(*) AS n FROM tokens t JOIN vocab v USING (word) GROUP BY 1, 2",
)
register_sql(
    "pub_years",
    """SELECT doc_id, CAST(least(CASE WHEN death_year IS NULL THEN b + 40 ELSE greatest((b + d) // 2, b + 40) END, 2015)
       AS BIGINT) AS year FROM (SELECT *, CAST(birth_year AS INTEGER) AS b, CAST(death_year AS INTEGER) AS d FROM meta
       WHERE title IS NOT NULL AND first_name IS NOT NULL AND birth_year IS NOT NULL AND birth_year NOT LIKE '%BC%')""",
)
register_sql(
    "sums_by_year", "SELECT year, idx, CAST(sum(n) AS BIGINT) AS n FROM vectors JOIN pub_years USING (doc_id) GROUP BY 1, 2"
)


def docs(spark, root):
    return spread(table(spark, root, "documents").select("doc_id", "lang", "text"), "doc_id")


def stop_words(spark):
    words = spark.createDataFrame([(w,) for w in _ALL_STOP], "word string")
    return broadcast_if_small(words)


def tokens(spark, root):
    return corpus.tokens(docs(spark, root), stop_words(spark))


@query("text_tokens", "SELECT doc_id, pos, word FROM tokens")
def text_tokens(spark, root):
    t = tokens(spark, root)
    return t.select("doc_id", bigint("pos").alias("pos"), "word")


@query("text_distinct_words", "SELECT lang, count(DISTINCT word) AS words, count(*) AS tokens FROM tokens GROUP BY lang")
def text_distinct_words(spark, root):
    lang = table(spark, root, "documents").select("doc_id", "lang")
    t = tokens(spark, root).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n")).join(lang, "doc_id")
    per = t.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return per.groupBy("lang").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens"))


@query("text_word_count", "SELECT word, count(*) AS n FROM tokens WHERE lang = 'en' GROUP BY word ORDER BY n DESC, word LIMIT 100")
def text_word_count(spark, root):
    english = docs(spark, root).where("lang = 'en'")
    counts = corpus.word_counts(corpus.tokens(english, stop_words(spark)))
    return counts.orderBy(F.desc("n"), "word").limit(100)


def vocab(spark, root):
    return corpus.vocabulary(corpus.word_counts(tokens(spark, root)))


@query("text_vocab", "SELECT word, idx, n FROM vocab")
def text_vocab(spark, root):
    return vocab(spark, root)


@query(
    "text_ngrams",
    """SELECT doc_id, n, count(*) AS grams, count(DISTINCT gram) AS distinct_grams, min(gram) AS first_gram, max(gram)
       AS last_gram FROM (SELECT doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (SELECT doc_id, w, n,
       unnest(range(1, len(w) - n + 2)) AS i FROM word_arrays, (VALUES (1), (2), (3)) v(n))) GROUP BY 1, 2""",
)
def text_ngrams(spark, root):
    """All 1- to 3-grams, summarised per document."""
    return corpus.ngram_profile(docs(spark, root), [1, 2, 3])


def vectors(spark, root):
    """Tokens are read twice (vocabulary and vectors), so they are counted and written once."""
    t = tokens(spark, root).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))
    counts = cut_lineage(t)
    v = cut_lineage(corpus.vocabulary(counts.groupBy("word").agg(F.sum("n").alias("n"))))
    return corpus.match_vocabulary(counts, v)


@query("text_vectorize", "SELECT doc_id, idx, n FROM vectors")
def text_vectorize(spark, root):
    return vectors(spark, root)


def pub_years(spark, root):
    return corpus.publication_year(shaping.usable_metadata(B.meta(spark, root)))


@query("text_pub_year", "SELECT doc_id, year FROM pub_years")
def text_pub_year(spark, root):
    return pub_years(spark, root)


@query("text_year_sums", "SELECT year, idx, n FROM sums_by_year")
def text_year_sums(spark, root):
    return corpus.year_sums(vectors(spark, root), pub_years(spark, root))


_HW = ", ".join(f"({i - 5}, CAST({w:.17g} AS DOUBLE))" for i, w in enumerate(corpus.timeseries.hann_weights(11)))


@query(
    "text_word_trend",
    f"""WITH y AS (SELECT year, sum(n) AS total, row_number() OVER (ORDER BY year) - 1 AS pos FROM sums_by_year GROUP BY year),
        s AS (SELECT y.year, y.pos, i.idx, COALESCE(s.n, 0) AS n, COALESCE(s.n, 0) / CAST(y.total AS DOUBLE) AS share,
              COALESCE(s.n, 0) / nullif(CAST(y.total - COALESCE(s.n, 0) AS DOUBLE), 0) AS odds
              FROM y CROSS JOIN (VALUES (0), (1), (2)) i(idx) LEFT JOIN sums_by_year s ON s.year = y.year AND s.idx = i.idx),
        e AS (SELECT idx, max(pos) AS last, arg_min(odds, pos) AS x0, arg_max(odds, pos) AS xn FROM s GROUP BY 1),
        p AS (SELECT idx, pos, odds AS x FROM s UNION ALL
              SELECT s.idx, -pos - 1, 2 * x0 - odds FROM s JOIN e ON e.idx = s.idx WHERE pos < 5 UNION ALL
              SELECT s.idx, 2 * last + 1 - pos, 2 * xn - odds FROM s JOIN e ON e.idx = s.idx WHERE last - pos < 5)
        SELECT s.year, s.idx, s.n, round(any_value(s.share), 9) AS share, round(any_value(s.odds), 9) AS odds,
        round(sum(w.w * p.x), 9) AS smoothed FROM s CROSS JOIN (VALUES {_HW}) w(o, w)
        JOIN p ON p.idx = s.idx AND p.pos = s.pos + w.o GROUP BY s.year, s.idx, s.n""",
)
def text_word_trend(spark, root):
    sums = cut_lineage(corpus.year_sums(vectors(spark, root), pub_years(spark, root)))
    t = corpus.word_trend(sums, [0, 1, 2])
    return t.select("year", "idx", "n", *[r(c, 9).alias(c) for c in ("share", "odds", "smoothed")])


@query(
    "text_top_authors",
    """SELECT last_name || ', ' || first_name AS author, count(*) AS books FROM meta WHERE title IS NOT NULL AND first_name
       IS NOT NULL AND birth_year IS NOT NULL AND birth_year NOT LIKE '%BC%' GROUP BY 1 ORDER BY books DESC, author LIMIT 20""",
)
def text_top_authors(spark, root):
    m = shaping.usable_metadata(B.meta(spark, root))
    counts = m.groupBy(corpus.author().alias("author")).agg(F.count(F.lit(1)).alias("books"))
    return counts.orderBy(F.desc("books"), "author").limit(20)


@query("text_lang_counts", "SELECT language, count(*) AS books FROM meta GROUP BY 1 ORDER BY books DESC, language LIMIT 20")
def text_lang_counts(spark, root):
    counts = B.meta(spark, root).groupBy("language").agg(F.count(F.lit(1)).alias("books"))
    return counts.orderBy(F.desc("books"), "language").limit(20)


@query(
    "text_kmers",
    """SELECT seq_id, kmer, count(*) AS n, round(count(*) / CAST(any_value(total) AS DOUBLE), 6) AS freq,
       kmer < reverse(translate(kmer, 'acgt', 'tgca')) AS in_vocab FROM (
       SELECT seq_id, total, least(k, reverse(translate(k, 'acgt', 'tgca'))) AS kmer FROM (
       SELECT seq_id, length(sequence) - 3 AS total, substr(sequence, CAST(i AS INTEGER), 4) AS k FROM (
       SELECT seq_id, sequence, unnest(range(1, length(sequence) - 2)) AS i FROM seqs))) GROUP BY 1, 2""",
)
def text_kmers(spark, root):
    return corpus.kmer_frequencies(B.seqs(spark, root), 4).withColumn("freq", r("freq"))
