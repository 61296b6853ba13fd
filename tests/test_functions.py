"""Scalar functions and text on worked examples."""

import datetime as dt

from pyspark.sql import functions as F

from tramline.functions import text, timefn
from tramline.functions.geo import haversine
from tramline.operators import corpus


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_service_times(spark):
    r = one(
        spark,
        *[timefn.parse_service_time(F.lit(x)) for x in ("25:10:05", "07:00:00", "7h", "ab:cd:ef")],
        timefn.parse_service_time(F.lit(None).cast("string")),
    )
    assert tuple(r) == (90605, 25200, None, None, None)
    r = one(spark, *[timefn.format_seconds(F.lit(x)) for x in (90605, 59, -61, 360000)])
    assert tuple(r) == ("25:10:05", "00:00:59", "-00:01:01", "100:00:00")


def test_local_time(spark):
    r = one(spark, *[timefn.local_time(F.lit(x)) for x in (1672528800, 1672530600, 1672532400)])
    assert tuple(r) == tuple(dt.datetime(2023, 1, 1, h, m) for h, m in ((0, 20), (0, 50), (1, 20)))


def test_local_time_around_clock_changes(spark):
    spring = [timefn.local_time(F.lit(1679788800 + i * 1800)) for i in range(8)]
    hours = [t.hour for t in one(spark, *spring)]
    assert 2 not in hours
    autumn = [timefn.local_time(F.lit(1698534000 + i * 3600)) for i in range(4)]
    assert [t.hour for t in one(spark, *autumn)] == [1, 2, 2, 3]


def test_session_zone_does_not_matter(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = one(spark, timefn.local_time(F.lit(1672531200)), timefn.epoch_seconds(F.lit("2023-01-01").cast("timestamp_ntz")))
        assert r[0] == dt.datetime(2023, 1, 1, 1) and r[1] == 1672531200
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_weekday_and_haversine(spark):
    r = one(spark, timefn.iso_weekday(F.lit("2024-01-01").cast("date")), timefn.iso_weekday(F.lit("2024-01-07").cast("date")))
    assert tuple(r) == (1, 7)
    assert abs(one(spark, haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)))[0] - 111194.9266) < 1e-3


def test_stop_keys(spark):
    r = one(spark, *[text.first_number(F.lit(x)) for x in ("8579253", "Parent8592050", "8501117:0:1", "none")])
    assert tuple(r) == (8579253, 8592050, 8501117, None)


def test_words(spark):
    assert one(spark, text.words(F.lit("Late? Trams, _wait- at: (Every) Stop!")))[0] == ["late", "trams", "wait", "at", "every", "stop"]
    said = "A slow tram beats two fast ones that never came."
    shown = F.array_join(F.transform(F.split(F.lit(said), " "), text.capitalise_ends), " ")
    assert one(spark, shown)[0] == "A SloW TraM BeatS TwO FasT OneS ThaT NeveR Came."
    lengths = F.transform(text.words(F.lit(said)), F.length)
    values = one(spark, lengths)[0]
    assert len(values) == 10 and sum(values) == sum(len(w) for w in said[:-1].split())


def test_kmers(spark):
    r = one(spark, text.kmers(F.lit("GGATTC"), 4), text.kmers(F.lit("GAT"), 4), text.canonical(F.lit("tgc")))
    assert r[0] == ["ggat", "gatt", "attc"] and r[1] == [] and r[2] == "gca"


def test_vectorize(spark):
    docs = spark.createDataFrame(
        [(1, "red tram blue tram red line"), (2, "Blue bus, red BUS stop!")],
        "doc_id bigint, text string",
    )
    words = "tram red line stop bus blue".split()
    vocab = spark.createDataFrame(list(zip(words, range(6))), "word string, idx bigint")
    vec = {1: [0] * 6, 2: [0] * 6}
    for r in corpus.vectorize(corpus.tokens(docs), vocab).collect():
        vec[r.doc_id][r.idx] = r.n
    assert vec == {1: [2, 2, 1, 0, 0, 1], 2: [0, 1, 0, 1, 2, 1]}


def test_ngrams_with_vocabulary(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a")], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n, r.gram) for r in corpus.ngrams(docs, [2, 3]).collect())
    assert got == [(1, 2, "a b"), (1, 2, "b c"), (1, 3, "a b c")]
    vocab = spark.createDataFrame([("b c",)], "word string")
    assert corpus.ngrams(docs, [2, 3], vocab).count() == 1


def test_publication_year(spark):
    meta = spark.createDataFrame(
        [(1, "1800", "1900"), (2, "1800", "1850"), (3, "1990", None), (4, "1980", "2079")],
        "doc_id bigint, birth_year string, death_year string",
    )
    got = {r.doc_id: r.year for r in corpus.publication_year(meta).collect()}
    assert got == {1: 1850, 2: 1840, 3: 2015, 4: 2015}


def test_vocabulary_is_ranked(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9), ("d", 1)], "word string, n bigint")
    got = sorted((r.idx, r.word) for r in corpus.vocabulary(counts, 3).collect())
    assert got == [(0, "c"), (1, "a"), (2, "b")]
