"""Near-duplicates by shingle similarity against brute force."""

import random

import corpus_pipeline
import pytest

from tramline.llm import similar

SCHEMA = "doc_id long, text string"


def shingles(text, k=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_components(rows, similarity):
    label, sets = list(range(len(rows))), [shingles(t) for _, t in rows]

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= similarity:
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(rows))]


def edited(body, edits, new):
    """Words far apart are replaced, each of which changes five shingles."""
    copy, step = list(body), len(body) // (edits + 1)
    for i in range(edits):
        copy[(i + 1) * step] = f"new{new}x{i}"
    return copy


def texts():
    rng = random.Random(3)
    word = lambda: "w%d" % rng.randrange(5000)
    out = ["", None, " \n", "one", "One", "one two three"]
    for _ in range(8):
        body = [word() for _ in range(300)]
        # similarities to the first: 0.97, 0.91, 0.87, 0.82, 0.81 and, not linked, 0.78
        out += [" ".join(edited(body, n, f"{len(out)}n{n}")) for n in (0, 1, 3, 4, 6, 7, 8)][: rng.randint(4, 7)]
    return out


@pytest.mark.parametrize("chunk", [2, 1024])
def test_near_duplicates(spark, monkeypatch, chunk):
    monkeypatch.setattr(similar.near_links, "__defaults__", (chunk,))
    rows = [(None if i in (1, 7) else 7 * i % 101, t) for i, t in enumerate(texts())]
    expected = [(d, c) for (d, _), c in zip(rows, plain_components(rows, 0.8), strict=True)]
    got = [tuple(r) for r in similar.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("edits,least,gone", [(6, 0.81, True), (4, 0.87, True), (3, 0.9, True), (8, 0.75, False)])
def test_pipeline_stage_at_levels_of_similarity(spark, edits, least, gone):
    rng, rows = random.Random(edits), []
    for i in range(20):
        body = ["w%d" % rng.randrange(5000) for _ in range(300)]
        rows += [(2 * i, " ".join(body)), (2 * i + 1, " ".join(edited(body, edits, i)))]
        assert least <= jaccard(shingles(rows[-1][1]), shingles(rows[-2][1])) < least + 0.02
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), None).collect()}
    assert kept == ({2 * i for i in range(20)} if gone else set(range(40)))


def test_empty_table(spark):
    assert similar.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_variants_just_below_the_similarity_send_no_pairs(spark):
    """What leaves the full comparison grows with the sets, not with their pairs; links among them are found."""
    sent = {}
    for n in (60, 120):
        rng = random.Random(n)
        body = ["w%d" % rng.randrange(5000) for _ in range(300)]
        # pairs of variants share 0.79; only the last one is similar to another
        rows = [(i, " ".join(edited(body, 7, i))) for i in range(n)]
        rows.append((n, rows[5][1] + " more words"))
        docs = spark.createDataFrame(rows, SCHEMA)
        sizes = [jaccard(shingles(rows[i][1]), shingles(rows[j][1])) for i, j in ((1, 2), (3, 9), (5, n))]
        assert 0.78 < sizes[0] < 0.8 and sizes[1] < 0.8 < sizes[2]
        got = {r.doc_id: r.component_id for r in similar.near_duplicates(docs).collect()}
        assert got.pop(n) == 5 and all(c == d for d, c in got.items())
        signed = similar.cut_lineage(similar.with_signature(docs, 5))
        sets = signed.groupBy("set").agg(*[similar.F.min(c).alias(c) for c in ("version", "n", "keys", "bytes")])
        links = similar.near_links(similar.cut_lineage(sets), docs, 5, 0.8)
        sent[n] = links.count()
    assert max(sent.values()) <= 2


def test_intersections_equal_sets():
    import numpy as np

    rng = random.Random(2)
    sets = [np.array(sorted({rng.randrange(300) for _ in range(rng.randrange(0, 90))}), np.uint64) for _ in range(40)]
    got = similar.common_counts(sets)
    pairs = [(i, j) for i in range(40) for j in range(i)]
    assert all(got[i, j] == len(set(sets[i].tolist()) & set(sets[j].tolist())) for i, j in pairs)


def test_other_texts_under_one_id_stay(spark):
    long = " ".join("w%d" % i for i in range(60))
    rows = [(1, long), (1, "quite another text of seven words"), (2, long + " x"), (3, "alone"), (3, "alone"), (None, long)]
    kept = similar.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([rows[0], rows[1], rows[3], rows[5]], key=repr)


def test_candidates_meet_by_fingerprints(spark):
    """Sets of a fingerprint within its radius are found, of all other fingerprints, and none beyond it."""
    body = ["w%d" % i for i in range(300)]
    texts = [" ".join(body), " ".join(edited(body, 6, "a"))]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    a, b = similar.with_signature(docs, 5).orderBy("doc_id").collect()
    schema = "set long, version long, n long, keys array<long>, bytes binary"
    for place, bits, linked in [(0, 0b111, 1), (0, 0b1111, 0), (24, 0, 1), (9, 1 << 40, 0)]:
        keys = [~k for k in a["keys"]]
        keys[place] = a["keys"][place] ^ bits
        rows = [(a.set, a.version, a.n, a["keys"], a.bytes), (b.set, b.version, b.n, keys, b.bytes)]
        links = similar.near_links(similar.cut_lineage(spark.createDataFrame(rows, schema)), docs, 5, 0.8)
        assert links.distinct().count() == linked, (place, bits)


def test_fingerprints_are_simhashes_of_the_set_and_of_drawn_shingles():
    import numpy as np
    import xxhash

    text = " ".join("w%d" % i for i in range(40))
    hashes = [xxhash.xxh64_intdigest(" ".join(text.split()[i : i + 5]).encode(), 42) for i in range(36)]
    shingles = similar.shingle_set(text, 5)
    got = similar.fingerprints(shingles, similar.minima(shingles)).tolist()
    draws = [min(hashes, key=lambda h: h * int(f) % (1 << 64)) for f in similar.FACTORS]  # noqa: B023
    groups = [hashes] + [draws[i : i + 5] for i in range(0, len(draws), 5)]
    assert got == [sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in g) > len(g)) for g in groups]
    assert np.uint64(got[0]) == np.uint64(similar.majority([np.array(hashes, np.uint64)]))
