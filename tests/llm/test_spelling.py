"""Spelling variants against all pairs of words compared by edit distance."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramline.llm import spelling


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(rows):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return grouped({w: n for w, n in seen.items() if len(w) >= 5 and n >= 3})


def grouped(words):
    near = {w: [v for v in words if distance_one(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(4, 8))) for _ in range(25)]

    def typo(w):
        k = rng.randrange(len(w))
        return rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abÀ×") + w[k:], w[:k] + rng.choice("aZÿ") + w[k + 1 :], w, w, w])

    texts = [rng.choice([" ", "-", "1"]).join(typo(rng.choice(stems)) for _ in range(60)) for _ in range(80)]
    long = "ab" * 3000
    texts += [None, "", "Ā only ĀĀ", f"{long} {long} {long} {long}", f"{long}c {long}c {long}c x", texts[0], texts[0]]
    texts += ["wxyzw " * 40 + "wxyzv " * 15 + "wxyuv " * 5]
    return [(i if i % 9 else None, t) for i, t in enumerate(texts)]


def test_equals_all_pairs(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = spelling.group_spellings(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(rows)
    assert sorted(map(tuple, got.collect())) == want
    assert any(r[1] and r[2] != r[1] for r in want) and any(len(r[0]) > 5000 and r[4] for r in want)


def test_small_blocks_meet_all(spark, monkeypatch):
    rng = random.Random(8)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(5, 8))): rng.randrange(3, 90) for _ in range(700)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 7)
    blocks = spelling.blocks_of(frame, 3).collect()
    assert max(len(b.ns) for b in blocks) <= 30 and sum(len(b.ns) for b in blocks) == len(words)
    got = {r.word: (r.n_near, r.form_n, r.form) for r in spelling.near_words(frame, 3).collect()}
    for word, _, _, _, n_near, _ in grouped(words):
        if n_near:
            best = min((v for v in words if distance_one(word, v)), key=lambda v: (-words[v], v))
            assert got.pop(word) == (n_near, words[best], best)
    assert not got


def test_distances_of_long_words_are_exact():
    a = np.array([[97] * 5000 + [98]], np.uint32)
    b = np.array([[97] * 5001, [97] * 4999 + [98, 98], [98] + [97] * 5000], np.uint32)
    i, j = spelling.near_pairs(a, b, False)
    assert j.tolist() == [0, 1] and i.tolist() == [0, 0]


def test_chains_and_empty_tables(spark):
    chain = [(chr(97 + i) * 5, chr(98 + i) * 5) for i in range(9)]
    got = spelling.roots(spark.createDataFrame(chain, "word string, form string"))
    assert {r.root for r in got.collect()} == {"jjjjj"}
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.group_spellings(none).collect() == []
    alone = spark.createDataFrame([(1, "lonely lonely lonely")], "doc_id long, text string")
    assert [tuple(r) for r in spelling.group_spellings(alone).collect()] == [("lonely", None, "lonely", 3, 0, None)]


def test_block_rows_do_not_grow_with_the_square(spark):
    """One block sends at most one row per word, however many of its words are near."""
    words = [(f"aaaa{chr(97 + i)}{chr(97 + j)}", 3) for i in range(26) for j in range(26)]
    frame = spark.createDataFrame(words, "word string, n long")
    blocks = spelling.blocks_of(frame, 6)
    found = spelling.block_pairs(blocks, 6).mapInArrow(spelling._near, "word string, n_near long, best_n long, best string")
    pairs = found.agg(F.sum("n_near"), F.count(F.lit(1))).first()
    assert pairs[0] == 676 * 50 and pairs[1] < pairs[0] / 2
