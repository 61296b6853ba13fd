"""SimHash groups against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tramline.llm import simhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text, k):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """``prints``: (doc_id, fingerprint) rows."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, (_, x) in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j][1]).bit_count() <= radius:
                label[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [least.get(find(i)) for i in range(len(prints))]


TEXTS = ["", None, " \t\n", "one", "One two", "one two three", "ONE two Three", "É\xa0x y\x1cz w", "a b c d e f g h " * 9]


def near_copies():
    rng = random.Random(5)
    vocabulary = ["w%d" % i for i in range(400)]
    for _ in range(12):
        body = rng.choices(vocabulary, k=160)
        for _ in range(6):
            copy = list(body)
            copy[rng.randrange(160)] = rng.choice(vocabulary)
            yield " ".join(copy)


@pytest.mark.parametrize("k,radius,equal", [(3, 3, 2), (5, 5, 3), (2, 0, 1)])
def test_near_duplicates(spark, k, radius, equal):
    texts = [*TEXTS, *near_copies(), "one"]
    ids = [None if i in (1, 5) else 7 * i % 100 for i in range(len(texts))]
    docs = spark.createDataFrame(
        [(d, t, "x", 1) for d, t in zip(ids, texts, strict=True)], "doc_id long, text string, fingerprint string, root int"
    ).repartition(3)
    prints = [(d, plain_fingerprint(t, k)) for d, t in zip(ids, texts, strict=True)]
    expected = [(d, f"{x:016x}", c) for (d, x), c in zip(prints, plain_components(prints, radius), strict=True)]
    got = [tuple(r) for r in simhash.near_duplicates(docs, k, radius, equal).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []


def test_fingerprint_hash_is_the_one_of_the_engine(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("ab cd é"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("ab cd é".encode(), 42)


@pytest.mark.parametrize("chunk", [2, 5, 512])
def test_links_in_chunks_connect_every_near_pair(spark, chunk):
    rng = random.Random(chunk)
    base = [rng.getrandbits(64) for _ in range(3)]
    prints = sorted({b ^ sum(1 << rng.randrange(12) for _ in range(n)) & (2**64 - 1) for b in base for n in range(4) for _ in range(25)})
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fingerprint long")
    tied = {r.node % 2**64: r.root % 2**64 for r in simhash.components(simhash.near_links(frame, 3, chunk=chunk)).collect()}
    groups = plain_components([(p, p) for p in prints], 3)
    mine = [tied.get(p, p) for p in prints]
    assert len(set(zip(groups, mine, strict=True))) == len(set(groups)) == len(set(mine))


def test_components_of_a_long_chain(spark):
    n = 200
    nodes = random.Random(1).sample(range(10_000), n)
    links = spark.createDataFrame(list(zip(nodes, nodes[1:], strict=False)), "a long, b long")
    got = {r.node: r.root for r in simhash.components(links).collect()}
    assert got == {v: min(nodes) for v in nodes if v != min(nodes)}
