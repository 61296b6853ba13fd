"""Alignment of two tokenizers against a version that encodes whole texts and counts in dictionaries."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tramline.llm import alignment

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [
    "word", "Words,", "don't", "the", "the", "é", "naïve", "日本語", "▁", "<s>", "</s>", "<unk>", "<|endoftext|>", "<0x0A>",
    "1234", "x\x00y", "\t", "\r", " ", "  ", "\n", "\n\n", " ", "﻿", "á", "🙂🙂", "...!?", "\x1c", "();\r", "ßß", "x" * 70,
]
TEXTS = ["", " ", "\n", "a\nb", " lead", "trail ", "two  spaces", "a \n b", "same words same words same", "a▁b", "the " * 400, "\n\nx"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    return TEXTS + ["".join(rng.choice(PARTS) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randrange(1, 40))) for _ in range(300)]


def expected(texts):
    """Straight from the definition, over whole texts."""
    a_lib, b_lib = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    letters = {}
    spare = 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            letters[chr(byte)] = byte
        else:
            letters[chr(spare)] = byte
            spare += 1
    rows, held, links = [], Counter(), []
    for text in texts:
        if not text:
            rows.append((0, 0, 0, 0, ""))
            links.append({})
            continue
        raw = (" " + text).encode()
        a = a_lib.encode(" " + text, add_special_tokens=False).ids
        b = b_lib.encode(text)
        bytes_a = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in a]
        bytes_b = [
            bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in zip(b, b_lib.id_to_piece(b))
        ]
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            rows.append((0, 0, 0, 0, ""))
            links.append({})
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        both = sorted(set(ends_a) & set(ends_b))
        groups = defaultdict(lambda: ([], []))
        for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
            for i, end in zip(ids, ends):
                groups[min(x for x in both if x >= end)][side].append(i)
        own = Counter((x, y) for left, right in groups.values() for x in left for y in right)
        held.update(own.keys())
        links.append(own)
        digest = ";".join(",".join(map(str, groups[e][0])) + "|" + ",".join(map(str, groups[e][1])) for e in both)
        rows.append((len(a), len(b), len(both), sum(own.values()), hashlib.sha256(digest.encode()).hexdigest()))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return [
        (*row[:4], sum(m for p, m in own.items() if held[p] == most[p[0]]), sum(m * held[p] for p, m in own.items()), row[4])
        for row, own in zip(rows, links)
    ]


def test_alignment_equals_whole_texts(spark, texts):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, None, None, None), (3, texts[3], "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a string, container int").repartition(3)
    got = alignment.align_documents(docs, A, B)
    assert got.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    want = expected([r[1] for r in rows])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((r[0], *w) for r, w in zip(rows, want)), key=repr)


def test_pair_counts_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "the cat"), (2, "the the dog"), (3, "")], "doc_id long, text string").coalesce(1)
    counts = alignment.pair_counts(alignment.build_index(docs, A, B)).collect()
    assert max(r["count"] for r in counts) == 2 and all(r.best for r in counts)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_documents(none, A, B).collect() == []


def test_bitmaps_round_trip():
    rng = np.random.default_rng(1)
    for size in (1, 9, 1000, alignment.CONTAINER_DOCS):
        for share in (0.01, 0.5, 1.0):
            docs = np.flatnonzero(rng.random(size) < share).astype(np.uint16)
            packed = alignment.pack_bitmap(docs, size)
            assert alignment.unpack_bitmap(packed).tolist() == docs.tolist() and len(packed) <= 2 + size // 8 + 1


def test_containers_split_a_batch(monkeypatch):
    monkeypatch.setattr(alignment, "CONTAINER_ENTRIES", 50)
    monkeypatch.setattr(alignment.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 2})())
    batch = alignment.pa.RecordBatch.from_arrays(
        [alignment.pa.array(range(30)), alignment.pa.array(["some words here now"] * 30)], ["doc_id", "text"]
    )
    monkeypatch.setattr(alignment, "SLICE_CHARS", 20)
    rows = [r for b in alignment._indexer(A, B)([batch]) for r in b.to_pylist()]
    assert len({r["container"] for r in rows}) > 1
    assert sorted(r["doc_id"] for r in rows if r["low"] is not None) == list(range(30))
    assert min(r["container"] for r in rows) == 2 << 24
