"""Token counts, token files and packing against the tokenizers library and brute force."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tramline.llm import counts, packing, tokenfile, tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "\n", "plain words, here.\nNext line", "two  spaces\n\nblank", " lead and trail ", "tab\tinside x\ty",
    "don't 'll we'RE it's", "a<|endoftext|> b <|endoftext|>c", "nul\x00 in\x00side", "é é   nbsp x", "日本 語です",
    "1 22 333 4.5,6", "!!! ?! ,. a!b", "x \n y", "end\n", "\r\nwin\r\nlines", "\x1c\x1d sep \x85", "word " * 3000, "ß" * 5000,
]
SCHEMA = "doc_id long, text string, piece string, start int, n_tokens string, _h int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", i, "y", 0) for i, t in enumerate(TEXTS)] + [(None, None, None, None, None, None), (3, TEXTS[3], "x", 1, "", 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


LIBRARY = Tokenizer.from_file(BYTES)


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


def test_encoder_equals_library_on_whole_texts():
    encoder = tokens.encoder(BYTES)
    for text in TEXTS + [a + b for a in TEXTS[:18] for b in TEXTS[:18]]:
        assert encoder.encode(text) == np.array(ids(text), "<u4").tobytes(), repr(text)


def test_token_counts(spark, docs, empty):
    library = Tokenizer.from_file(WORDS)
    got = sorted(map(tuple, counts.count_tokens(docs, WORDS, table_size=5).collect()), key=repr)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, ""), (3, TEXTS[3])]
    n = [len(library.encode(t, add_special_tokens=False).ids) for _, t in rows]
    assert got == sorted([(i, len(t.encode()), k, k > 2048) for (i, t), k in zip(rows, n)], key=repr)
    assert counts.count_tokens(empty, WORDS).collect() == []


def test_token_files_round_trip(spark, docs, empty, tmp_path):
    path = str(tmp_path / "files")
    tokenfile.write_token_files(docs, path, BYTES)
    got = tokenfile.digest(tokenfile.read_token_files(spark, path)).collect()
    got = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] + sorted([*range(len(TEXTS)), 3])
    at = 0
    for r in got:
        expected = ids(TEXTS[r.doc_id] if r.doc_id is not None else "") + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(expected), crc(expected))
        at += r.n_tokens
    assert [list(r.ids) for r in tokenfile.lookup(spark, path, [5]).collect()] == [ids(TEXTS[5]) + [2]]
    tokenfile.write_token_files(empty, str(tmp_path / "none"), BYTES)
    assert tokenfile.read_token_files(spark, str(tmp_path / "none")).collect() == []


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_of_documents(docs, empty):
    rows = packing.pack_documents(docs, BYTES, capacity=64).collect()
    check_packing(rows, 64)
    got = {}
    for r in rows:
        if r.doc_id != 3:
            got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    assert len([r for r in rows if r.doc_id == 3]) % 2 == 0
    for doc_id, text in [*enumerate(TEXTS), (None, "")]:
        if doc_id == 3:
            continue
        whole, at, expected = ids(text) + [0], 0, []
        for piece, n in enumerate(packing.cut_lengths(len(whole), 64)):
            expected.append((piece, at, n, crc(whole[at : at + n])))
            at += n
        assert at == len(whole) and sorted(got[doc_id]) == expected
    assert packing.pack_documents(empty, BYTES).collect() == []


def test_lower_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(1)
    for _ in range(60):
        lengths = rng.integers(1, 65, rng.integers(1, 60))
        _, _, held = packing.best_fit_decreasing(lengths, 64)
        assert packing.lower_bound(lengths, 64) <= len(held) and held.max() <= 64
    assert packing.lower_bound(np.array([33] * 10), 64) == 10
    assert packing.lower_bound(np.array([22] * 9), 64) == 5


@pytest.mark.parametrize("low,high", [(1, 64), (20, 40), (22, 22), (33, 64)])
def test_exchange_between_partitions(spark, low, high):
    rng = np.random.default_rng(low)
    lengths = rng.integers(low, high + 1, 3000).tolist()
    frame = spark.createDataFrame([(i, 0, 0, n, 7) for i, n in enumerate(lengths)], packing.PLACED.split(", sequence")[0])
    rows = packing.pack_pieces(frame, 64, 300).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(lengths))
    used = check_packing(rows, 64)
    _, _, held = packing.best_fit_decreasing(np.array(lengths), 64)
    assert used <= len(held) * 1.01 + 1


def test_equal_rows_spread_over_partitions(spark):
    frame = spark.createDataFrame([(None, 0, 0, 1, 7)] * 20_000, packing.PLACED.split(", sequence")[0])
    rows = packing.pack_pieces(frame, 64, 1000).collect()
    assert len(rows) == 20_000 and check_packing(rows, 64) <= 20_000 / 64 + 20
    assert len({r.sequence_id >> 28 for r in rows}) > 10


def test_files_are_ordered_by_number(spark, tmp_path):
    for number, doc_id in ((99999, 1), (100000, 2), (100001, 3)):
        one = spark.createDataFrame([(doc_id, 0, 5, [1] * 5)], tokenfile.SCHEMA)
        one.coalesce(1).write.orc(str(tmp_path / "one"), mode="overwrite")
        (name,) = (tmp_path / "one").glob("part-*.orc")
        (tmp_path / "all").mkdir(exist_ok=True)
        (tmp_path / "all" / name.name.replace("part-00000", f"part-{number:05d}")).write_bytes(name.read_bytes())
    got = tokenfile.read_token_files(spark, str(tmp_path / "all")).collect()
    assert sorted((r.start, r.doc_id) for r in got) == [(0, 1), (5, 2), (10, 3)]


def test_words_are_encoded_once_for_all_marks_behind_them(monkeypatch):
    """A new unit of a known word and marks needs no call of the tokenizer, and the ids stay those of the library."""
    encoder, sent = tokens.IdEncoder(BYTES), []
    words = ["blorfing", "Ünßer", "naïveté", "a1", "x²", "dog's", "it's", "日本", "a-b", "<|endoftext|>", "k<|endoftext|>", "'s", "ʰ"]
    marks = ["", ",", ".", "!!", "?!.", "%%%", "$$$", "###", "***", "&", ";:", "'", "',", "|>", ">.", '."', "-,"]
    texts = [f"{a}{m} {b}{m}\n{b}{m}" for a in words for b in words for m in marks]
    assert encoder.encode_all(texts) == [np.array(ids(t), "<u4").tobytes() for t in texts]
    assert [encoder.encode(t) for t in texts] == [np.array(ids(t), "<u4").tobytes() for t in texts]
    fresh = tokens.IdEncoder(BYTES)
    fresh.encode("one blorfing two , . !! %%%")

    class Spy:
        def encode_batch_fast(self, units, **options):
            sent.extend(units)
            return LIBRARY.encode_batch_fast(units, **options)

        def encode(self, unit, **options):
            return LIBRARY.encode(unit, **options)

    monkeypatch.setattr(fresh, "tokenizer", Spy())
    assert fresh.encode("one blorfing, blorfing. blorfing!! blorfing%%%") == np.array(ids("one blorfing, blorfing. blorfing!! blorfing%%%"), "<u4").tobytes()
    assert sent == []


def test_a_cache_that_starts_anew_loses_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_UNITS", 5)
    encoder = tokens.IdEncoder(BYTES)
    texts = [f"a b{i}, c{i}. d\ne f{i % 3}! {TEXTS[i % len(TEXTS)]}" for i in range(60)]
    for start in range(0, 60, 7):
        part = texts[start : start + 7]
        assert encoder.encode_all(part) == [np.array(ids(t), "<u4").tobytes() for t in part]


def test_plain_words_need_no_call_of_the_whole_library(monkeypatch):
    """New words, with marks or line breaks around them, go to the model alone, and the ids stay those of the library."""
    encoder = tokens.IdEncoder(BYTES)
    encoder.encode("a, b.\nc!!")

    class Nothing:
        def __getattr__(self, name):
            raise AssertionError(name)

    monkeypatch.setattr(encoder, "tokenizer", Nothing())
    text = "Neue Größe, blorfing naïveté.\nŽivot ontionerth!! ÿ"
    assert encoder.encode(text) == np.array(ids(text), "<u4").tobytes()


def test_columns_of_texts_with_any_white_space():
    """Slices of Arrow columns with nulls, cut in their buffers, against the library."""
    rng = np.random.default_rng(3)
    parts = [*" \n\t\r\x0b\x1c\x85\xa0", *" ", " ", "　", " ", " ", "—", "、", *"aZéß×÷ÿı1²_-'.,!%#<", "'ll", "🙂", "é", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(4000)] + [None, "", None]
    encoder, whole = tokens.IdEncoder(BYTES), pa.array(texts)
    for start in range(0, len(texts), 600):
        flat, counts = encoder.encode_column(whole.slice(start, 600))
        expected = [ids(t or "") for t in texts[start : start + 600]]
        assert counts.tolist() == list(map(len, expected))
        assert flat.tolist() == [i for e in expected for i in e]
    assert [a.tolist() for a in encoder.encode_column(pa.array([None, ""], pa.string()))] == [[], [0, 0]]


def test_pieces_of_plain_words_need_no_call_of_the_whole_library(spark, monkeypatch):
    """A batch of new plain words is cut and encoded as one column; pieces equal the library's ids."""
    encoder = tokens.IdEncoder(BYTES)
    encoder.encode("a. b")
    monkeypatch.setattr(encoder, "tokenizer", None)
    monkeypatch.setattr(tokens, "encoder", lambda path: encoder)

    class Captured:
        def select(self, *columns):
            return self

        def mapInArrow(self, function, schema):
            return function

    texts = ["blorfing naïveté. Größe", None, "ontionerth " * 40 + "end"]
    cut = packing.tokenize_pieces(Captured(), BYTES, capacity=64)
    rows = [r for b in cut([pa.RecordBatch.from_pydict({"doc_id": pa.array([7, None, 9]), "text": pa.array(texts)})]) for r in b.to_pylist()]
    expected = []
    for doc_id, text in zip([7, None, 9], texts, strict=True):
        whole, at = ids(text or "") + [0], 0
        for piece, n in enumerate(packing.cut_lengths(len(whole), 64)):
            expected.append((doc_id, piece, at, n, crc(whole[at : at + n])))
            at += n
    assert [tuple(r.values()) for r in rows] == expected


def test_all_units_of_a_worker_are_bounded_together(monkeypatch):
    """Words with and without a leading space share one bound, and what is used again stays known."""
    monkeypatch.setattr(tokens, "CACHED_UNITS", 100)
    encoder = tokens.IdEncoder(BYTES)
    for i in range(0, 3000, 10):
        encoder.encode("\n".join(f"kept a{j} b{j}" for j in range(i, i + 10)))
        caches = [c for c in vars(encoder).values() if isinstance(c, dict)]
        assert caches and sum(map(len, caches)) <= 100
        assert any("kept" in c for c in caches)
