"""Words, ids and steps of the language model against plain ones."""

import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tramline.llm import lm

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    None, "", " ", "a", "One two\tTWO one ", "\n\x0b\x0c\r x", "É\xa0new\x1cword été É", "A[Z]{z}@`", "　 \xa0 b", "it's 's don't",
    "tail", "", " lead", "12ab-34 " * 9, "x" * 3000, "a\xa0 \xa0b 　 c", "\x1f \x08 \x0e é", None,
]


@pytest.mark.parametrize("part", [slice(None), slice(4, 9), slice(0, 3), slice(1, 1), slice(11, None)])
def test_words_of_whole_columns(part):
    texts = TEXTS[part]
    words, index, n = lm.distinct_words(pa.array(TEXTS, pa.string()).slice(*part.indices(len(TEXTS))[:1], len(texts)))
    words, expected = words.to_pylist(), [lm.words_of(t or "") for t in texts]
    assert len(set(words)) == len(words)
    assert n.tolist() == list(map(len, expected))
    assert [words[i] for i in index] == [w for own in expected for w in own]


def test_ids_of_words_encoded_together():
    plain = lm.subwords(RANKS).encode_ordinary
    words = sorted({w for t in TEXTS for w in lm.words_of(t or "")})
    for some in (words, [w for w in words if w.isascii()], words[-3:], []):
        ids, sizes = lm.word_ids(RANKS, some)
        expected = [plain(" " + w.decode()) for w in some]
        assert sizes.tolist() == list(map(len, expected)) and ids.tolist() == [i for own in expected for i in own]


def test_new_words_take_one_call_of_the_tokenizer(monkeypatch):
    calls, model = [], lm.TextModel(RANKS, lm.Vocabulary(np.arange(lm.subwords(RANKS).n_vocab + 1)))
    texts = [f"left{i} right{i % 7} Both both" for i in range(60)] + [None]
    expected = [(model.vocabulary.of[ids], model.vocabulary.inside[ids].sum()) for ids in map(_plain_ids, texts)]
    real = lm.word_ids
    monkeypatch.setattr(lm, "_WORD_IDS", {})
    monkeypatch.setattr(lm, "word_ids", lambda path, words: calls.append(len(words)) or real(path, words))
    for _ in range(2):
        words, index, n = lm.distinct_words(pa.array(texts))
        classes, sizes, inside = model.encode_all(words.to_pylist(), index, n)
        for (own, total), got, within in zip(expected, np.split(classes, np.cumsum(sizes)[:-1]), inside, strict=True):
            assert own.tolist() == got.tolist() and abs(total - within) < 1e-9
    assert calls == [60 + 7 + 1]


def _plain_ids(text):
    encoding = lm.subwords(RANKS)
    return [i for w in lm.words_of(text or "") for i in encoding.encode_ordinary(" " + w.decode())] + [encoding.n_vocab]


def test_a_full_store_of_words_loses_no_ids(monkeypatch):
    monkeypatch.setattr(lm, "_WORD_IDS", {})
    monkeypatch.setattr(lm.tokens, "CACHED_WORDS", 5)
    words = [b"w%d" % i for i in range(12)]
    expected = [lm.tokens.pack_ids(lm.subwords(RANKS).encode_ordinary(" " + w.decode())) for w in words]
    for a, b in ((0, 4), (2, 7), (0, 12), (5, 9)):
        assert lm.packed_ids(RANKS, words[a:b]) == expected[a:b]


def test_small_probabilities_are_not_cut():
    model = lm.Attention(2, 3, 1)
    model.p["b"][0], model.p["c"][0, 0] = 100, 90
    x, opening, target, _, _ = lm.windows([np.array([6, 1])], 7)
    got = model.log10(x, opening, target)[0, :2]
    assert np.allclose(got * math.log(10), [-100, -90], atol=5)


def test_steps_of_the_training():
    model = lm.TextModel(RANKS, lm.Vocabulary(np.arange(2000)))
    rng = np.random.default_rng(5)
    parts = [model.windows([rng.integers(0, model.vocabulary.classes, n) for n in (900, 40, 3)]) for _ in range(3)]
    plain = lm.Attention()
    x, opening, target, inside = (np.concatenate(p) for p in zip(*parts, strict=True))
    moments = {n: (0.0, 0.0) for n in plain.p}
    rng, order = np.random.default_rng(len(x)), np.zeros(0, int)
    for n in range(1, lm.LEAST_STEPS + 1):
        while len(order) < len(x):
            order = np.concatenate([order, rng.permutation(len(x))])
        take, order = order[: lm.TOGETHER], order[lm.TOGETHER :]
        for name, g in plain.gradient(x[take].astype(int), opening[take], target[take].astype(int), inside[take])[1].items():
            m, s = moments[name]
            m, s = moments[name] = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
            plain.p[name] = plain.p[name] - np.float32(0.02) * (m / (1 - 0.9**n) / (np.sqrt(s / (1 - 0.99**n)) + 1e-8)).astype(np.float32)
    assert model.train(parts, 0.02) == len(x)
    a, b = (a.log10(x.astype(int), opening, target.astype(int))[inside] for a in (plain, model.attention))
    assert abs(a.mean() - b.mean()) < 0.01 and a.mean() > -3.2
