"""Training of the attention model reads every document."""

import numpy as np
import public_tokenizers
import pytest

from tramline.llm import lm

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("options", [(), (2, 5)])
def test_every_training_document_is_read_once(spark, options):
    texts = [None, "", *(f"word{i} " * (1 + 5 * i) for i in range(10))]
    rows = [(None if i % 4 == 0 else i // 2, t) for i, t in enumerate(texts)] + [(7, "one id " * 9)] * 3
    counts = np.ones(lm.subwords(RANKS).n_vocab + 1, np.int64)
    model = lm.TextModel(RANKS, lm.Vocabulary(counts))
    shares = options[1] if options else lm.SHARES
    encoded = [model.encode(lm.words_of(t or ""))[0] for _, t in rows]
    expected = sum(len(model.windows([sequence])[0]) for sequence in encoded)
    stored = [(i % shares, bytearray(sequence.astype("<i2").tobytes())) for i, sequence in enumerate(encoded)]
    lm.train_rounds(spark.createDataFrame(stored, "share int, classes binary").repartition(2), model, *options)
    assert model.read == expected


def test_sums_by_row():
    rng = np.random.default_rng(1)
    for n in (1, 7, 4000):
        where, grads = rng.integers(0, 9, (n, 2)), [rng.standard_normal((n, 2, 3)).astype(np.float32) for _ in range(2)]
        for grad, got in zip(grads, lm._by_row(where, grads, 9), strict=True):
            plain = np.zeros((9, 3), np.float32)
            np.add.at(plain, where.ravel(), grad.reshape(-1, 3))
            assert np.allclose(got, plain, atol=1e-3)
