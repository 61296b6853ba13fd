"""Repeated passages without sentence ends, against shingles of words."""

import random

from tramline.llm import spans

FOUND = spans.LONG_WORDS + 1 + spans.MIN_WORDS


def shingles(text, n=FOUND):
    words = text.lower().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def passages():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 6)))
    prose = lambda n: " ".join(word() + rng.choice(["", "", "", "", "", "."]) for _ in range(n))
    shared = ["the " * FOUND, "and the " * 26, *(prose(rng.randint(FOUND, 70)) for _ in range(60))]
    shared += [" ".join(word() for _ in range(FOUND)) for _ in range(60)]
    return [(s, [f"{prose(rng.randint(0, 90))} {s} {prose(rng.randint(0, 90))}" for _ in range(2)]) for s in shared]


def test_starts_of_sentences_and_parts():
    for text in (t for _, pair in passages() for t in pair):
        words, starts = spans.sentences(text)
        assert words == text.lower().split() and starts == sorted(set(starts)) and starts[0] == 0
        ends = {0, *(i for i, w in enumerate(words, 1) if w.endswith(".") and i < len(words))}
        assert ends <= set(starts)
        for a, b in zip(starts, [*starts[1:], len(words)], strict=True):
            assert b - a <= spans.LONG_WORDS
        for s in set(starts) - ends:
            # cut inside a long sentence only
            assert min(e for e in [*ends, len(words)] if e > s) - max(e for e in ends if e < s) > spans.LONG_WORDS
    assert spans.sentences("") == ([], []) and spans.sentences(" \n ") == ([], [])
    assert spans.sentences("One. two\nthree! 4.5 x") == (["one.", "two", "three!", "4.5", "x"], [0, 1, 2, 3])


def test_every_repeated_run_is_cut_to_the_word(spark):
    found = passages()
    texts = [t for _, pair in found for t in pair]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in spans.remove_repeated_spans(docs).collect()}
    for i, (shared, (one, two)) in enumerate(found):
        assert shingles(one) & shingles(two)
        left = got[2 * i + 1]
        assert left.n_removed and not shingles(one) & shingles(left.text), i
        if i > 1:
            assert len(left.text.split()) == len(two.split()) - len(shared.split()), i
