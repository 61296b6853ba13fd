"""Quality rules, spans, decontamination, languages, scores and secrets on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tramline.llm import decontam, lid, lm, quality, secrets, spans

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, score int, spans int"


def table(spark, texts, langs=None, first=0):
    rows = [(first + i, t, (langs or ["en"] * len(texts))[i], "s", 0, "w", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def vocabulary(seed, n=300):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(n)]


# quality rules

EDGE = [
    "", None, "  \n\t ", "a b c a b c", "x " * 60, "one\ntwo\none\n\n \none", "É\xa0é #*$%&|<> ##\x0b\x1cq", "w " * 3000,
    " ".join(vocabulary(1)) * 2,
]


def plain_base(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_base_rules(spark):
    docs = table(spark, EDGE)
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    for r in quality.quality_verdicts(docs, labels).collect():
        base = plain_base(EDGE[r.doc_id])
        assert tuple(r[1:7]) == base and r.kept == (not base[5])
    assert quality.quality_verdicts(docs.limit(0), labels).collect() == []
    assert [r.doc_id for r in quality.keep_good(docs, labels).collect()] == [i for i, t in enumerate(EDGE) if not plain_base(t)[5]]


def test_certified_cutoffs(spark):
    rng, words = random.Random(3), vocabulary(2)
    texts, labelled = [], []
    for i in range(1400):
        bad = i % 7 == 0
        body = rng.choices(words, k=rng.randint(60, 90))
        texts.append(" ".join(w + "###" if bad and rng.random() < 0.9 else w for w in body))
        if i < 1200:
            labelled.append((i, 0 if bad else 1, 0))
    langs = ["en"] * 1390 + ["fr"] * 10
    docs = table(spark, texts, langs)
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in quality.quality_verdicts(docs, labels).collect()}
    english = [i for i in range(1390)]
    assert all(not got[i] for i in english if i % 7 == 0)
    assert sum(not got[i] for i in english if i % 7) <= 0.02 * 1200
    # a stratum without labels has no certified cutoffs
    assert all(got[i] for i in range(1390, 1400))
    kept = {r.doc_id for r in quality.keep_good(docs, labels).collect()}
    assert kept == {i for i, k in got.items() if k}


def test_binomial_probability():
    for k, n, p in ((0, 10, 0.1), (3, 20, 0.25), (20, 20, 0.5), (5, 300, 0.02)):
        plain = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(quality.binomial_cdf(k, n, p) - plain) < 1e-9


# repeated spans


def prose(seed, sentences=12):
    rng, words = random.Random(seed), vocabulary(4)
    return " ".join(" ".join(rng.choices(words, k=rng.randint(5, 9))).capitalize() + "." for _ in range(sentences))


def plain_runs(text, least=spans.LONG_WORDS + 1 + spans.MIN_WORDS):
    words = (text or "").lower().split()
    return {tuple(words[i : i + least]) for i in range(len(words) - least + 1)}


def plain_short_runs(text):
    return plain_runs(text, spans.MIN_WORDS)


def check_removal(rows, got):
    """``rows``: (doc_id, text). Long runs of words that were seen before are gone, and nothing else but what repeats."""
    for doc, text in rows:
        r = got[doc]
        assert (r.text is None) == (text is None)
        kept, at = [], 0
        for a, b in zip(r.removed[::2], r.removed[1::2], strict=True):
            assert at <= a < b
            kept.append(text[at:a])
            at = b
            # what goes lies in runs that an earlier document, or the text itself, holds as well
            gone = text[a:b].lower().split()
            runs = {tuple(gone[i : i + spans.MIN_WORDS]) for i in range(len(gone) - spans.MIN_WORDS + 1)}
            others = set().union(*(plain_short_runs(t) for d, t in rows if d < doc), set())
            own = [tuple(x) for x in (gone[i : i + spans.MIN_WORDS] for i in range(len(gone) - spans.MIN_WORDS + 1))]
            whole = text.lower().split()
            twice = Counter(tuple(whole[i : i + spans.MIN_WORDS]) for i in range(len(whole) - spans.MIN_WORDS + 1))
            assert runs and (runs & others or any(twice[x] > 1 for x in own)), (doc, gone)
        assert r.text == (None if text is None else "".join(kept) + text[at:])
        assert (r.n_removed > 0) == bool(r.removed) and r.n_removed <= r.n_sentences
        for d, t in rows:
            if d < doc:
                assert not plain_runs(t) & plain_runs(r.text) & plain_runs(text), (d, doc)


def test_repeated_spans(spark):
    passage = prose(100, 9)
    texts = [
        "", None, prose(1), prose(2) + " " + passage + " " + prose(3), prose(4) + "\n" + passage, passage, prose(1),
        prose(5) + "\n\n" + prose(5), "no sentence end here", "w " * 5000, prose(6, 3000), "word. " * 40,
        prose(7) + " " + passage.upper() + " " + prose(8), " ".join(vocabulary(9)),
        "start " + " ".join(vocabulary(9)) + " end",
    ]
    got = {r.doc_id: r for r in spans.remove_repeated_spans(table(spark, texts).repartition(3)).collect()}
    check_removal(list(enumerate(texts)), got)
    assert got[2].n_removed == 0 and got[6].text.strip() == "" and got[5].text.strip() == ""
    assert passage in got[3].text and got[13].n_removed == 0
    # to the word at both ends, in any case and beside other words of a sentence
    assert got[4].text.split() == prose(4).split() and got[12].text.split() == (prose(7) + " " + prose(8)).split()
    assert got[14].text.split() == ["start", "end"] and got[8].n_removed == 0
    assert spans.remove_repeated_spans(table(spark, [])).collect() == []


def test_spans_of_rows_without_id(spark):
    docs = spark.createDataFrame([(None, prose(1)), (None, prose(1)), (5, prose(1)), (5, prose(1))], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.n_removed > 0) for r in spans.remove_repeated_spans(docs).collect())
    assert got == [(False, False)] * 2 + [(True, True)] * 2


# decontamination


def plain_scores(items, passage):
    """BM25 of the distinct words of a passage against all segments, without an index."""
    n, mean = len(items), sum(map(len, items)) / len(items)
    df = Counter(w for x in items for w in set(x))
    out = []
    for x in items:
        tf, norm = Counter(x), decontam.K1 * (1 - decontam.B + decontam.B * len(x) / mean)
        weight = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c * (decontam.K1 + 1) / (c + norm) for w, c in tf.items()}
        out.append((sum(v for w, v in weight.items() if w in set(passage)), sum(weight.values())))
    return out


def test_wand_retrieves_all_above_threshold():
    rng, words = random.Random(8), vocabulary(8, 120)
    for share in (0.2, 0.4, 0.7):
        items = [rng.choices(words, k=rng.randint(3, 30)) for _ in range(40)]

        class Row:
            def __init__(self, i):
                self.item, self.item_id, self.segment, self.words, self.answer, self.length = i, i, 0, items[i], 1, len(items[i])

        index = decontam.Index([Row(i) for i in range(40)], Counter(w for x in items for w in set(x)), 40, sum(map(len, items)) / 40)
        reach, block_reach = index.at_threshold(share)
        pairs, expected = [], set()
        for p in range(60):
            passage = rng.choices(words + ["zz"] * 40, k=rng.randint(1, 60))
            pairs += [(p, t) for t in sorted({index.term[w] for w in passage if w in index.term})]
            expected |= {(p, i) for i, (s, own) in enumerate(plain_scores(items, passage)) if s >= share * own}
        got = decontam.block_max_wand(index, *np.array(pairs).T, reach, block_reach)
        assert {(p, i) for p, i, _ in got} == expected and len(got) == len(expected)


@pytest.mark.parametrize("shard_chars", [200, 1_000_000])
def test_contamination(spark, shard_chars):
    items = [prose(s, n) for s, n in ((1, 3), (2, 2), (3, 1), (4, 40))] + ["", None, prose(1, 3)]
    benchmark = spark.createDataFrame([(10 + i, t, "x") for i, t in enumerate(items)], "item_id long, text string, words string")
    texts = [
        prose(50, 40), prose(51, 30) + " " + items[0] + " " + prose(52, 30), items[1].upper().replace(" ", "!! "), "", None,
        prose(53) + "\n" + items[2], prose(54, 20) + items[3] + prose(55), items[0][: len(items[0]) // 2], prose(56, 900) + " " + items[1],
        "w " * 4000,
    ]
    found = decontam.find_contamination(table(spark, texts), benchmark, shard_chars=shard_chars).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 10), (1, 16), (2, 11), (5, 12), (6, 13), (8, 11)]
    kept = decontam.drop_contaminated(table(spark, texts), benchmark, shard_chars=shard_chars)
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4, 7, 9]
    assert decontam.find_contamination(table(spark, texts), benchmark.limit(0)).collect() == []
    assert decontam.find_contamination(table(spark, []), benchmark).collect() == []


# languages


def test_gradient_of_the_recurrent_network():
    model = lid.ByteGru(["a", "b", "c"], hidden=3)
    model.p = {k: v.astype(float) for k, v in model.p.items()}
    rng = np.random.default_rng(0)
    x, labels = rng.integers(0, 4, (6, 5)), rng.integers(0, 3, 5)
    _, grad = model.gradient(x, labels)
    for name, p in model.p.items():
        for _ in range(6):
            at = tuple(rng.integers(0, min(n, 4)) for n in p.shape)
            old = p[at]
            p[at] = old + 1e-6
            up = model.gradient(x, labels)[0]
            p[at] = old - 1e-6
            down = model.gradient(x, labels)[0]
            p[at] = old
            assert abs((up - down) / 2e-6 - grad[name][at]) < 1e-6, name


def test_languages(spark):
    rng = random.Random(2)
    styles = {"aa": ["tha", "ing", "on", "er"], "bb": ["é", "eau", "que", "ou"], "cc": ["sch", "ung", "ü", "ei"]}
    texts, langs = [], []
    for i in range(300):
        lang = list(styles)[i % 3]
        texts.append(" ".join("".join(rng.choices(styles[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(5, 80))))
        langs.append(lang)
    texts += ["", None, "123 .,!", "é" * 30_000]
    langs += ["aa", None, "bb", None]
    docs = table(spark, texts, langs)
    got = {r.doc_id: r for r in lid.predict(docs, lid.train_model(docs, steps=150)).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    tested = [i for i in range(300) if got[i].held_out]
    assert sum(got[i].lang_pred == langs[i] for i in tested) >= 0.95 * len(tested)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert [(got[i].lang_pred, got[i].score) for i in (300, 301, 302)] == [("und", 0.0)] * 3 and got[303].lang_pred == "bb"
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lid.identify_languages(none).collect()} == {"und"}
    assert lid.identify_languages(docs.limit(0)).collect() == []


def test_pooling_equals_the_mean_over_positions():
    model = lid.ByteGru(["a", "b"])
    texts = [b"x" * 7, b"", b"abc" * 50, b"q" * lid.WINDOW]
    got = model.documents(texts)
    for text, row in zip(texts, got, strict=True):
        parts = [text[i : i + lid.WINDOW] for i in range(0, len(text), lid.WINDOW)]
        rows = [model.probabilities(np.frombuffer(p.ljust(lid.WINDOW, b"\0"), np.uint8)[:, None])[0][: len(p), 0] for p in parts]
        assert np.allclose(row, np.concatenate(rows).mean(0) if rows else 0, atol=1e-5)


# language-model scores


def test_gradient_of_the_attention():
    model = lm.Attention(2, 3, 1)
    model.p = {k: v.astype(float) for k, v in model.p.items()}
    rng = np.random.default_rng(1)
    x, opening, target, inside, _ = lm.windows([rng.integers(0, 7, n) for n in (5, 40, 16)], 7)
    _, grad = model.gradient(x, opening, target, inside)
    for name, p in model.p.items():
        for _ in range(8):
            at = tuple(rng.integers(0, n) for n in p.shape)
            old = p[at]
            p[at] = old + 1e-6
            up = model.gradient(x, opening, target, inside)[0]
            p[at] = old - 1e-6
            down = model.gradient(x, opening, target, inside)[0]
            p[at] = old
            assert abs((up - down) / 2e-6 - grad[name][at]) < 1e-5, name


def test_windows_score_each_position_once_and_causally():
    model = lm.Attention(2, 4, 1)
    rng = np.random.default_rng(2)
    sequences = [rng.integers(0, 9, n) for n in (1, 15, 16, 17, 70)]
    x, opening, target, inside, owner = lm.windows(sequences, 9)
    got = model.log10(x, opening, target)
    p = model.p
    for d, s in enumerate(sequences):
        own = got[owner == d][inside[owner == d]]
        assert len(own) == len(s)
        inputs = np.concatenate([[9], s[:-1]])
        for i in range(len(s)):
            low = max(0, i // lm.STRIDE * lm.STRIDE - lm.STRIDE)
            seen = inputs[low : i + 1]
            near = p["near"][i % lm.STRIDE][lm.STRIDE + i % lm.STRIDE - (i - low) : lm.STRIDE + i % lm.STRIDE + 1]
            a = p["k"][seen] @ p["q"][inputs[i]] / math.sqrt(lm.WIDTH) + near
            a = np.exp(a - a.max())
            state = np.tanh((a / a.sum()) @ p["v"][seen] + p["r"][inputs[i]])
            choices = np.exp(state @ p["w"] + p["b"])
            choices /= choices.sum()
            if s[i] < 8:
                members = np.exp(state @ p["u"][s[i] // 4] + p["c"][s[i] // 4])
                expected = math.log10(choices[s[i] // 4] * members[s[i] % 4] / members.sum())
            else:
                expected = math.log10(choices[2 + s[i] - 8])
            assert abs(expected - own[i]) < 1e-4


def test_scores(spark):
    rng, words = random.Random(4), vocabulary(11, 60)
    chain = {w: rng.sample(words, 3) for w in words}
    texts = []
    for _ in range(200):
        w, body = rng.choice(words), []
        for _ in range(rng.randint(5, 60)):
            body.append(w)
            w = rng.choice(chain[w])
        texts.append(" ".join(body).capitalize())
    texts += ["", None, " \n ", "É\xa0new\x1cword " * 3, "x" * 3000]
    docs = table(spark, texts).unionByName(table(spark, texts[:2]))
    got = lm.score_documents(docs, RANKS, shares=2, frequent=20).collect()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    low = [WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for t in texts]
    train = [w for i, ws in enumerate(low) for w in (ws + [None]) * (2 if i < 2 else 1) if not held[i]]
    count = Counter(train)
    n, v = len(train), len(count)
    assert len(got) == len(texts) + 2
    for r in got:
        own = low[r.doc_id] + [None]
        base = sum(math.log10((count[w] + 1) / (n + 1 * (v + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(count[w] > 0 for w in own), n)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0
    # training pays on texts that took no part in it
    untrained = {r.doc_id: r.score for r in lm.score_documents(docs, RANKS, rounds=0).collect()}
    plain = [r for r in got if r.held_out and r.doc_id < 200]
    assert sum(r.score for r in plain) > 0.75 * sum(untrained[r.doc_id] for r in plain)
    assert lm.score_documents(docs.limit(0), RANKS).collect() == []


def test_probabilities_of_all_ids_add_up_to_one():
    counts = np.random.default_rng(0).integers(0, 50, 400)
    v = lm.Vocabulary(counts, 10, 5)
    assert np.allclose(np.bincount(v.of, 10.0**v.inside), 1)


# secrets


def plain_spans(text):
    text, found = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def secret_texts():
    rng = random.Random(6)
    key = lambda alphabet, n: "".join(rng.choices(alphabet, k=n))
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = [
        "", None, "no secret", 'é token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" x', "TOKEN:abcdef", "api_key=abcde", "apikey='a.b-c_d='",
        "secret:token:abcdef", "password = pass word=abcdef", "AKIA" + "A1" * 8, "xAKIAAKIA" + "B2" * 8 + "z", "AKIA1234",
        "deadbeef" * 3, "a" * 23, "token==xyzxyz", "日本 passwd: " + "q1" * 30 + " 語 AKIA" + "Z9" * 9, "token = " + "ab12" * 2000,
        "token='abcdef' " * 50, "x " * 30_000 + "secret=abc123",
    ]
    texts += [f"{prose(i, 4)} {key(b64, 40)} {prose(i + 1, 2)}" for i in range(40)]
    texts += [f"see 2024-01-01-weekly-status-report-number-{i}-of-the-northern-team here" for i in range(40)]
    return texts


def test_secrets(spark):
    texts = secret_texts()
    docs = table(spark, texts)
    kinds = ("assign", "access", "hex")
    for r in secrets.find_secrets(docs).collect():
        base = plain_spans(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3)), r.doc_id
        joined = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert ",".join(s for s in r.spans.split(",") if not s.startswith("random")) == joined
        if 19 <= r.doc_id < 59:
            (start, end), = re.findall(r"random:(\d+):(\d+)", r.spans)
            assert int(end) - int(start) == 40
        else:
            assert "random" not in r.spans, texts[r.doc_id]
    assert secrets.find_secrets(docs.limit(0)).collect() == []


def test_masks(spark):
    texts = secret_texts()
    masked = secrets.mask_secrets(table(spark, texts))
    assert masked.columns == table(spark, []).columns
    for r in masked.collect():
        text = texts[r.doc_id]
        base = plain_spans(text)
        if not base and not 19 <= r.doc_id < 59:
            assert r.text == text and r.n_chars == 0
        else:
            assert secrets.MASK in r.text and r.n_chars == len(r.text)
            for a, _, b in base:
                assert text[a:b] not in r.text
