"""The pipeline's stages and their result against brute force on small tables."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, words int"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "fingerprint", "words"]


def prose(seed, sentences):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklmnoprstu", k=rng.randint(2, 9)))
    return " ".join(" ".join(word() for _ in range(rng.randint(5, 10))).capitalize() + "." for _ in range(sentences))


ITEM = prose(1000, 3)
KEY = 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'


def texts():
    """Text by id, and what should come of it: kept, gone, or masked."""
    clean = {i: prose(i, 12) for i in range(10, 40)}
    out = {i: (t, "kept") for i, t in clean.items()}
    out |= {100: (clean[10], "gone"), 101: (clean[10], "gone"), 102: (clean[11] + " ", "gone")}
    out |= {200: (prose(200, 10) + " " + ITEM + " " + prose(201, 10), "gone"), 201: (ITEM.upper() + " " + prose(202, 12), "gone")}
    out |= {300: (prose(300, 8) + f" é {KEY} " + prose(301, 8), "masked"), 301: (prose(302, 700), "kept")}
    out |= {400: ("too short", "gone"), 401: ("", "gone"), 402: (None, "gone"), 403: ("spam words here " * 40, "gone")}
    return out


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, t, "en", "s", len(t or ""), "x", 1) for i, (t, _) in texts().items()] + [(None, prose(900, 12), None, None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(10, 1, 0), (11, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_stages_take_effect_and_keep_the_columns(spark, sf_dir):
    docs, gone = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == COLUMNS, name
        gone.append(before - {r.doc_id for r in docs.collect()})
    assert gone == [{400, 401, 402, 403}, {100, 101, 102}, {200, 201}, set()]
    for r in docs.collect():
        if r.doc_id == 300:
            assert KEY not in r.text and "[SECRET]" in r.text and r.n_chars == len(r.text)
        elif r.doc_id is not None:
            assert r.text == texts()[r.doc_id][0]


def test_run_packs_all_that_is_kept(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    kept = {i for i, (_, what) in texts().items() if what != "gone"} | {None}
    assert {r.doc_id for r in rows} == kept
    for i, (text, what) in texts().items():
        if what == "kept":
            whole, at = LIBRARY.encode(text, add_special_tokens=False).ids + [0], 0
            for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece):
                assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(whole[at : at + r.length], "<u4").tobytes())
                at += r.length
            assert at == len(whole)
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048


def test_empty_tables(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    assert corpus_pipeline.run(spark, root).collect() == []
