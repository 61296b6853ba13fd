"""The registered queries of the operators in this subpackage, over whole tables."""

from __future__ import annotations

import public_tokenizers

from tramline.llm import alignment, counts, decontam, lid, lm, packing, puquality, quality, secrets, simhash, spans, spelling, tokenfile
from tramline.session import scratch_path, table

QUERIES: dict = {}
ORACLES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontamination(spark, root):
    return decontam.find_contamination(table(spark, root, "documents"), table(spark, root, "benchmark"))


@query
def op2_best_fit_packing(spark, root):
    return packing.pack_documents(table(spark, root, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_token_files(spark, root):
    path = scratch_path(spark, "token-files")
    tokenfile.write_token_files(table(spark, root, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenfile.digest(tokenfile.read_token_files(spark, path))


@query
def op4_quality_rules(spark, root):
    return quality.quality_verdicts(table(spark, root, "documents"), table(spark, root, "labels"))


@query
def op5_token_counts(spark, root):
    return counts.count_tokens(table(spark, root, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_lm_scores(spark, root):
    return lm.score_documents(table(spark, root, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op7_simhash_groups(spark, root):
    return simhash.near_duplicates(table(spark, root, "documents"), shingle_words=3, radius=3)


@query
def op8_repeated_spans(spark, root):
    return spans.remove_repeated_spans(table(spark, root, "documents"))


@query
def op9_languages(spark, root):
    return lid.identify_languages(table(spark, root, "documents"))


@query
def op10_secrets(spark, root):
    return secrets.find_secrets(table(spark, root, "documents"))


@query
def op11_spelling_groups(spark, root):
    return spelling.group_spellings(table(spark, root, "documents"))


@query
def op12_quality_classifier(spark, root):
    return puquality.quality_scores(table(spark, root, "documents"), table(spark, root, "labels"))


@query
def op13_token_alignment(spark, root):
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_documents(table(spark, root, "documents"), *paths)


@query
def pipeline(spark, root):
    import corpus_pipeline

    return corpus_pipeline.run(spark, root)
