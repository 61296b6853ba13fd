"""A corpus pipeline: documents to packed training sequences in five stages.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns what it
keeps. ``run`` writes each stage's rows as Parquet and hands what it reads back to the next.
All but the last return the columns of ``docs``; the last one row per piece of a sequence.
"""

from __future__ import annotations

import public_tokenizers

from tramline.llm import decontam, packing, quality, secrets, similar
from tramline.session import cut_lineage, table


def quality_rules(spark, docs, sf_dir):
    """Documents that fail the base rules or the certified cutoffs go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays: the one of the smallest id.

    Documents are linked where the sets of their five-word shingles have a Jaccard similarity
    of at least 0.8.
    """
    return similar.keep_first(docs, shingle_words=5, similarity=0.8)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a test item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark, docs, sf_dir):
    """Secrets in texts are masked; documents stay."""
    return secrets.mask_secrets(docs)


def packed_sequences(spark, docs, sf_dir):
    """Documents as token sequences: one row per piece with its sequence and place."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret scan", secret_scan),
    ("packing", packed_sequences),
]

#: SQL can express neither the tokenizer nor the fingerprints; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
