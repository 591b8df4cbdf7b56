"""Corpus pipeline: language identification, near-duplicates by n-gram Jaccard,
pseudonyms for personal data, mixing sources to target weights, packing.

Each stage reads what the one before wrote. ``ORACLE_SQL`` is None: language
prediction and keyed permutation have no SQL; ``tests/llm/test_pipeline.py`` holds the
run against a brute-force version."""

from __future__ import annotations

from daycast.llm import stages
from daycast.llm.common import cut, table

STAGES = [
    ("language_id", stages.identify_language),
    ("ngram_jaccard", stages.drop_near_duplicates),
    ("pii", stages.pseudonymise),
    ("mixing", stages.mix_sources),
    ("packing", stages.pack_sequences),
]
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
