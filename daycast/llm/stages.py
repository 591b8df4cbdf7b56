"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir), works on all
documents its predecessor kept and, but for the last, returns the columns of
``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm import jaccard, langid, mixing, packing, pii
from daycast.llm.queries import tokenizer

#: A document stays if its language is told with at least this probability;
#: texts without a letter go.
MIN_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the label of a document that has none
    is filled in. Learned from the labelled ones of the documents."""
    model = langid.train(langid.is_training(docs).select("text", "lang"))
    told = langid.predict(docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)], "text"), model)
    kept = told.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE))
    return kept.select(*[(F.coalesce(f"_{i}", "lang_pred") if c == "lang" else F.col(f"_{i}")).alias(c)
                         for i, c in enumerate(docs.columns)])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each n-gram Jaccard group."""
    return jaccard.keep_one(docs)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Valid personal numbers, dates and addresses replaced in the text; the
    character count follows the text."""
    flat = docs.select(*[F.col(f"`{c}`").alias("text" if c == "text" else f"_{i}") for i, c in enumerate(docs.columns)])
    out = pii.pseudonymise(flat).select(*[F.col("text" if c == "text" else f"_{i}").alias(c) for i, c in enumerate(docs.columns)])
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as its source's target takes it."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's pieces in fixed-capacity sequences."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), end_id=1)
