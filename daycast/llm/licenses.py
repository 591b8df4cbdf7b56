"""License scans by an exact set-similarity join, in DataFrame functions only.

Texts are cut into overlapping blocks of words; license templates are token
sets of at most half a block, so every place of a template lies whole in some
block. Tokens are ordered by their document frequency over the whole corpus,
rarest first. A block meets a template when it holds at least
``ceil(threshold * distinct tokens)`` of the template's tokens, found by

* prefix filter: such a block holds one of the template's
  ``distinct - required + 1`` rarest tokens — an equi-join on those tokens;
* length filter: it holds at least ``required`` tokens of the vocabulary;
* positional filter: what may still match after the first shared token, on
  either side, reaches ``required``;
* exact count of the survivors.

A template marked ``ordered`` (the base phrases, threshold 1) must also stand
word by word; its places are counted where they start, once.

Defined results: null or empty text has no words, no block and score 0; rows
of equal id and text share one result and all stay; a null id is a value like
any other; other columns are ignored; an empty table gives an empty result.

Scale: two narrow passes over the texts. Only documents that hold a prefix
token (rare by construction) are cut into blocks; the template side is a fixed
list and broadcast; what is shuffled are verified matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK = 64
STEP = BLOCK // 2
THRESHOLD = 0.8

# Base phrases (label, words).
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# Opening words of widely used public license notices.
NOTICES = [
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def templates(threshold: float = THRESHOLD) -> list[dict]:
    """Base phrases (every token, in order) and notices (containment; a notice
    under ten distinct tokens must be there whole)."""
    out = []
    for ordered, rows in ((True, BASE), (False, NOTICES)):
        for label, text in rows:
            words = text.split()
            distinct = sorted(set(words))
            if len(words) > STEP:
                raise ValueError(f"template of {len(words)} words; at most {STEP}")
            t = 1.0 if ordered or len(distinct) < 10 else threshold
            out.append({"tid": len(out), "label": label, "words": words, "tokens": distinct,
                        "ordered": ordered, "need": -int(-t * len(distinct) // 1)})
    return out


def word_text(text):
    """Words of the text joined by single spaces (null: empty)."""
    # only the two letters that fold into ASCII need the slow A-Z mapping
    low = F.when(text.rlike(r"[İK]"), F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.lower(text))
    return F.trim(F.regexp_replace(F.coalesce(low, F.lit("")), SEPARATORS, " "))


def _strings(values):
    return F.array(*[F.lit(v) for v in values])


def token_order(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Rank of each template token by its document frequency over all texts,
    rarest first (ties by the token). The vocabulary is the fixed template list,
    so what comes to the driver is bounded by it."""
    counts = (words.select(F.explode(F.array_intersect("words", _strings(vocabulary))).alias("token"))
              .groupBy("token").count())
    found = {r["token"]: r["count"] for r in counts.collect()}
    return {t: i for i, t in enumerate(sorted(vocabulary, key=lambda t: (found.get(t, 0), t)))}


def matches(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per (document, block, template) that meets its threshold:
    ``doc_id, text_hash, block, tid, label, ordered, containment, starts`` —
    starts are word positions of an ordered template's places that begin in the
    block's own half (so no place is listed twice)."""
    spark = docs.sparkSession
    ts = templates(threshold)
    vocabulary = sorted({w for t in ts for w in t["tokens"]})
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.split(word_text(F.col("text")), " ").alias("words"))
    rank = token_order(base, vocabulary)

    inverted = []  # template side of the join: one row per prefix token
    for t in ts:
        ranks = sorted(rank[w] for w in t["tokens"])
        for i, r in enumerate(ranks[:len(ranks) - t["need"] + 1]):
            inverted.append(F.struct(
                F.lit(r).alias("rank"), F.lit(t["tid"]).alias("tid"), F.lit(t["label"]).alias("label"),
                F.lit(t["ordered"]).alias("ordered"), F.lit(t["need"]).alias("need"),
                F.lit(len(ranks) - i - 1).alias("after"), F.array(*[F.lit(x) for x in ranks]).alias("ranks"),
                _strings(t["words"]).alias("phrase")))
    side = spark.range(1).select(F.inline(F.array(*inverted)))
    by_rank = sorted(rank, key=rank.get)
    prefix = sorted({by_rank[r] for t in ts for r in sorted(rank[w] for w in t["tokens"])[:len(t["tokens"]) - t["need"] + 1]})

    hit = base.where(F.arrays_overlap("words", _strings(prefix)))
    n = F.size("words")
    last = F.greatest(F.lit(0), F.ceil((n - BLOCK) / STEP)).cast("int")
    blocks = hit.select("doc_id", "text_hash", "words", F.explode(F.sequence(F.lit(0), last)).alias("block"), last.alias("last"))
    lookup = F.create_map(*[x for w in by_rank for x in (F.lit(w), F.lit(rank[w]))])
    blocks = blocks.select("doc_id", "text_hash", "block", (F.col("block") == F.col("last")).alias("final"),
                           F.slice("words", F.col("block") * STEP + 1, BLOCK).alias("words"))
    blocks = blocks.withColumn("own", F.array_sort(F.transform(
        F.array_intersect("words", _strings(vocabulary)), lambda w: lookup[w])))
    ranks_in_prefix = F.array(*[F.lit(rank[w]) for w in prefix])
    pairs = (blocks.withColumn("rank", F.explode(F.array_intersect("own", ranks_in_prefix)))
             .join(F.broadcast(side), "rank"))
    left = F.size("own") - F.array_position("own", F.col("rank"))
    pairs = (pairs.where(F.size("own") >= F.col("need"))                       # length
             .where(1 + F.least(F.col("after"), left) >= F.col("need")))       # position
    shared = F.size(F.array_intersect("own", "ranks"))
    found = pairs.withColumn("shared", shared).where("shared >= need")
    size = F.size("phrase")
    starts = F.filter(F.sequence(F.lit(0), F.size("words") - size), lambda i: F.slice(F.col("words"), i + 1, size) == F.col("phrase"))
    starts = F.filter(starts, lambda i: F.col("final") | (i < STEP))
    found = found.withColumn("starts", F.when(~F.col("ordered"), F.array().cast("array<int>"))
                             .when(F.size("words") >= size, F.transform(starts, lambda i: i + F.col("block") * STEP))
                             .otherwise(F.array().cast("array<int>")))
    found = found.where(~F.col("ordered") | (F.size("starts") > 0))
    return found.select("doc_id", "text_hash", "block", "tid", "label", "ordered",
                        (F.col("shared") / F.size("ranks")).alias("containment"), "starts").dropDuplicates(
        ["doc_id", "text_hash", "block", "tid"])


def license_scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document the columns of the license report (see the module text)."""
    joined = lambda c: F.coalesce(F.array_join(F.array_sort(F.collect_set(c)), ","), F.lit(""))
    per = (matches(docs, threshold).groupBy("doc_id", "text_hash").agg(
        F.sum(F.when(F.col("ordered"), F.size("starts")).otherwise(0)).cast("long").alias("n_base"),
        F.min(F.array_min("starts")).cast("long").alias("first_word"),
        F.max(F.array_max("starts")).cast("long").alias("last_word"),
        joined(F.when(F.col("ordered"), F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"), F.max("containment").alias("score"))
        .withColumnRenamed("doc_id", "m_id").withColumnRenamed("text_hash", "m_hash"))
    words = word_text(F.col("text"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                       F.when(words == "", 0).otherwise(F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"))
    out = rows.join(per, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash")), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
                      F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                      F.coalesce("score", F.lit(0.0)).alias("score"))
