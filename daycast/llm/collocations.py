"""Phrase collocations by the stripes pattern.

A *stripe* is one prefix with a counter of its next words. Tasks count the stripes of
their texts in memory and send whole stripes; the shuffle brings a prefix together and
its stripes are merged elementwise. The empty prefix' stripe counts words and its total
is ``n``; an entry of a prefix' stripe is the count of the phrase (an extension) and the
prefix total of the next level; a stripe's largest entry, and the largest entry that ends
in a phrase, are the subsumption maxima. So all counts are read from one table of stripes.

Stripes are built level by level. A phrase that occurs ``min_count`` times is made of
phrases that do, so the tasks of a level keep only words whose shorter phrases passed; the
passed ones are a bitmap of ``BITS`` hashed places (8 MB at every size, checked by its
construction). A foreign phrase on a used place only costs a count that is dropped
after the exact merge.

A prefix with a large share of the words has a large stripe: stripes are cut by the
hash of the next word into buckets of about ``STRIPE_WORDS`` occurrences. How many buckets
a prefix needs is known from the level before; only prefixes with more than
1 / ``HOT_SHARE`` of all words can need several when the corpus is large, so at most
``HOT_SHARE`` numbers are sent to the tasks. Levels are written to the shared folder.

Defined results: a null text is empty, a null lang is ``und``; texts of any length are
counted whole, in slices of about ``WORDS_AT_ONCE`` words (one text at least); repeated rows count each time; ties
rank by count and then phrase; texts without words give nothing; an empty table gives an
empty result; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycast.llm.common import cut

BITS = 26
HOT_SHARE = 65_536
STRIPE_WORDS = 200_000
ROOT_BUCKETS = 1_024      # of the empty prefix, whose stripe is the vocabulary
WORDS_AT_ONCE = 2_000_000
ROWS_AT_ONCE = 5_000
MERGE_AT = 500_000        # entries of a stripe that are held before they are merged
STEP = np.uint64(0x9E3779B97F4A7C15)

# Bytes: A-Z to a-z, every piece separator to a full stop (which is one itself).
_LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_CUTS = b".,;:!?\n\x0b\x0c\r"
BYTES = bytes.maketrans(_LOWER[0] + _CUTS, _LOWER[1] + b"." * len(_CUTS))

STRIPE = "lang string, prefix binary, bucket int, next array<binary>, count array<bigint>"
ENTRY = "lang string, prefix binary, next binary, count bigint, hash bigint"


def _word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang + b"\0" + word)


def _more(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the one of its first words and of its last word."""
    h = (h ^ (h >> np.uint64(29))) * STEP
    return h + word


def _place(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * STEP
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


class _Words:
    """A task's words: number (from 1; 0 is a piece end) per language, hash, bytes."""

    def __init__(self):
        self.of: dict[bytes, dict] = {}
        self.word, self.lang = [b""], [b""]

    def numbers(self, lang: bytes, tokens: list[bytes]) -> np.ndarray:
        known = self.of.get(lang)
        if known is None:
            known = self.of[lang] = _Numbers(lang, self)
        return np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens))

    def hashes(self) -> np.ndarray:
        return np.array([0, *[_word_hash(a, w) for a, w in zip(self.lang[1:], self.word[1:])]], np.uint64)

    def languages(self) -> np.ndarray:
        """The language of each word, as a number."""
        seen = {a: i for i, a in enumerate(self.of)}
        return np.array([0, *[seen[a] for a in self.lang[1:]]], np.int64)


class _Numbers(dict):
    def __init__(self, lang: bytes, words: _Words):
        super().__init__({b".": 0})
        self.lang_name, self.words = lang, words

    def __missing__(self, word):
        self.words.word.append(word)
        self.words.lang.append(self.lang_name)
        self[word] = n = len(self.words.word) - 1
        return n


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Words, np.ndarray]]:
    """Word numbers of whole pieces, about ``WORDS_AT_ONCE`` at a time."""
    words, held, size = _Words(), [np.zeros(1, np.int32)], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                x = words.numbers(lang.encode(), text.translate(BYTES).replace(b".", b" . ").split())
                held += [x, held[0]]
                size += len(x)
                if size >= WORDS_AT_ONCE:
                    yield words, np.concatenate(held)
                    words, held, size = _Words(), [np.zeros(1, np.int32)], 0
    if size:
        yield words, np.concatenate(held)


def _counted(level: int, passed, hot):
    """Texts -> stripes of the prefixes of ``level - 1`` words."""
    def stripes(words: _Words, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        hashes = words.hashes()
        n = len(x) - level + 1
        if n <= 0:
            return
        good = np.ones(n, bool)
        for k in range(level):
            good &= x[k:k + n] > 0
        if passed is not None:
            bits = np.frombuffer(passed.value, np.uint8)
            h = hashes[x]
            for k in range(1, level - 1):  # phrases of level - 1 words from each place on
                h = _more(h[:-1], hashes[x[k:]])
            place = _place(h)
            known = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
            good &= known[:n]
            good &= known[1:1 + n]
        at = np.flatnonzero(good)
        if not len(at):
            return
        # number the prefixes, then count (prefix, next word)
        prefix = x[at].astype(np.int64) if level > 1 else np.zeros(len(at), np.int64)
        for k in range(1, level - 1):
            prefix = np.unique(prefix << 31 | x[at + k], return_inverse=True)[1]
        codes, first, count = np.unique(prefix << 31 | x[at + level - 1], return_index=True, return_counts=True)
        at, prefix, last = at[first], codes >> 31, x[at[first] + level - 1]
        if level == 1:
            buckets = np.full(len(at), ROOT_BUCKETS, np.int64)
            group = words.languages()[last]
        else:
            h = hashes[x[at]]
            for k in range(1, level - 1):
                h = _more(h, hashes[x[at + k]])
            buckets = np.ones(len(at), np.int64)
            if len(hot[0]):
                i = np.minimum(np.searchsorted(hot[0], h), len(hot[0]) - 1)
                buckets = np.where(hot[0][i] == h, hot[1][i], 1)
            group = prefix
        bucket = (hashes[last] % buckets.astype(np.uint64)).astype(np.int64)
        order = np.lexsort((bucket, group))
        at, last, count, group, bucket = at[order], last[order], count[order], group[order], bucket[order]
        starts = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (bucket[1:] != bucket[:-1])]))
        ends = np.append(starts[1:], len(at))
        names = pa.array(words.word, pa.binary())
        heads = [x[at[starts] + k].tolist() for k in range(level - 1)]
        prefixes = [b" ".join([words.word[w] for w in ws]) for ws in zip(*heads)] if level > 1 else [b""] * len(starts)
        langs = [words.lang[w].decode() for w in last[starts].tolist()]
        for a in range(0, len(starts), ROWS_AT_ONCE):
            b = min(a + ROWS_AT_ONCE, len(starts))
            lo, hi = starts[a], ends[b - 1]
            offsets = pa.array(np.append(starts[a:b], hi) - lo, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(langs[a:b]), pa.array(prefixes[a:b], pa.binary()), pa.array(bucket[starts[a:b]], pa.int32()),
                pa.ListArray.from_arrays(offsets, names.take(pa.array(last[lo:hi]))),
                pa.ListArray.from_arrays(offsets, pa.array(count[lo:hi], pa.int64()))],
                ["lang", "prefix", "bucket", "next", "count"])

    def run(batches):
        for words, x in _slices(batches):
            yield from stripes(words, x)
    return run


def _added(stripes: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Stripes in key order -> (first row of each key, key of each entry, next, count):
    stripes of one key added elementwise."""
    t = stripes.combine_chunks()
    keys = [t.column(c).chunk(0) if t.column(c).num_chunks else pa.array([], t.schema.field(c).type) for c in ("lang", "prefix", "bucket")]
    n = t.num_rows
    changed = np.zeros(max(n - 1, 0), bool)
    for k in keys:
        changed |= pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)
    key = np.concatenate([[0], np.cumsum(changed)]).astype(np.int64)
    lists = t.column("next").chunk(0)
    sizes = np.diff(lists.offsets.to_numpy())
    words = lists.flatten().dictionary_encode()
    counts = t.column("count").chunk(0).flatten().to_numpy()
    code = np.repeat(key, sizes) * max(len(words.dictionary), 1) + words.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    code, counts = code[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    total = np.add.reduceat(counts, at) if len(at) else counts
    entry_key, entry_word = np.divmod(code[at], max(len(words.dictionary), 1))
    first = np.flatnonzero(np.concatenate([[True], changed]))
    return first, entry_key, words.dictionary.take(pa.array(entry_word)), total


def _merged(level: int, min_count: int):
    """Stripes sorted by key -> the entries of merged stripes that reach ``min_count``,
    and at the first level the total of each (without a next word)."""
    def finish(t: pa.Table) -> Iterator[pa.RecordBatch]:
        first, key, words, count = _added(t)
        langs, prefixes = (t.column(c).take(pa.array(first)).to_pylist() for c in ("lang", "prefix"))
        keep = np.flatnonzero(count >= min_count)
        out_key, out_words = key[keep].tolist(), words.take(pa.array(keep)).to_pylist()
        codes = [a.encode() for a in langs]
        last = np.array([_word_hash(codes[k], w) for k, w in zip(out_key, out_words)], np.uint64)
        if level > 1:
            heads = [[_word_hash(a, w) for w in p.split(b" ")] for a, p in zip(codes, prefixes)]
            h = np.array([x[0] for x in heads], np.uint64)
            for i in range(1, level - 1):
                h = _more(h, np.array([x[i] for x in heads], np.uint64))
            last = _more(h[key[keep]], last)
        columns = [[langs[k] for k in out_key], [prefixes[k] for k in out_key], out_words, count[keep].tolist(), last.view(np.int64).tolist()]
        if level == 1:
            sums = np.bincount(key, minlength=len(first)).astype(np.int64) * 0
            np.add.at(sums, key, count)
            for c, more in zip(columns, (langs, prefixes, [None] * len(first), sums.tolist(), [0] * len(first))):
                c.extend(more)
        types = (pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        for a in range(0, len(columns[0]), 4 * ROWS_AT_ONCE):
            yield pa.RecordBatch.from_arrays([pa.array(c[a:a + 4 * ROWS_AT_ONCE], t) for c, t in zip(columns, types)],
                                             ["lang", "prefix", "next", "count", "hash"])

    def key(t, i):
        return tuple(t.column(c)[i].as_py() for c in ("lang", "prefix", "bucket"))

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            last = key(held, held.num_rows - 1)
            lo, hi = 0, held.num_rows - 1  # the first row of the last key
            while lo < hi:
                mid = (lo + hi) // 2
                lo, hi = (lo, mid) if key(held, mid) == last else (mid + 1, hi)
            if lo:
                yield from finish(held.slice(0, lo))
                held = held.slice(lo)
            if pc.sum(pc.list_value_length(held.column("next"))).as_py() > MERGE_AT:
                _, _, words, count = _added(held)
                ends = pa.array([0, len(count)], pa.int32())
                one = [*[pa.array([v]) for v in last], pa.ListArray.from_arrays(ends, words), pa.ListArray.from_arrays(ends, pa.array(count))]
                held = pa.table([c.cast(f.type) for c, f in zip(one, held.schema)], schema=held.schema)
        if held is not None:
            yield from finish(held)
    return run


def _bitmap(entries: DataFrame):
    """The places of the entries' phrases as bits, sent to the tasks: 2 ** BITS / 8 bytes."""
    spark = entries.sparkSession

    def places(batches):
        for b in batches:
            p = _place(b.column("hash").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(p)], ["place"])

    chunks = (entries.select("hash").mapInArrow(places, "place bigint")
              .groupBy(F.shiftright("place", 15).alias("chunk"))
              .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(32767)).alias("bits")))
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for row in chunks.collect():  # at most 2 ** (BITS - 15) rows of 4 KB
        part = np.frombuffer(row["bits"], np.uint8)
        out[row["chunk"] * 4096:row["chunk"] * 4096 + len(part)] = part
    return spark.sparkContext.broadcast(out.tobytes())


def _hot(entries: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of prefixes whose stripes are cut, and into how many buckets."""
    least = max(STRIPE_WORDS, n // HOT_SHARE)
    rows = entries.where(F.col("count") > least).select("hash", "count").collect()  # their counts add up to n at most
    h = np.array([r["hash"] for r in rows], np.int64).view(np.uint64)
    buckets = np.array([-(-r["count"] // STRIPE_WORDS) for r in rows], np.int64)
    order = np.argsort(h)
    return h[order], buckets[order]


def stripe_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10) -> DataFrame:
    """The entries of all stripes: (lang, prefix, next, count, level), the phrase
    ``prefix next`` occurring ``count >= min_count`` times within pieces of the texts. Rows
    of level 0 hold ``n``, all words of a language."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"),
                        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    passed, hot, n, levels = None, (np.zeros(0, np.uint64), np.zeros(0, np.int64)), 0, []
    for level in range(1, max_words + 1):
        width = int(spark.conf.get("spark.sql.shuffle.partitions"))
        entries = cut(texts.mapInArrow(_counted(level, passed, hot), STRIPE)
                      .repartition(width, "lang", "prefix", "bucket").sortWithinPartitions("lang", "prefix", "bucket")
                      .mapInArrow(_merged(level, min_count), ENTRY))
        if level == 1:
            totals = entries.where("next IS NULL").groupBy("lang").agg(F.sum("count").alias("count"))
            levels.append(totals.select("lang", F.lit(b"").alias("prefix"), F.lit(None).cast("binary").alias("next"), "count", F.lit(0).alias("level")))
            entries = entries.where("next IS NOT NULL")
            n = totals.agg(F.sum("count")).first()[0] or 0
        levels.append(entries.select("lang", "prefix", "next", "count", F.lit(level).alias("level")))
        if level < max_words:
            passed, hot = _bitmap(entries), _hot(entries, n)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionAll(more)
    return out


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, overlap: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words of each language by the score of
    their weakest cut: floor(1000000 a a / (l r)), all counts exact. A phrase goes when a
    longer one that holds it occurs at least ``overlap`` per cent as often."""
    table = stripe_counts(docs, max_words, min_count)
    phrase = F.when(F.length("prefix") == 0, F.col("next")).otherwise(F.concat("prefix", F.lit(b" "), "next")).cast("string")
    known = table.where("level > 0").select("lang", phrase.alias("phrase"), "count", "level", F.col("prefix").cast("string").alias("prefix"))
    totals = table.where("level = 0").select("lang", F.col("count").alias("n"))
    found = known.where("level > 1").select("lang", "phrase", F.col("count").alias("a"), "level", "prefix")
    # subsumption maxima: a stripe's largest entry, and the largest one whose phrase ends in it
    longer = found.where("level > 2").select(
        "lang", "a", F.explode(F.array("prefix", F.expr("substring_index(phrase, ' ', 1 - level)"))).alias("phrase"))
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = (found.join(most, ["lang", "phrase"], "left")
            .where(F.col("most").isNull() | (100 * F.col("most") < overlap * F.col("a"))).drop("most", "prefix"))
    cuts = kept.select("lang", "phrase", "a", "level", F.explode(F.sequence(F.lit(1), F.col("level") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("left"),
        F.expr("substring_index(phrase, ' ', k - level)").alias("right"))
    parts = known.select("lang", "phrase", "count")
    scored = (cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("count").alias("l")), ["lang", "left"])
              .join(parts.select("lang", F.col("phrase").alias("right"), F.col("count").alias("r")), ["lang", "right"]))
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    scored = scored.withColumn("a2", (wide("a") * wide("a")).cast("decimal(31,0)")).withColumn("lr", (wide("l") * wide("r")).cast("decimal(31,0)"))
    score = F.expr("CAST(((a2 * CAST(1000000 AS DECIMAL(7,0))) div lr) AS BIGINT)")
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("w")).select(
        "lang", "phrase", "a", "w.l", "w.r", "w.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = weakest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
