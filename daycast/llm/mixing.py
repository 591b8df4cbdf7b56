"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled (hash) order, offered
``max_passes`` times over. A document's virtual finish time is the source's
cumulative words up to it divided by the source's target, so all queues end
their share at time 1. The mix is the globally finish-ordered prefix whose
words fit the total budget.

Defined results: null text has size 0; a null source is a source of its own
(last in order); rows of one id, or without an id, stay separate rows, ordered by
id, then text hash; fully equal rows tie and are interchangeable; words of
size-0 documents cost nothing; an empty table gives an empty result. Columns
other than doc_id, text and source are ignored.

Scale: no window spans a source. Rows fall into hash ranges of bounded size
(source, bucket), whose sums are scanned in a small table; only
(source, bucket) windows and the one finish-time bucket that holds the cut see
rows. Sorting by finish time is a bucketed scan too."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycast.llm.common import cut

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_PASSES = 2
BUCKET_ROWS = 500
TIME_BUCKETS = 4096  # at least; the square root of the rows beyond that


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   cap: int = MAX_PASSES) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows.

    Water-filling in closed form over the (small) source table: sources sorted
    by cap / weight; the first ``k`` sit at their cap, the rest share what is
    left by weight."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w)
    fill = Window.orderBy((cap * F.col("source_size")) / F.col("w"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    per = (per.withColumn("budget", F.lit(share) * F.sum("source_size").over(every))
           .withColumn("capped", F.coalesce(F.sum(cap * F.col("source_size")).over(
               fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("open_w", F.sum("w").over(fill.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open_w")))
    # the level of the first source that its share does not lift over its cap
    per = per.withColumn("chosen", F.min(F.when(F.col("level") * F.col("w") <= cap * F.col("source_size"),
                                                F.struct((cap * F.col("source_size") / F.col("w")).alias("r"),
                                                         F.col("capped").alias("c"), "level"))).over(every))
    top = (cap * F.col("source_size")).cast("double")
    return per.select("source", "source_size", F.when(F.col("chosen").isNull(), top).otherwise(
        F.least(top, F.col("chosen.level") * F.col("w"))).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per document: ``doc_id, source, text_hash, size, source_size,
    target, taken`` (words the mix takes, repeats counted) and ``passes``."""
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"),
                       F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"))
    rows = rows.withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    rows = cut(rows)  # sizes only: texts are read once
    targets = source_targets(rows, weights, share, max_passes).persist()
    n_max = rows.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    buckets = 1 << max(0, (-(-n_max // BUCKET_ROWS) - 1).bit_length())
    bucket = F.conv(F.substring("h", 1, 12), 16, 10).cast("long") % buckets
    rows = rows.withColumn("bucket", bucket)
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("s"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s_source"), F.col("bucket").alias("s_bucket"),
                       F.coalesce(F.sum("s").over(ahead), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "text_hash").rowsBetween(
        Window.unboundedPreceding, 0)
    queued = (rows.withColumn("cum", F.sum("size").over(inside))
              .join(sums, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("bucket") == F.col("s_bucket")))
              .join(targets.withColumnRenamed("source", "t_source"),
                    F.col("source").eqNullSafe(F.col("t_source")))
              .withColumn("cum", F.col("cum") + F.col("before")))
    finish = lambda p: F.when(F.col("target") > 0, (F.col("cum") + p * F.col("source_size")) / F.col("target")).otherwise(0.0)
    queued = cut(queued.select("doc_id", "source", "text_hash", "h", "size", "source_size", "target",
                               *[finish(p).alias(f"f{p}") for p in range(max_passes)]))
    cutoff = _cut_time(queued, targets, max_passes, max(TIME_BUCKETS, math.isqrt(queued.count())))
    passes = sum((F.when(_key(p) <= cutoff, 1).otherwise(0) for p in range(max_passes)), F.lit(0))
    return queued.select("doc_id", "source", "text_hash", "size", "source_size", "target",
                         (passes * F.col("size")).cast("long").alias("taken"), passes.alias("passes"))


def _key(p: int):
    """Total order of one pass over a document in the global queue."""
    return F.struct(F.col(f"f{p}").alias("f"), F.coalesce(F.col("source"), F.lit("")).alias("s"),
                    F.col("h").alias("h"), F.col("text_hash").alias("t"))


def _cut_time(queued: DataFrame, targets: DataFrame, max_passes: int, time_buckets: int):
    """Largest queue key whose running total still fits the budget (a scalar
    subquery): time-bucket sums locate the one bucket that is read in order."""
    spark = queued.sparkSession
    offers = queued.select(F.explode(F.array(*[F.struct(_key(p).alias("k"), F.col("size")) for p in range(max_passes)])).alias("o")).select("o.k", "o.size")
    bucket = F.floor(F.col("k.f") * time_buckets)
    budget = targets.agg(F.sum("target")).first()[0] or 0.0
    sums = offers.groupBy(bucket.alias("b")).agg(F.sum("size").alias("s")).withColumn(
        "run", F.sum("s").over(Window.orderBy("b")))
    # first bucket that goes over the budget; none: everything is taken
    over = sums.where(F.col("run") > budget + 1e-6).agg(F.min(F.struct("b", "run", "s")).alias("x")).first()["x"]
    if over is None:
        return F.struct(F.lit(float("inf")).alias("f"), F.lit("").alias("s"), F.lit("").alias("h"), F.lit(0).cast("long").alias("t"))
    inside = offers.where(bucket == over["b"]).withColumn(
        "run", F.sum("size").over(Window.orderBy("k")) + (over["run"] - over["s"]))
    best = inside.where(F.col("run") <= budget + 1e-6).agg(F.max("k").alias("k")).first()["k"]
    if best is None:
        return F.struct(F.lit(over["b"] / time_buckets).alias("f"), F.lit("").alias("s"), F.lit("").alias("h"), F.lit(-2**63).cast("long").alias("t"))
    return F.struct(F.lit(best["f"]).alias("f"), F.lit(best["s"]).alias("s"), F.lit(best["h"]).alias("h"), F.lit(best["t"]).cast("long").alias("t"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: documents in their own columns, each as often as the mix
    takes it."""
    d = docs.withColumn("_mix_text", F.xxhash64("text"))
    # equal rows share one hash and finish, so passes are looked up by row values
    taken = (mix(docs, **options).groupBy(F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"),
                                          F.col("text_hash").alias("_mix_hash"))
             .agg(F.max("passes").alias("_mix_passes")))
    out = d.join(taken, d["doc_id"].eqNullSafe(F.col("_mix_id")) & d["source"].eqNullSafe(F.col("_mix_source"))
                 & (F.col("_mix_text") == F.col("_mix_hash")))
    return out.where("_mix_passes > 0").withColumn("_mix_pass", F.explode(F.sequence(F.lit(1), F.col("_mix_passes")))).select(*docs.columns)
