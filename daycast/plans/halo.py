"""Exact bucketed window mode for series too long for one window partition.

A plain ``PARTITION BY series ORDER BY date`` window puts a whole series in
one task.  At day grain that is bounded by the calendar; at finer grains (or
for one dominant series) it is not.  This mode splits every series into
buckets of ``B`` consecutive rows and runs the same window plan with
``PARTITION BY series, bucket``:

1. **Row index** without a global sort: rows are grouped into coarse date
   blocks; per-block counts (a small aggregate) give each block its offset by
   a running sum over the block table; inside a block ``row_number`` adds the
   position.  Deterministic (dates are unique per series), so recomputation
   after an executor loss yields the same index.
2. **Halo**: a row is also copied, as a non-owned row, into the next bucket
   when it is among the last ``look_back`` rows of its bucket, and into the
   previous bucket when it is among the first ``look_ahead`` rows.  Every
   owned row then sees all rows its features depend on (30 back, 1 ahead).
3. Features are computed per (series, bucket); only owned rows are kept.

The forward fill has an unbounded look-back, so it gets its own carry step:
the last non-null value per block, carried across the (small) block table by
a running ``last(ignorenulls)``, joined back and used where the in-block
fill finds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _block(date: str, block_days: int) -> Column:
    epoch = F.lit("1970-01-01").cast("date")
    return F.floor(F.datediff(F.col(date), epoch) / F.lit(block_days)).cast("long")


def row_index(df: DataFrame, series: Sequence[str] = (), date: str = "date",
              block_days: int = 32) -> DataFrame:
    """Add ``_idx`` (0-based row number per series in date order) and
    ``_first_date`` (first date of the series)."""
    series = list(series)
    b = df.withColumn("_blk", _block(date, block_days))
    counts = b.groupBy(*series, "_blk").agg(F.count(F.lit(1)).alias("_n"),
                                            F.min(date).alias("_blk_first"))
    wb = Window.partitionBy(*series).orderBy("_blk")
    # one row per block: (#days / block_days) rows per series
    offsets = counts.select(
        *series, "_blk",
        F.coalesce(F.sum("_n").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.min("_blk_first").over(wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
         .alias("_first_date"))
    pos = F.row_number().over(Window.partitionBy(*series, "_blk").orderBy(date)) - 1
    return (b.join(offsets, [*series, "_blk"])
             .withColumn("_idx", F.col("_off") + pos)
             .drop("_blk", "_off"))


def halo_buckets(indexed: DataFrame, bucket_rows: int, look_back: int, look_ahead: int) -> DataFrame:
    """Assign ``_bucket`` and copy halo rows (``_own`` = false) next to it."""
    if bucket_rows <= look_back + look_ahead:
        raise ValueError(f"bucket_rows must exceed {look_back + look_ahead}")
    bucket = F.floor(F.col("_idx") / F.lit(bucket_rows)).cast("long")
    pos = F.col("_idx") % F.lit(bucket_rows)
    copies = F.array(
        F.struct(bucket.alias("b"), F.lit(True).alias("own")),
        F.when(pos >= bucket_rows - look_back, F.struct((bucket + 1).alias("b"), F.lit(False).alias("own"))),
        F.when((pos < look_ahead) & (bucket > 0), F.struct((bucket - 1).alias("b"), F.lit(False).alias("own"))))
    return (indexed.select("*", F.explode(F.filter(copies, lambda c: c.isNotNull())).alias("_c"))
                   .select(*[F.col(c) for c in indexed.columns if c != "_idx"],
                           F.col("_c.b").alias("_bucket"), F.col("_c.own").alias("_own")))


def ffill_bfill_bucketed(df: DataFrame, cols: Sequence[str], order: str = "day",
                         series: Sequence[str] = (), block_days: int = 32) -> DataFrame:
    """Forward fill then leading back fill (same result as
    ``operators.enrich.ffill_bfill``) without a whole series in one window
    partition."""
    series = list(series)
    cols = [c for c in cols if c in df.columns]
    b = df.withColumn("_blk", _block(order, block_days))
    stats = b.groupBy(*series, "_blk").agg(*[
        agg for c in cols for agg in (
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_last_{c}"),
            F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_first_{c}"))])
    wb = Window.partitionBy(*series).orderBy("_blk")
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    whole = wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = stats.select(*series, "_blk", *[
        x for c in cols for x in (
            F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}"),
            F.first(f"_first_{c}", ignorenulls=True).over(whole).alias(f"_lead_{c}"))])
    w_in = (Window.partitionBy(*series, "_blk").orderBy(order)
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = b.join(carry, [*series, "_blk"])
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(w_in), F.col(f"_carry_{c}"), F.col(f"_lead_{c}"))
              for c in cols}
    return joined.select([filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
