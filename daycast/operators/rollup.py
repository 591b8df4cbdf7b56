"""Range scan, daily roll-up and global aggregates over block records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.functions.casting import safe_cast_double

# Fixed values (must equal the reference): raw block columns and the daily
# roll-up they feed.  (output name, aggregate, source column, safe-cast?)
BLOCK_COLUMNS = ["timestamp", "txCount", "gasProvided", "gasRefunded",
                 "gasPenalized", "accumulatedFees", "developerFees"]
DAILY_AGGREGATES = [
    ("tx_count_sum", "sum", "txCount", False),
    ("accumulated_fees_sum", "sum", "accumulatedFees", True),
    ("developer_fees_sum", "sum", "developerFees", True),
    ("gas_provided_avg", "avg", "gasProvided", True),
    ("gas_refunded_avg", "avg", "gasRefunded", True),
    ("gas_penalized_avg", "avg", "gasPenalized", True),
]


def _day_between(ts: str, start: str | None, end: str | None) -> Column | None:
    """Inclusive day range on a timestamp column.

    Written as the plain ``to_date(ts) BETWEEN a AND b``: Catalyst rewrites it
    to a half-open timestamp range that reaches the Parquet scan."""
    day = F.to_date(F.col(ts))
    if start and end:
        return day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    if start:
        return day >= F.lit(start).cast("date")
    if end:
        return day <= F.lit(end).cast("date")
    return None


def scan_range(blocks: DataFrame, start: str | None, end: str | None,
               ts: str = "timestamp") -> DataFrame:
    """Block rows whose day lies in ``[start, end]`` (inclusive)."""
    cond = _day_between(ts, start, end)
    return blocks if cond is None else blocks.filter(cond)


def raw_projection(blocks: DataFrame, start: str | None, end: str | None,
                   ts: str = "timestamp", ordered: bool = True) -> DataFrame:
    """Raw mode: the seven typed block columns in a day range, in time order."""
    out = scan_range(blocks, start, end, ts).select(
        F.col(ts).alias("timestamp"),
        F.col("txCount"),
        safe_cast_double("gasProvided").alias("gasProvided"),
        safe_cast_double("gasRefunded").alias("gasRefunded"),
        safe_cast_double("gasPenalized").alias("gasPenalized"),
        safe_cast_double("accumulatedFees").alias("accumulatedFees"),
        safe_cast_double("developerFees").alias("developerFees"),
    )
    return out.orderBy("timestamp") if ordered else out


def daily_rollup(blocks: DataFrame, start: str | None = None, end: str | None = None,
                 series: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """One row per day (per series): block count, sums and averages.

    A plain ``groupBy`` → partial aggregate on every map task, one shuffle of
    at most (#days × #series) rows per task, final aggregate.  A day that
    holds a third of all blocks is folded map-side before the shuffle, so the
    hot key costs one row per task, not a third of the input."""
    aggs = [F.count(F.lit(1)).alias("blocks_count")]
    for name, fn, src, cast in DAILY_AGGREGATES:
        c = safe_cast_double(src) if cast else F.col(src)
        aggs.append((F.sum(c) if fn == "sum" else F.avg(c)).alias(name))
    return (scan_range(blocks, start, end, ts)
            .groupBy(*[F.col(s) for s in series], F.to_date(F.col(ts)).alias("day"))
            .agg(*aggs))


def date_bounds(df: DataFrame, date: str = "date", series: Sequence[str] = ()) -> DataFrame:
    """Min and max date (per series)."""
    return df.groupBy(*series).agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def row_counts(features: DataFrame, train_end: str, test_start: str, test_end: str,
               date: str = "date") -> DataFrame:
    """Rows of the feature table and of both splits, in a single pass."""
    d = F.col(date)
    return features.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(d <= F.lit(train_end).cast("date")).alias("n_train"),
        F.count_if(d.between(F.lit(test_start).cast("date"), F.lit(test_end).cast("date"))).alias("n_test"),
    ).withColumn("n_columns", F.lit(len(features.columns)))
