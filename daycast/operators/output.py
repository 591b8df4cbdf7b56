"""O1–O3: ordering, range partitioning before a write, bounded samples."""

from __future__ import annotations

from pyspark.sql import DataFrame


def ordered_output(df: DataFrame, *cols: str) -> DataFrame:
    """O1: total order for presentation (a range exchange + sort)."""
    return df.orderBy(*(cols or ("date",)))


def range_partition(df: DataFrame, n: int | None = None, col: str = "date") -> DataFrame:
    """O2: range-partition by date and sort within partitions — only worth it
    right before a write, so files hold contiguous, sorted date ranges.  ``n``
    defaults to the session's shuffle partitions."""
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, col).sortWithinPartitions(col)


def bounded_sample(df: DataFrame, max_rows: int, *order: str) -> DataFrame:
    """O3: the first ``max_rows`` rows in ``order`` (default: by date), a top-k:
    each task keeps its own k best, one task merges them — no count beforehand.
    Name the keys too where dates repeat, so the cut is the same in every run."""
    return df.orderBy(*(order or ("date",))).limit(max_rows)
