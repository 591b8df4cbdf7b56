"""Parquet inputs and outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daycast.operators.output import range_partition


def month_ranges(bounds: DataFrame, lo: str = "min_date", hi: str = "max_date") -> DataFrame:
    """Calendar-month ranges covering ``[lo, hi]`` of a bounds table,
    the first and last clipped to the bounds (one row per month)."""
    month = F.explode(F.sequence(F.trunc(F.col(lo), "MM"), F.col(hi), F.expr("INTERVAL 1 MONTH")))
    return (bounds.select(F.col(lo).alias("_lo"), F.col(hi).alias("_hi"), month.alias("month_start"))
                  .select(F.date_format("month_start", "yyyy-MM").alias("year_month"),
                          F.greatest(F.col("month_start"), F.col("_lo")).alias("range_start"),
                          F.least(F.last_day(F.col("month_start")), F.col("_hi")).alias("range_end")))


def with_year_month(df: DataFrame, date: str = "day") -> DataFrame:
    return df.withColumn("year_month", F.date_format(F.col(date), "yyyy-MM"))


def write_month_partitioned(df: DataFrame, path: str, date: str = "day") -> None:
    """S2 sink: one folder per calendar month; a later range read prunes
    folders by ``year_month``."""
    (with_year_month(df, date).write.mode("overwrite")
        .partitionBy("year_month").parquet(path))


def read_month_range(spark: SparkSession, path: str, start: str, end: str,
                     date: str = "day") -> DataFrame:
    """Read back a month-partitioned table for ``[start, end]``; the
    ``year_month`` predicate prunes partitions before any file is opened."""
    df = spark.read.parquet(path)
    return df.filter(F.col("year_month").between(start[:7], end[:7])
                     & F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def multi_read(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """S3: several Parquet inputs as one table, schemas merged by name."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def union_inputs(frames: Sequence[DataFrame]) -> DataFrame:
    """S3 for DataFrames: union by name, missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def features_sink(df: DataFrame, path: str, range_partitions: int | None = None) -> int:
    """Overwrite the feature table as Parquet; returns the rows written.

    The count is observed during the write (``DataFrame.observe``), so the
    feature plan runs once.  The window stage leaves every partition sorted
    by (series, date), so the files are already date-ordered;
    ``range_partitions`` adds the range-partition + sort of O2, which costs a
    sampling pass over the input and only pays off for a large table read
    back by date ranges."""
    obs = Observation("features_sink")
    out = range_partition(df, range_partitions) if range_partitions else df
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").parquet(path)
    return int(obs.get["rows"])


def features_scan(spark: SparkSession, path: str) -> DataFrame:
    """Read the feature table, ``date`` normalised to DATE."""
    return spark.read.parquet(path).withColumn("date", F.to_date(F.col("date")))
