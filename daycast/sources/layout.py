"""Table layouts that later reads profit from: clustered by series, ordered by time,
counted from footers, pruned by the other side of a join."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daycast.operators.enrich import price_left_join, price_rename
from daycast.session import shared_dir
from daycast.sources.files import with_year_month

# ---- clustered by series -------------------------------------------------------------


def write_clustered(df: DataFrame, series: Sequence[str], date: str = "day", buckets: int = 64,
                    path: str | None = None, name: str | None = None) -> str:
    """Write ``df`` hashed by series into ``buckets``, one sorted file each, and register
    it; returns the table's name. Windows, joins and groups by ``series`` then read it
    without a shuffle: a series is in one bucket already."""
    spark = df.sparkSession
    name = name or f"clustered_{uuid.uuid4().hex}"
    (df.repartition(buckets, *series).sortWithinPartitions(*series, date)
     .write.bucketBy(buckets, *series).sortBy(*series, date).mode("overwrite")
     .option("path", path or shared_dir(spark)).saveAsTable(name))
    return name


# ---- ordered by time -----------------------------------------------------------------


def write_time_ordered(df: DataFrame, path: str, ts: str = "timestamp", files: int | None = None) -> None:
    """Month folders of files that hold successive time ranges, each sorted: range
    boundaries come from a sample, so rows are shuffled once and nothing is sorted as a
    whole. Ties are broken by the other columns; rows of one instant may lie in two
    files, in order. Rows without a time go to the default partition's folder."""
    spark = df.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [ts, *[c for c in df.columns if c != ts]]
    (with_year_month(df, ts).repartitionByRange(n, *order).sortWithinPartitions("year_month", *order)
     .write.mode("overwrite").partitionBy("year_month").parquet(path))


def read_time_range(spark: SparkSession, path: str, start: str, end: str, ts: str = "timestamp") -> DataFrame:
    """Rows of the days ``[start, end]``: months outside are pruned before any file is
    opened, row groups outside by their statistics."""
    rows = spark.read.parquet(path)
    return rows.where(F.col("year_month").between(start[:7], end[:7])
                      & F.to_date(F.col(ts)).between(F.lit(start).cast("date"), F.lit(end).cast("date"))).drop("year_month")


# ---- counted from footers ------------------------------------------------------------


def footer_bounds(spark: SparkSession, path: str, date: str = "date") -> DataFrame:
    """(min_date, max_date, n_rows) of a written table, answered by the Parquet footers:
    no column chunk is read. Runs in a session of its own (same cluster, same tables),
    so the settings that allow it stay out of the caller's."""
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    return own.read.parquet(path).agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"),
                                      F.count(F.lit(1)).alias("n_rows"))


# ---- pruned by the other side --------------------------------------------------------


def write_price_months(price_raw: DataFrame, path: str) -> None:
    """A raw price table (Date, Close, Volume) by calendar month."""
    (with_year_month(price_raw, "Date").repartition("year_month")
     .write.mode("overwrite").partitionBy("year_month").parquet(path))


def price_of_days(daily: DataFrame, price_path: str, schema: StructType | None = None) -> DataFrame:
    """``daily`` with its days' prices (NULL without one) from a month-partitioned price
    table: the daily table's months prune the price scan at run time. With the
    ``schema`` given no file outside the months is opened, not even for its footer."""
    reader = daily.sparkSession.read
    price = (reader.schema(schema) if schema else reader).parquet(price_path)
    months = with_year_month(daily.select("day")).select("year_month").distinct()  # calendar months
    kept = price.join(F.broadcast(months), "year_month", "left_semi")
    return price_left_join(daily, price_rename(kept), "day")
