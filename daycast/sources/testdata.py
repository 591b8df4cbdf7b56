"""Stand-in inputs built from the driver's TPC-H-like tables.

The reference reads block records and a daily price history that are not
shipped; these views give the same schemas from ``lineitem`` and ``orders``
so every job runs on the whole given tables:

* blocks: timestamp=l_shipdate, txCount=l_quantity (integral),
  accumulatedFees=l_extendedprice as text ('n/a' on line 3, exercising the
  safe cast), developerFees=l_extendedprice*l_tax,
  gasProvided=l_extendedprice*(1-l_discount), gasRefunded=l_discount,
  gasPenalized=l_tax; optional series key l_returnflag.
* price: per order day, Close=avg(o_totalprice), Volume=count(*).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def blocks(spark: SparkSession, sf_dir: str, with_series: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    cols = [
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").cast("bigint").alias("txCount"),
        (price * (F.lit(1.0) - F.col("l_discount"))).alias("gasProvided"),
        F.col("l_discount").alias("gasRefunded"),
        F.col("l_tax").alias("gasPenalized"),
        F.when(F.col("l_linenumber") == 3, F.lit("n/a"))
         .otherwise(price.cast("string")).alias("accumulatedFees"),
        (price * F.col("l_tax")).alias("developerFees"),
    ]
    if with_series:
        cols.append(F.col("l_returnflag").alias("series"))
    return li.select(*cols)


def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw price table with the market-data column names Date/Close/Volume."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.to_date("o_orderdate").alias("Date"))
             .agg(F.avg("o_totalprice").alias("Close"), F.count(F.lit(1)).alias("Volume")))
