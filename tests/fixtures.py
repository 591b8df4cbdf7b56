"""Paths of the given tables and hand-made daily tables for edge cases."""

import datetime as dt
import os

from pyspark.sql import types as T

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

DAILY_SCHEMA = T.StructType([
    T.StructField("day", T.DateType()),
    T.StructField("blocks_count", T.LongType()),
    T.StructField("tx_count_sum", T.LongType()),
    T.StructField("gas_refunded_avg", T.DoubleType()),
])


def daily(spark, n=35, start=dt.date(2024, 1, 1), skip=(), tx=None, gas=None):
    """``n`` consecutive days (minus ``skip`` indexes) with increasing metrics."""
    rows = []
    for i in range(n):
        if i in skip:
            continue
        t = tx(i) if tx else 100 + 10 * i
        g = gas(i) if gas else 0.5 + 0.01 * i
        rows.append((start + dt.timedelta(days=i), 10 + i, t, g))
    return spark.createDataFrame(rows, DAILY_SCHEMA)
