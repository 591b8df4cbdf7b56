"""Layouts by their plans and files."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from daycast.operators.rollup import daily_rollup, raw_projection
from daycast.plans.enriched import enriched_daily
from daycast.plans.features import feature_table
from daycast.sources import layout as L
from daycast.sources import testdata as td
from fixtures import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *key):
    return [tuple(r) for r in df.orderBy(*(key or df.columns)).collect()]


def test_windows_of_a_clustered_table_need_no_exchange(spark, tmp_path):
    daily = enriched_daily(td.blocks(spark, SF_SMALL, with_series=True), td.price_history(spark, SF_SMALL), series=["series"])
    name = L.write_clustered(daily, ["series"], buckets=4, path=str(tmp_path / "t"))
    kept = spark.table(name)
    features = feature_table(kept, series=["series"])
    text = plan(features)
    assert "Window" in text and "Exchange" not in text and "Bucketed: true" in text
    assert len(glob.glob(str(tmp_path / "t" / "*.parquet"))) <= 4
    whole = feature_table(daily, series=["series"])
    same = lambda d: [tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in rows(d, "series", "date")]
    assert same(features.select(whole.columns)) == same(whole)
    both = kept.alias("a").join(kept.alias("b").where("day < '1996-01-01'"), ["series", "day"])
    assert "hashpartitioning" not in plan(both)
    spark.sql(f"DROP TABLE {name}")


def test_time_ordered_files(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw = raw_projection(td.blocks(spark, SF_SMALL), None, None, ordered=False)
    L.write_time_ordered(raw, path, files=5)
    got = L.read_time_range(spark, path, "1996-03-05", "1996-05-20")
    text = plan(got)
    assert "PartitionFilters" in text and "year_month" in text and "GreaterThanOrEqual(timestamp,1996-03-05" in text
    want = raw.where(F.to_date("timestamp").between("1996-03-05", "1996-05-20"))
    assert rows(got.select(raw.columns)) == rows(want)
    # files in name order, months in order: one sorted sequence, ties included
    key = lambda r: tuple((v is not None, v) for v in r)
    seen = []
    for month in sorted(os.listdir(path)):
        for f in sorted(glob.glob(f"{path}/{month}/*.parquet")):
            seen += [key(r[c] for c in raw.columns) for r in spark.read.parquet(f).coalesce(1).collect()]
    assert len(seen) == raw.count() and seen == sorted(seen)


def test_bounds_and_counts_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "daily")
    daily = daily_rollup(td.blocks(spark, SF_SMALL))
    daily.write.parquet(path)
    got = L.footer_bounds(spark, path, "day")
    text = plan(got)
    assert "PushedAggregation: [MIN(day), MAX(day), COUNT(*)]" in text and "tx_count_sum" not in text
    assert tuple(got.first()) == tuple(daily.agg(F.min("day"), F.max("day"), F.count(F.lit(1))).first())
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_price_months_outside_the_days_are_not_opened(spark, tmp_path):
    path = str(tmp_path / "price")
    price = td.price_history(spark, SF_SMALL)
    L.write_price_months(price, path)
    daily_path = str(tmp_path / "daily")
    daily_rollup(td.blocks(spark, SF_SMALL)).write.parquet(daily_path)
    daily = spark.read.parquet(daily_path).where(F.col("day").between("1996-03-05", "1996-04-20"))
    whole = daily.join(price.select(F.col("Date").alias("day"), F.col("Close").alias("price_usd"), F.col("Volume").alias("price_volume")), "day", "left")
    assert "dynamicpruning" in plan(L.price_of_days(daily, path)).lower()
    for folder in glob.glob(path + "/year_month=*"):  # unreadable outside the range
        if folder[-7:] not in ("1996-03", "1996-04"):
            for f in glob.glob(folder + "/*.parquet"):
                with open(f, "wb") as out:
                    out.write(b"not a table")
            for f in glob.glob(folder + "/.*.crc"):
                os.remove(f)
    got = L.price_of_days(daily, path, price.withColumn("year_month", F.lit("")).schema)
    assert rows(got.select(whole.columns), "day") == rows(whole, "day")
    assert got.count() == daily.count() and isinstance(got.first()["day"], dt.date)
