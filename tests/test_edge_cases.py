"""Hand-made fixtures for the exact row semantics of the feature table."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.functions.calendar import calendar_features, month_edges
from daycast.functions.transforms import reconstruct
from daycast.operators.enrich import ffill_bfill, price_left_join
from daycast.operators.schema import SchemaError
from daycast.operators.split import EmptySplitError
from daycast.plans.features import feature_table
from daycast.plans.train import train_and_compare
from fixtures import daily


def test_35_days_keep_6_rows(spark):
    ft = feature_table(daily(spark, 35))
    rows = ft.orderBy("date").collect()
    assert len(rows) == 6                                  # rows 28..33
    assert rows[0]["date"] == dt.date(2024, 1, 29)
    assert rows[-1]["date"] == dt.date(2024, 2, 3)
    r = rows[0]                                            # row index 28
    assert r["label"] == 100 + 10 * 29
    assert r["tx_log"] == pytest.approx(math.log1p(100 + 10 * 28))
    assert r["tx_log_lag28"] == pytest.approx(math.log1p(100))
    assert r["tx_log_lag7"] == pytest.approx(math.log1p(100 + 10 * 21))
    assert r["t"] == 28.0
    vals = [math.log1p(100 + 10 * i) for i in range(22, 29)]
    assert r["tx_log_ma7"] == pytest.approx(sum(vals) / 7)
    assert r["tx_log_max28"] == pytest.approx(math.log1p(100 + 10 * 28))
    assert r["tx_log_min28"] == pytest.approx(math.log1p(100 + 10 * 1))
    assert r["blocks_count_lag3"] == 10 + 25
    assert len(ft.columns) == 4 + 3 + 3 * 3 + 1 + 8 + 2 + 21 + 30   # date,label,label_log,tx_log + features


def test_missing_day_shifts_row_lags(spark):
    ft = feature_table(daily(spark, 35, skip={10}))
    rows = {r["date"]: r for r in ft.collect()}
    assert len(rows) == 5
    r = rows[dt.date(2024, 1, 30)]                         # index 29, 28th row after the gap
    # lag 7 is seven *rows* back: index 22
    assert r["tx_log_lag7"] == pytest.approx(math.log1p(100 + 10 * 22))
    # lag 28 is 28 rows back: index 0 (index 10 is missing)
    assert r["tx_log_lag28"] == pytest.approx(math.log1p(100))


def test_null_metric_asymmetry(spark):
    df = daily(spark, 35, gas=lambda i: None if i == 30 else 0.5 + 0.01 * i)
    ft = feature_table(df)
    kept = sorted(r["date"].day for r in ft.select("date").collect())
    assert kept == [29, 30, 31]                            # indexes 28, 29, 30 stay; 31..33 drop
    from daycast.operators.split import training_frame
    frame, _ = training_frame(ft)
    assert sorted(r["date"].day for r in frame.select("date").collect()) == [29, 30]


def test_constant_metric_zero_std_and_zscore(spark):
    ft = feature_table(daily(spark, 35, tx=lambda i: 500))
    for r in ft.collect():
        assert r["tx_log_std7"] == 0.0 and r["tx_log_std14"] == 0.0
        assert r["tx_log_z7"] == 0.0 and r["tx_log_z14"] == 0.0
        assert r["tx_log_rng28"] == 0.0 and r["regime_up"] == 0.0


def test_duplicate_dates_raise(spark):
    df = daily(spark, 5).unionByName(daily(spark, 2))
    with pytest.raises(Exception, match="two rows for one date"):
        feature_table(df).count()
    with pytest.raises(Exception, match="two rows for one date"):
        feature_table(daily(spark, 35).unionByName(daily(spark, 3))).collect()
    assert feature_table(daily(spark, 35)).count() == 6


def test_calendar_edges(spark):
    s = T.StructType([T.StructField("date", T.DateType())])
    days = [dt.date(2024, 12, 31), dt.date(2024, 2, 29), dt.date(2021, 1, 3), dt.date(2024, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], s)
    out = {r["date"]: r for r in df.select("date", *calendar_features(), *month_edges(),
                                           F.weekofyear("date").alias("woy")).collect()}
    two_pi = 2 * math.pi
    # day 366 wraps onto day 1 (zero-based 365 of period 365)
    assert out[dt.date(2024, 12, 31)]["doy_sin"] == pytest.approx(math.sin(two_pi * 365 / 365))
    assert out[dt.date(2024, 12, 31)]["is_month_end"] == 1.0
    assert out[dt.date(2024, 2, 29)]["is_month_end"] == 1.0
    assert out[dt.date(2021, 1, 3)]["woy"] == 53              # ISO week
    assert out[dt.date(2021, 1, 3)]["dow_sin"] == pytest.approx(0.0)   # Sunday is 0
    assert out[dt.date(2024, 1, 1)]["is_month_start"] == 1.0
    for r in out.values():
        for p in ("dow", "doy", "month", "woy"):
            assert r[f"{p}_sin"] ** 2 + r[f"{p}_cos"] ** 2 == pytest.approx(1.0)


def _price(spark, rows):
    s = T.StructType([T.StructField("day", T.DateType()), T.StructField("price_usd", T.DoubleType()),
                      T.StructField("price_volume", T.DoubleType())])
    return spark.createDataFrame(rows, s)


def test_fill_forward_then_leading_back(spark):
    d = daily(spark, 6)
    base = dt.date(2024, 1, 1)
    p = _price(spark, [(base + dt.timedelta(days=2), 5.0, 50.0), (base + dt.timedelta(days=4), 7.0, None)])
    out = ffill_bfill(price_left_join(d, p)).orderBy("day").collect()
    assert [r["price_usd"] for r in out] == [5.0, 5.0, 5.0, 5.0, 7.0, 7.0]
    assert [r["price_volume"] for r in out] == [50.0] * 6
    again = ffill_bfill(ffill_bfill(price_left_join(d, p))).orderBy("day").collect()
    assert again == out                                    # idempotent


def test_all_null_price_gives_empty_features(spark):
    d = daily(spark, 35)
    p = _price(spark, [(dt.date(1990, 1, 1), 1.0, 1.0)])   # never matches
    merged = ffill_bfill(price_left_join(d, p))
    assert merged.filter(F.col("price_usd").isNotNull()).count() == 0
    assert feature_table(merged).count() == 0


def test_log1p_domain_and_nan(spark):
    df = daily(spark, 35, tx=lambda i: -1 if i == 30 else 100 + i)
    rows = {r["date"]: r for r in feature_table(df).collect()}
    # tx at index 30 is -1 → tx_log NULL → that row and its lag dependants drop
    assert dt.date(2024, 1, 31) not in rows
    assert spark.range(1).select(F.log1p(F.lit(-1.0)).alias("v")).first()["v"] is None


def test_reconstruct_null_and_negative(spark):
    s = T.StructType([T.StructField("tx_log", T.DoubleType()), T.StructField("prediction", T.DoubleType())])
    df = spark.createDataFrame([(1.0, None), (1.0, -50.0), (1.0, 0.5)], s)
    out = df.select(*reconstruct()).collect()
    assert out[0]["prediction_raw"] == 0.0 and out[0]["prediction_log"] is None
    assert out[1]["prediction_raw"] == 0.0
    assert out[2]["prediction_raw"] == pytest.approx(math.expm1(1.5))


def test_schema_errors(spark):
    d = daily(spark, 35)
    with pytest.raises(SchemaError):
        feature_table(d.withColumnRenamed("day", "when"))
    with pytest.raises(SchemaError):
        feature_table(d.select("day"))
    with pytest.raises(SchemaError):
        feature_table(d, label="no_such_metric")
    # a label outside the metric list is still selected
    ft = feature_table(d.withColumn("other", F.col("tx_count_sum") * 2), label="other")
    assert ft.count() == 6 and "other" in ft.columns


def test_empty_split_raises(spark):
    ft = feature_table(daily(spark, 40))
    with pytest.raises(EmptySplitError):
        train_and_compare(ft, "2000-01-01", "2024-02-01", "2024-12-31")


def test_price_lag_variant_has_111_features(spark):
    from fixtures import SF_SMALL
    from daycast import registry as R
    from daycast.operators.split import training_frame
    ft = feature_table(R._enriched(spark, SF_SMALL), price_lags=True)
    _, feats = training_frame(ft)
    assert len(feats) == 111
    assert {"price_ret_1d_lag3", "price_ret_7d_lag1", "price_volatility_7d_lag2"} <= set(feats)
    _, base_feats = training_frame(feature_table(R._enriched(spark, SF_SMALL)))
    assert len(base_feats) == 102
