"""Property checks of the feature table on generated daily series."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daycast.plans.features import feature_table
from fixtures import DAILY_SCHEMA

SETTINGS = settings(max_examples=4, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, values, key=None):
    start = dt.date(2023, 3, 1)
    rows = [(start + dt.timedelta(days=i), 5 + i % 3, v, 0.25 + (i % 5) / 10) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, DAILY_SCHEMA)
    return df.withColumn("series", F.lit(key)) if key else df


series_values = st.lists(st.integers(min_value=1, max_value=10_000), min_size=31, max_size=70)


@SETTINGS
@given(series_values)
def test_row_count_and_bounds(spark, values):
    rows = feature_table(_frame(spark, values)).collect()
    assert len(rows) == len(values) - 29                 # rows 0..27 and the last one drop
    for r in rows:
        assert r["tx_log_min14"] - 1e-12 <= r["tx_log_ma14"] <= r["tx_log_max14"] + 1e-12
        assert r["tx_log_min28"] - 1e-12 <= r["tx_log_ma28"] <= r["tx_log_max28"] + 1e-12
        for p in ("dow", "doy", "month", "woy"):
            assert math.isclose(r[f"{p}_sin"] ** 2 + r[f"{p}_cos"] ** 2, 1.0, rel_tol=1e-12)
        assert math.isclose(r["label_log"], math.log1p(r["label"]), rel_tol=1e-14)


@SETTINGS
@given(series_values, st.integers(min_value=1, max_value=5))
def test_no_look_ahead_beyond_label(spark, values, cut):
    """Changing rows after i + 1 never changes row i."""
    changed = values[:-cut] + [v * 3 + 7 for v in values[-cut:]]
    a = {r["date"]: r for r in feature_table(_frame(spark, values)).collect()}
    b = {r["date"]: r for r in feature_table(_frame(spark, changed)).collect()}
    last_safe = dt.date(2023, 3, 1) + dt.timedelta(days=len(values) - cut - 2)
    for d, r in a.items():
        if d <= last_safe:
            assert b[d].asDict() == r.asDict()


@SETTINGS
@given(series_values, series_values)
def test_keyed_equals_single(spark, v1, v2):
    keyed = feature_table(_frame(spark, v1, "a").unionByName(_frame(spark, v2, "b")), series=["series"])
    for key, vals in (("a", v1), ("b", v2)):
        single = {r["date"]: r.asDict() for r in feature_table(_frame(spark, vals)).collect()}
        got = {r["date"]: {k: v for k, v in r.asDict().items() if k != "series"}
               for r in keyed.filter(F.col("series") == key).collect()}
        assert got == single
