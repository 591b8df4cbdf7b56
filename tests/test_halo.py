"""The bucketed (halo) window mode and the carried fill equal the plain forms."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.operators.enrich import ffill_bfill
from daycast.plans.features import feature_table
from daycast.plans.halo import ffill_bfill_bucketed, row_index

SETTINGS = settings(max_examples=4, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
SCHEMA = T.StructType([T.StructField("series", T.StringType()), T.StructField("day", T.DateType()),
                       T.StructField("tx_count_sum", T.LongType()),
                       T.StructField("price_usd", T.DoubleType())])


def _table(spark, spec):
    """spec: list of (series, n_days, gap_every, null_every)."""
    rows = []
    for key, n, gap, nul in spec:
        day = dt.date(2022, 1, 1)
        for i in range(n):
            day += dt.timedelta(days=2 if gap and i % gap == 0 else 1)
            price = None if nul and (i % nul == 0 or i < 3) else float(10 + i % 17)
            rows.append((key, day, 50 + (i * 7919) % 500, price))
    return spark.createDataFrame(rows, SCHEMA)


spec = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(35, 160),
                          st.integers(0, 9), st.integers(0, 5)),
                min_size=1, max_size=3, unique_by=lambda t: t[0])


@SETTINGS
@given(spec, st.integers(32, 70))
def test_bucketed_features_equal_plain(spark, spec, bucket_rows):
    df = ffill_bfill(_table(spark, spec), ["price_usd"], series=["series"])
    plain = feature_table(df, series=["series"])
    halo = feature_table(df, series=["series"], bucket_rows=bucket_rows, block_days=8)
    assert halo.columns == plain.columns
    assert halo.count() == plain.count()
    assert halo.exceptAll(plain).count() == 0


@SETTINGS
@given(spec, st.integers(2, 20))
def test_bucketed_fill_equals_plain(spark, spec, block_days):
    df = _table(spark, spec)
    a = ffill_bfill(df, ["price_usd"], series=["series"])
    b = ffill_bfill_bucketed(df, ["price_usd"], series=["series"], block_days=block_days)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_row_index_is_dense_per_series(spark):
    df = _table(spark, [("a", 100, 3, 0), ("b", 40, 0, 0)]).withColumnRenamed("day", "date")
    idx = row_index(df, ["series"], block_days=7)
    for key, n in (("a", 100), ("b", 40)):
        got = [r["_idx"] for r in idx.filter(F.col("series") == key).orderBy("date").collect()]
        assert got == list(range(n))


@SETTINGS
@given(spec, st.integers(0, 150))
def test_since_equals_full_filtered(spark, spec, offset):
    df = ffill_bfill(_table(spark, spec), ["price_usd"], series=["series"])
    since = (dt.date(2022, 1, 1) + dt.timedelta(days=offset)).isoformat()
    full = feature_table(df, series=["series"]).filter(F.col("date") >= since)
    part = feature_table(df, series=["series"], since=since)
    assert part.columns == full.columns
    assert part.exceptAll(full).count() == 0 and full.exceptAll(part).count() == 0
    one = df.filter(F.col("series") == spec[0][0]).drop("series")
    assert (feature_table(one, since=since)
            .exceptAll(feature_table(one).filter(F.col("date") >= since)).count() == 0)
