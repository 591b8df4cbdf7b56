"""The refreshed daily table equals the full build, version by version."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daycast.plans.enriched import enriched_daily
from daycast.plans.store import DailyStore

RAW = ("timestamp timestamp_ntz, txCount long, accumulatedFees string, developerFees double, gasProvided double, "
       "gasRefunded double, gasPenalized double, series string")


def raw_rows(spark, days=90, first=dt.date(2024, 1, 1), seed=1, per_day=3):
    r = random.Random(seed)
    rows = []
    for i in range(days):
        for _ in range(per_day):
            at = dt.datetime.combine(first + dt.timedelta(days=i), dt.time(r.randrange(24)))
            rows.append((at, r.choice([None, 1, 5, 9]), r.choice(["1.5", "n/a", None, "2"]), r.choice([None, 0.25]),
                         float(r.randrange(9)), r.random(), None, r.choice(["a", "b", None])))
    return spark.createDataFrame(rows, RAW)


def prices(spark, first=dt.date(2024, 2, 15), days=20, last=None):
    rows = [(first + dt.timedelta(days=2 * i), 10.0 + i, float(i) if i % 3 else None) for i in range(days)]
    return spark.createDataFrame(rows, "Date date, Close double, Volume double")


def same(got, want, series):
    key = [*series, "day"]
    a, b = ([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.select(want.columns).orderBy(*key).collect()]
            for d in (got, want))
    assert a == b and a


@pytest.mark.parametrize("series", [[], ["series"]])
def test_leading_price_gap_across_a_refresh(spark, tmp_path, series):
    """90 days, the first price on day 46, stored up to day 31."""
    raw, price = raw_rows(spark), prices(spark)
    store = DailyStore(spark, str(tmp_path / "s"), series)
    store.replace_from(raw.where("timestamp < '2024-02-01'"), price)
    assert store.read().where("price_usd IS NOT NULL").count() == 0
    store.replace_from(raw, price, "2024-02-01")
    whole = enriched_daily(raw, price, series=series)
    same(store.read(), whole, series)
    assert store.read().where("price_usd IS NULL").count() == 0
    for since in ("2024-02-01", "2024-02-20", "2024-03-10"):
        same(store.read(since), whole.where(F.col("day") >= since), series)


@pytest.mark.parametrize("since", ["2024-02-10", "2024-02-01"])
def test_fewer_raw_days_than_stored(spark, tmp_path, since):
    """Stored to 31 March, refreshed with raw days to 28 February: March goes."""
    raw, price = raw_rows(spark, 91), prices(spark)
    store = DailyStore(spark, str(tmp_path / "s"))
    store.replace_from(raw, price)
    less = raw.where("timestamp < '2024-02-29'")
    store.replace_from(less, price, since)
    same(store.read(), enriched_daily(less, price), [])
    assert str(store.read().agg(F.max("day")).first()[0]) == "2024-02-28"
    same(store.read(version=1), enriched_daily(raw, price), [])  # the version before is still whole


@pytest.mark.parametrize("series", [[], ["series"]])
def test_late_rows_are_added(spark, tmp_path, series):
    raw, price = raw_rows(spark, 60), prices(spark)
    late = raw_rows(spark, 40, dt.date(2024, 1, 10), seed=9, per_day=1)
    more = raw_rows(spark, 20, dt.date(2024, 3, 5), seed=5)
    store = DailyStore(spark, str(tmp_path / "s"), series)
    store.add_rows(raw, price)
    before = store._manifest()["months"]
    store.add_rows(late, price)
    store.add_rows(more, price)
    store.add_rows(more.limit(0), price)
    after = store._manifest()["months"]
    assert sorted(after) == ["2024-01", "2024-02", "2024-03"] and after["2024-03"] != after["2024-01"] != before["2024-01"]
    same(store.read(), enriched_daily(raw.unionAll(late).unionAll(more), price, series=series), series)
    assert store.versions() == [1, 2, 3]


def test_versions_and_failures(spark, tmp_path):
    raw, price = raw_rows(spark, 40), prices(spark)
    store = DailyStore(spark, str(tmp_path / "s"))
    with pytest.raises(FileNotFoundError):
        store.read()
    store.replace_from(raw, price)
    held = store.read().orderBy("day").collect()
    broken = raw.withColumn("gasRefunded", F.when(F.col("timestamp") > "2024-02-05", F.raise_error(F.lit("lost"))).otherwise(F.col("gasRefunded")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        store.replace_from(broken, price, "2024-02-01")
    assert store.read().orderBy("day").collect() == held
    base = store._manifest()
    state = store._state(base)
    store._commit(base, state)
    with pytest.raises(FileExistsError):
        store._commit(base, state)  # the other refresh won
    assert store.versions() == [1, 2]
    no_price = DailyStore(spark, str(tmp_path / "n"))
    no_price.replace_from(raw)
    same(no_price.read(), enriched_daily(raw, None), [])


def test_refresh_reads_from_its_first_day_on(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_rows(spark, 60).write.parquet(path)
    from daycast.plans.store import daily_state
    plan = daily_state(spark.read.parquet(path), "2024-02-10")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp,2024-02-10" in plan
