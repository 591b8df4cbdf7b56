"""Daily price enrichment: rename, range restriction, left join, fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PRICE_COLUMNS = ["price_usd", "price_volume"]


def price_rename(raw: DataFrame, date: str = "Date", close: str = "Close",
                 volume: str = "Volume") -> DataFrame:
    """Date/Close/Volume → day/price_usd/price_volume (zone dropped by to_date)."""
    return raw.select(F.to_date(F.col(date)).alias("day"),
                      F.col(close).alias("price_usd"),
                      F.col(volume).alias("price_volume"))


def price_source(price: DataFrame, daily: DataFrame, day: str = "day") -> DataFrame:
    """Price rows inside ``[min day, max day]`` of the daily table.

    The bounds are scalar subqueries: no collect to the driver, no join."""
    lo = daily.select(F.min(day)).scalar()
    hi = daily.select(F.max(day)).scalar()
    return price.filter(F.col("day").between(lo, hi))


def price_left_join(daily: DataFrame, price: DataFrame, on: str = "day") -> DataFrame:
    """Left outer equi-join; days without a price keep NULL price columns.

    The price side is one row per day. Spark picks the join: the planner checks
    the estimated size and AQE measures the shuffled side."""
    return daily.join(price, on=on, how="left")


def ffill_bfill(df: DataFrame, cols: Sequence[str] = PRICE_COLUMNS, order: str = "day",
                series: Sequence[str] = ()) -> DataFrame:
    """Forward fill, then back fill, in row order (per series).

    The back fill only matters for a leading gap, where it equals the first
    non-null value of the series, so both fills share one window node:
    a running frame for the forward fill and a whole-partition frame
    (computed once per partition) for the leading gap."""
    base = Window.partitionBy(*series).orderBy(order)
    past = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = base.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fills = {c: F.coalesce(F.last(c, ignorenulls=True).over(past),
                           F.first(c, ignorenulls=True).over(whole))
             for c in cols if c in df.columns}
    return df.select([fills[c].alias(c) if c in fills else F.col(c) for c in df.columns])
