"""E2 — blocks → daily roll-up → price range → left join → fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from daycast.operators.enrich import ffill_bfill, price_left_join, price_rename
from daycast.operators.rollup import daily_rollup


def enriched_daily(blocks: DataFrame, price_raw: DataFrame | None,
                   start: str | None = None, end: str | None = None,
                   series: Sequence[str] = (), ts: str = "timestamp",
                   price_columns: tuple[str, str, str] = ("Date", "Close", "Volume"),
                   fill_block_days: int | None = None) -> DataFrame:
    """Daily metrics with ``price_usd``/``price_volume`` attached and filled.

    Without a price table the daily roll-up is returned as it is (the
    feature stage then leaves the price features out).  ``fill_block_days``
    switches the fill to the bucketed carry form (no series in one window
    partition; same result)."""
    daily = daily_rollup(blocks, start, end, series=series, ts=ts)
    if price_raw is None:
        return daily
    # The left join already keeps only days of the daily table, so the
    # explicit range restriction (price_source) would only add a second scan.
    merged = price_left_join(daily, price_rename(price_raw, *price_columns), on="day")
    if fill_block_days:
        from daycast.plans.halo import ffill_bfill_bucketed
        from daycast.session import cut_lineage
        # the carry step reads the merged table twice (block stats, rows)
        return ffill_bfill_bucketed(cut_lineage(merged), ["price_usd", "price_volume"], order="day",
                                    series=series, block_days=fill_block_days)
    return ffill_bfill(merged, order="day", series=series)
