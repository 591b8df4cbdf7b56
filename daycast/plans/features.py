"""E1 — the feature table: metrics → calendar, rolling, lag, delta and trend
features, built as four select levels over one ordered window.

Scale: the input is the *daily* table (one row per day per series, see
``daily_rollup``), so a window partition holds at most one row per calendar
day of its series — about 3.7 k rows for ten years, whatever the size of the
raw data behind it.  Series are window partitions (``PARTITION BY series``),
so keyed tables spread over all tasks.  The three Window operators share one
hash exchange and one sort.

Each level is one ``selectExpr`` of SQL expression strings: the plan for
~200 columns is handed to the JVM in a handful of calls."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from daycast.functions.calendar import (CALENDAR_FEATURES, calendar_exprs,
                                        month_edge_exprs, time_index_expr)
from daycast.functions.casting import decimal_to_double
from daycast.operators import windows as W
from daycast.operators.schema import (available_metrics, first_existing,
                                      DATE_CANDIDATES, missing_date, resolve_label)
from daycast.operators.windows import Win, q

# Fixed values (must equal the reference): the required (non-null) columns
# besides the metric and derived lags.
MUST_HAVE_BASE = [
    "label", "label_log",
    "tx_log", "tx_log_ma7", "tx_log_ma14", "tx_log_ma28",
    "tx_log_std7", "tx_log_std14",
    "tx_log_z7", "tx_log_z14",
    "tx_log_min14", "tx_log_max14", "tx_log_rng14",
    "tx_log_min28", "tx_log_max28", "tx_log_rng28",
    "trend7", "trend14", "regime_up",
    "tx_log_lag7", "tx_log_lag14", "tx_log_lag28",
    "delta1", "delta7",
    "dow_sin", "dow_cos",
    "doy_sin", "doy_cos",
    "month_sin", "month_cos",
    "woy_sin", "woy_cos",
    "is_month_start", "is_month_end",
    "t",
]
DUPLICATE_DATE = "two rows for one date; do the inputs overlap?"
# Largest look-back of any feature in rows (trend14_lag3 = 3 + 14 + 13) and
# the look-ahead (label).
LOOK_BACK = 30
LOOK_AHEAD = 1

_ROLLING = ["tx_log_ma7", "tx_log_ma14", "tx_log_ma28", "tx_log_std7", "tx_log_std14",
            "tx_log_z7", "tx_log_z14", "tx_log_min14", "tx_log_max14", "tx_log_rng14",
            "tx_log_min28", "tx_log_max28", "tx_log_rng28", "trend7", "trend14", "regime_up",
            "tx_log_lag7", "tx_log_lag14", "tx_log_lag28", "delta1", "delta7"]


def prepare_daily(daily: DataFrame, label: str = "tx_count",
                  series: Sequence[str] = ()) -> tuple[DataFrame, list[str], str]:
    """P3 + P4 + P5 + P6: decimals to double, resolve ``date``, metrics and
    label, in one projection.  Returns (base table, metrics, resolved label)."""
    df = decimal_to_double(daily)
    cols = df.columns
    src = first_existing(cols, DATE_CANDIDATES)
    if src is None:
        raise missing_date(cols)
    metrics = available_metrics(cols)
    x = resolve_label(label, cols)
    keep = metrics + ([x] if x not in metrics else [])
    base = df.selectExpr(*[q(s) for s in series], f"to_date({q(src)}) AS `date`",
                         *[f"CAST({q(c)} AS DOUBLE) AS {q(c)}" for c in keep])
    return base, metrics, x


def must_have(metrics: Sequence[str], price_lags: bool = False, has_price: bool = False) -> list[str]:
    cols = list(MUST_HAVE_BASE)
    cols += [f"{m}_lag{k}" for m in metrics for k in range(1, W.N_LAGS + 1)]
    cols += [f"{m}_lag{k}" for m in W.DERIVED_TX for k in range(1, W.N_LAGS + 1)]
    if price_lags and has_price:
        cols += [f"{m}_lag{k}" for m in W.PRICE_DERIVED[1:] for k in range(1, W.N_LAGS + 1)]
    return cols


def feature_levels(base: DataFrame, metrics: Sequence[str], x: str, w: Win,
                   keys: Sequence[str] = (), first_date: str | None = None,
                   price_lags: bool = False) -> DataFrame:
    """All feature columns, unfiltered.  ``keys`` are carried through.
    ``first_date``: SQL expression of the series' first date (default: a
    running minimum over the window, i.e. the first row)."""
    has_price = "price_usd" in base.columns
    carry = [q(k) for k in keys]
    metric_cols = [q(m) for m in metrics] + ([] if x in metrics else [q(x)])

    # level 1 — projections only
    l1 = base.selectExpr(
        *carry, "`date`", *metric_cols, *calendar_exprs("date"), *month_edge_exprs("date"),
        f"log1p({q(x)}) AS `tx_log`",
        *(["log1p(`price_usd`) AS `price_log`"] if has_price else []))

    # level 2 — one Window operator: label, t, rolling stats, lags, deltas
    first = first_date or f"min(`date`) {w.running()}"
    # rows of one date would make every row-based lag ambiguous; ``t`` is required, so this always runs
    twice = (f"CASE WHEN lag(`date`) {w.over()} = `date` THEN raise_error(concat('{DUPLICATE_DATE} ', "
             "CAST(`date` AS STRING)))")
    index = time_index_expr("date", first).removesuffix(" AS `t`")
    l2 = l1.selectExpr(
        *carry, "`date`", *metric_cols,
        f"{twice} ELSE {index} END AS `t`", W.lead_label(x, w),
        *[q(c) for c in CALENDAR_FEATURES], "`is_month_start`", "`is_month_end`", "`tx_log`",
        *W.rolling_mean("tx_log", w), *W.rolling_std("tx_log", w),
        *W.rolling_min_max("tx_log", w), *W.long_lags("tx_log", w), *W.deltas("tx_log", w),
        *(["`price_log`", *W.price_returns(w), W.price_volatility(w)] if has_price else []),
        *W.lags(metrics, w))

    # level 3 — projections on level-2 results + trend (lag of a window result)
    l3 = l2.selectExpr(
        "*", "log1p(`label`) AS `label_log`",
        *W.rolling_zscore("tx_log"), *W.rolling_range("tx_log"),
        *W.trend("tx_log", w), W.regime_flag("tx_log"))

    # level 4 — lags of derived columns
    derived = list(W.DERIVED_TX)
    if price_lags and has_price:
        derived += W.PRICE_DERIVED[1:]
    return l3.selectExpr("*", *W.lags(derived, w))


def output_order(cols: Sequence[str], metrics: Sequence[str], x: str,
                 series: Sequence[str] = ()) -> list[str]:
    """Column order of the feature table (creation order of the reference)."""
    has = set(cols)
    order = ["date", *series, *metrics]
    if x not in metrics:
        order.append(x)
    order += ["t", "label", *CALENDAR_FEATURES, "is_month_start", "is_month_end",
              "tx_log", "label_log", *_ROLLING]
    order += [c for c in W.PRICE_DERIVED if c in has]
    seen = set(order)
    order += [c for c in cols if c not in seen]
    return order


def finalize(levels: DataFrame, required: Sequence[str], order: Sequence[str],
             extra_filter: str | None = None) -> DataFrame:
    """P7 + P8 + P9: NaN → NULL on the required columns, drop incomplete
    rows, reference column order (raw calendar helpers never exist)."""
    req = set(required)
    cond = " AND ".join(f"{q(c)} IS NOT NULL" for c in required)
    if extra_filter:
        cond = f"({cond}) AND ({extra_filter})"
    out = levels.selectExpr(*[f"CASE WHEN isnan({q(c)}) THEN NULL ELSE {q(c)} END AS {q(c)}"
                              if c in req else q(c) for c in levels.columns]).filter(cond)
    return out if list(order) == out.columns else out.selectExpr(*[q(c) for c in order])


_HALO_KEYS = ["_bucket", "_own", "_first_date"]


def since_rows(base: DataFrame, series: Sequence[str], since: str, block_days: int = 32) -> DataFrame:
    """Rows needed for features dated ``>= since``: per series, every row from
    ``LOOK_BACK`` rows before the first such date on (exact row count, from
    the block-count row index — no whole-series window).  Adds
    ``_first_date`` (first date of the whole series, for ``t``)."""
    from pyspark.sql import functions as F
    from daycast.plans.halo import row_index
    series = list(series)
    idx = row_index(base, series, "date", block_days)
    recent = idx.filter(F.col("date") >= F.lit(since).cast("date"))
    if not series:  # one series: its start index is a scalar subquery
        start = recent.select(F.min("_idx")).scalar()
        return idx.filter(F.col("_idx") >= start - LOOK_BACK).drop("_idx")
    start = recent.groupBy(*series).agg(F.min("_idx").alias("_start"))  # one row per series
    return (idx.join(start, series)
               .filter(F.col("_idx") >= F.col("_start") - LOOK_BACK).drop("_idx", "_start"))


def feature_table(daily: DataFrame, label: str = "tx_count", series: Sequence[str] = (),
                  price_lags: bool = False, bucket_rows: int | None = None,
                  block_days: int = 32, since: str | None = None) -> DataFrame:
    """E1 — the 106-column feature table (date, label, label_log, tx_log +
    102 features when all nine metrics are present).

    ``series``: optional key columns; every window is then per series.
    ``price_lags``: also lag the three price derivatives (older variant,
    111 features).
    ``bucket_rows``: split every series into buckets of this many rows with
    a look-back/look-ahead halo (see :mod:`daycast.plans.halo`) — same result,
    no series in one window partition; for series longer than one task
    should hold.
    ``since``: only rows dated on or after it; the window runs over those rows
    plus their 30-row look-back.  Equal to the full table filtered to
    ``date >= since`` (the input must already be filled, and ``t`` still counts
    from the series' first date).  With a stored daily table as input
    (:class:`daycast.plans.store.DailyStore`) no old raw data is read.

    A (series, date) that occurs twice raises when the rows are computed."""
    series = list(series)
    base, metrics, x = prepare_daily(daily, label, series)
    required = must_have(metrics, price_lags, "price_usd" in base.columns)
    if since is not None:
        if bucket_rows is not None:
            raise ValueError("since and bucket_rows do not combine")
        since = _dt.date.fromisoformat(str(since)).isoformat()
        # the index step reads its input three times (counts, rows, start)
        pruned = since_rows(base, series, since, block_days)
        levels = feature_levels(pruned, metrics, x, W.ordered_window(series),
                                keys=series + ["_first_date"], first_date="`_first_date`",
                                price_lags=price_lags)
        order = [c for c in output_order(levels.columns, metrics, x, series) if c != "_first_date"]
        return finalize(levels, required, order, extra_filter=f"`date` >= DATE'{since}'")
    if bucket_rows is None:
        levels = feature_levels(base, metrics, x, W.ordered_window(series), keys=series,
                                price_lags=price_lags)
        return finalize(levels, required, output_order(levels.columns, metrics, x, series))
    from daycast.plans.halo import halo_buckets, row_index
    from daycast.session import cut_lineage
    # the index step reads its input twice (block counts, then the rows)
    base = cut_lineage(base)
    halo = halo_buckets(row_index(base, series, "date", block_days), bucket_rows, LOOK_BACK, LOOK_AHEAD)
    levels = feature_levels(halo, metrics, x, W.ordered_window(series + ["_bucket"]),
                            keys=series + _HALO_KEYS, first_date="`_first_date`", price_lags=price_lags)
    order = [c for c in output_order(levels.columns, metrics, x, series) if c not in _HALO_KEYS]
    return finalize(levels, required, order, extra_filter="`_own`")
