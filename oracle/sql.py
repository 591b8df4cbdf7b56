"""Building blocks of the DuckDB oracle queries.

Conventions shared with the Spark side (see ``__spark_entry__.py``):
every DOUBLE output column is snapped to a 2**-20 grid, BIGINT sums are cast
back from HUGEINT, ``log1p(x)`` is ``ln(1 + x)`` guarded to NULL for
``x <= -1`` (Spark's behaviour).
"""

from __future__ import annotations

TWO_PI = "6.283185307179586"

# Fixed values (must equal the reference): the metric list, the derived
# columns that get lags, and the required columns of the feature table.
METRICS = ["blocks_count", "tx_count_sum", "accumulated_fees_sum", "developer_fees_sum",
           "gas_provided_avg", "gas_refunded_avg", "gas_penalized_avg",
           "price_usd", "price_volume"]
DAILY_METRICS = METRICS[:7]
DERIVED = ["tx_log_std7", "tx_log_std14", "tx_log_z7", "tx_log_z14", "delta1", "delta7",
           "trend7", "trend14", "tx_log_rng14", "tx_log_rng28"]

TRAIN_END = "1999-12-31"
TEST_START = "2000-01-01"
TEST_END = "2001-12-31"
RANGE_START = "1996-03-01"
RANGE_END = "1998-08-31"


def log1p(x: str) -> str:
    return f"(CASE WHEN {x} > -1 THEN ln(1 + {x}) END)"


def _snap(x: str) -> str:
    return f"round_even(CAST({x} AS DOUBLE) * 1048576.0, 0) / 1048576.0"


def rounded(sql: str, doubles: list[str], lists: list[str] = ()) -> str:
    """Snap the named DOUBLE columns (and DOUBLE lists) to a 2**-20 grid,
    half-even: the same exact IEEE operations as the Spark side."""
    reps = [f"{_snap(c)} AS {c}" for c in doubles]
    reps += [f"list_transform({c}, lambda v: {_snap('v')}) AS {c}" for c in lists]
    if not reps:
        return sql
    return f"SELECT * REPLACE ({', '.join(reps)}) FROM (\n{sql}\n) AS rounded_q"


def blocks_cte(series: bool = False) -> str:
    key = ", l_returnflag AS series" if series else ""
    return f"""blocks AS (
  SELECT l_shipdate AS ts,
         CAST(l_quantity AS BIGINT) AS txCount,
         l_extendedprice * (1.0 - l_discount) AS gasProvided,
         l_discount AS gasRefunded,
         l_tax AS gasPenalized,
         CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(l_extendedprice AS VARCHAR) END AS accumulatedFees,
         l_extendedprice * l_tax AS developerFees{key}
  FROM lineitem)"""


def daily_cte(start: str | None = None, end: str | None = None, series: bool = False) -> str:
    where = ""
    if start and end:
        where = f"\n  WHERE CAST(ts AS DATE) BETWEEN DATE '{start}' AND DATE '{end}'"
    key = "series, " if series else ""
    return f"""daily AS (
  SELECT {key}CAST(ts AS DATE) AS day,
         COUNT(*) AS blocks_count,
         CAST(SUM(txCount) AS BIGINT) AS tx_count_sum,
         SUM(TRY_CAST(accumulatedFees AS DOUBLE)) AS accumulated_fees_sum,
         SUM(developerFees) AS developer_fees_sum,
         AVG(gasProvided) AS gas_provided_avg,
         AVG(gasRefunded) AS gas_refunded_avg,
         AVG(gasPenalized) AS gas_penalized_avg
  FROM blocks{where}
  GROUP BY ALL)"""


PRICE_RAW_CTE = """price_raw AS (
  SELECT CAST(o_orderdate AS DATE) AS "Date", AVG(o_totalprice) AS "Close", COUNT(*) AS "Volume"
  FROM orders GROUP BY 1)"""

PRICE_CTE = """price AS (
  SELECT CAST("Date" AS DATE) AS day, "Close" AS price_usd, "Volume" AS price_volume
  FROM price_raw)"""


def merged_cte(series: bool = False) -> str:
    part = "PARTITION BY series " if series else ""
    key = "series, " if series else ""
    fill = []
    for c in ("price_usd", "price_volume"):
        fill.append(
            f"COALESCE(LAST_VALUE(p.{c} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),\n"
            f"                  FIRST_VALUE(p.{c} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS {c}")
    return f"""merged AS (
  SELECT {key}d.day, {", ".join("d." + m for m in DAILY_METRICS)},
         {(",\n         ").join(fill)}
  FROM daily d LEFT JOIN price p ON d.day = p.day
  WINDOW w AS ({part}ORDER BY d.day))"""


def enriched_ctes(series: bool = False) -> str:
    return ",\n".join([blocks_cte(series), daily_cte(series=series), PRICE_RAW_CTE, PRICE_CTE,
                       merged_cte(series)])


def feature_ctes(src: str = "merged", series: bool = False, metrics: list[str] = METRICS,
                 x: str = "tx_count_sum") -> str:
    """CTEs f1..f4 computing every feature column from a daily table ``src``."""
    part = "PARTITION BY series " if series else ""
    key = "series, " if series else ""
    w = f"({part}ORDER BY date)"

    def fr(n: int) -> str:
        return f"({part}ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    has_price = "price_usd" in metrics
    mcols = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in metrics)
    cal = []
    for name, expr, period in (("dow", "dayofweek(date)", 7), ("doy", "dayofyear(date) - 1", 365),
                               ("month", "month(date) - 1", 12), ("woy", "weekofyear(date) - 1", 53)):
        v = f"CAST({expr} AS DOUBLE)"
        cal.append(f"sin({TWO_PI} * {v} / {period}.0) AS {name}_sin")
        cal.append(f"cos({TWO_PI} * {v} / {period}.0) AS {name}_cos")
    f0 = f"f0 AS (SELECT {key}CAST(day AS DATE) AS date, {mcols} FROM {src})"
    f1 = f"""f1 AS (
  SELECT *, {", ".join(cal)},
         CASE WHEN dayofmonth(date) = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_month_start,
         CASE WHEN date = last_day(date) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_month_end,
         {log1p(x)} AS tx_log{", " + log1p("price_usd") + " AS price_log" if has_price else ""}
  FROM f0)"""
    win = [f"CAST(date_diff('day', min(date) OVER ({part.strip()}), date) AS DOUBLE) AS t",
           f"lead({x}, 1) OVER {w} AS label"]
    for n in (7, 14, 28):
        win.append(f"avg(tx_log) OVER {fr(n)} AS tx_log_ma{n}")
    for n in (7, 14):
        win.append(f"COALESCE(stddev_samp(tx_log) OVER {fr(n)}, 0.0) AS tx_log_std{n}")
    for n in (14, 28):
        win.append(f"min(tx_log) OVER {fr(n)} AS tx_log_min{n}")
        win.append(f"max(tx_log) OVER {fr(n)} AS tx_log_max{n}")
    for k in (7, 14, 28):
        win.append(f"lag(tx_log, {k}) OVER {w} AS tx_log_lag{k}")
    for k in (1, 7):
        win.append(f"tx_log - lag(tx_log, {k}) OVER {w} AS delta{k}")
    if has_price:
        win.append(f"price_log - lag(price_log, 1) OVER {w} AS price_ret_1d")
        win.append(f"price_log - lag(price_log, 7) OVER {w} AS price_ret_7d")
        win.append(f"COALESCE(stddev_samp(price_log) OVER {fr(7)}, 0.0) AS price_volatility_7d")
    for m in metrics:
        for k in (1, 2, 3):
            win.append(f"lag({m}, {k}) OVER {w} AS {m}_lag{k}")
    f2 = "f2 AS (\n  SELECT *,\n         " + ",\n         ".join(win) + "\n  FROM f1)"
    f3 = f"""f3 AS (
  SELECT *, {log1p("label")} AS label_log,
         CASE WHEN tx_log_std7 > 0.0 THEN (tx_log - tx_log_ma7) / tx_log_std7 ELSE 0.0 END AS tx_log_z7,
         CASE WHEN tx_log_std14 > 0.0 THEN (tx_log - tx_log_ma14) / tx_log_std14 ELSE 0.0 END AS tx_log_z14,
         tx_log_max14 - tx_log_min14 AS tx_log_rng14,
         tx_log_max28 - tx_log_min28 AS tx_log_rng28,
         tx_log_ma7 - lag(tx_log_ma7, 7) OVER {w} AS trend7,
         tx_log_ma14 - lag(tx_log_ma14, 14) OVER {w} AS trend14,
         CASE WHEN tx_log_ma7 > tx_log_ma28 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS regime_up
  FROM f2)"""
    dl = [f"lag({m}, {k}) OVER {w} AS {m}_lag{k}" for m in DERIVED for k in (1, 2, 3)]
    f4 = "f4 AS (\n  SELECT *,\n         " + ",\n         ".join(dl) + "\n  FROM f3)"
    return ",\n".join([f0, f1, f2, f3, f4])


MUST_HAVE = ["label", "label_log", "tx_log", "tx_log_ma7", "tx_log_ma14", "tx_log_ma28",
             "tx_log_std7", "tx_log_std14", "tx_log_z7", "tx_log_z14",
             "tx_log_min14", "tx_log_max14", "tx_log_rng14", "tx_log_min28", "tx_log_max28",
             "tx_log_rng28", "trend7", "trend14", "regime_up",
             "tx_log_lag7", "tx_log_lag14", "tx_log_lag28", "delta1", "delta7",
             "dow_sin", "dow_cos", "doy_sin", "doy_cos", "month_sin", "month_cos",
             "woy_sin", "woy_cos", "is_month_start", "is_month_end", "t"]


def feature_columns(metrics: list[str] = METRICS) -> list[str]:
    cols = list(metrics) + ["t", "label", "dow_sin", "dow_cos", "doy_sin", "doy_cos",
                            "month_sin", "month_cos", "woy_sin", "woy_cos",
                            "is_month_start", "is_month_end", "tx_log", "label_log",
                            "tx_log_ma7", "tx_log_ma14", "tx_log_ma28", "tx_log_std7",
                            "tx_log_std14", "tx_log_z7", "tx_log_z14", "tx_log_min14",
                            "tx_log_max14", "tx_log_rng14", "tx_log_min28", "tx_log_max28",
                            "tx_log_rng28", "trend7", "trend14", "regime_up", "tx_log_lag7",
                            "tx_log_lag14", "tx_log_lag28", "delta1", "delta7"]
    if "price_usd" in metrics:
        cols += ["price_log", "price_ret_1d", "price_ret_7d", "price_volatility_7d"]
    cols += [f"{m}_lag{k}" for m in metrics for k in (1, 2, 3)]
    cols += [f"{m}_lag{k}" for m in DERIVED for k in (1, 2, 3)]
    return cols


def must_have(metrics: list[str] = METRICS) -> list[str]:
    return MUST_HAVE + [f"{m}_lag{k}" for m in metrics for k in (1, 2, 3)] + \
        [f"{m}_lag{k}" for m in DERIVED for k in (1, 2, 3)]


def complete_filter(metrics: list[str] = METRICS) -> str:
    return " AND ".join(f"({c} IS NOT NULL AND NOT isnan({c}))" for c in must_have(metrics))


def features_cte(series: bool = False, metrics: list[str] = METRICS, src: str = "merged") -> str:
    """``features`` = the complete-row feature table (date [, series] + features)."""
    key = "series, " if series else ""
    cols = ", ".join(feature_columns(metrics))
    return (feature_ctes(src, series, metrics) +
            f",\nfeatures AS (\n  SELECT date, {key}{cols}\n  FROM f4\n  WHERE {complete_filter(metrics)})")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
