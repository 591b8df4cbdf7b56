"""Oracle SQL per query key (DuckDB dialect, driver views as tables).

Keys that fit Spark ML models (or return maps) have no entry: the driver
then checks row counts only."""

from __future__ import annotations

from oracle import sql as S

ORACLES: dict[str, str] = {}

TRAIN_END, TEST_START, TEST_END = S.TRAIN_END, S.TEST_START, S.TEST_END
RANGE_START, RANGE_END = S.RANGE_START, S.RANGE_END
MULTI_CUT = "1998-12-31"
SAMPLE_ROWS = 500


def add(name: str, sql: str, doubles: list[str] = (), lists: list[str] = ()) -> None:
    ORACLES[name] = S.rounded(sql, list(doubles), list(lists))


DAILY_DOUBLES = ["accumulated_fees_sum", "developer_fees_sum", "gas_provided_avg",
                 "gas_refunded_avg", "gas_penalized_avg"]
FEATURES = S.feature_columns()
SORTED_FEATURES = sorted(c for c in FEATURES if c not in ("label", "label_log", "tx_log"))
LEAD = ["date", "label", "label_log", "tx_log", "label_diff"]

ENR = S.enriched_ctes()
FEAT = S.features_cte()
FRAME = f"""frame AS (
  SELECT {", ".join(LEAD + SORTED_FEATURES)} FROM (
    SELECT *, label_log - tx_log AS label_diff FROM features)
  WHERE {" AND ".join(f"({c} IS NOT NULL AND NOT isnan({c}))" for c in LEAD[1:] + SORTED_FEATURES)}),
train AS (SELECT * FROM frame WHERE date <= DATE '{TRAIN_END}'),
test AS (SELECT * FROM frame WHERE date BETWEEN DATE '{TEST_START}' AND DATE '{TEST_END}')"""
PRED = """pred AS (
  SELECT date, label, label_log, tx_log, label_diff, 'persistence' AS model, 0.0::DOUBLE AS prediction FROM test
  UNION ALL
  SELECT date, label, label_log, tx_log, label_diff, 'drift' AS model,
         (SELECT avg(label_diff) FROM train) AS prediction FROM test),
scored AS (
  SELECT *, tx_log + prediction AS prediction_log,
         exp(greatest(tx_log + prediction, 0.0)) - 1 AS prediction_raw
  FROM pred)"""
COMP = """comparison AS (
  SELECT model,
         sqrt(avg(power(label_log - prediction_log, 2))) AS rmse_log,
         1 - sum(power(label_log - prediction_log, 2)) / (var_pop(label_log) * count(*)) AS r2_log,
         sqrt(avg(power(label - prediction_raw, 2))) AS rmse_raw,
         1 - sum(power(label - prediction_raw, 2)) / (var_pop(label) * count(*)) AS r2_raw
  FROM scored GROUP BY model)"""
LONG = """long AS (
  SELECT model, 'log' AS space, date, label_log AS real, prediction_log AS predicted FROM scored
  UNION ALL
  SELECT model, 'raw' AS space, date, label AS real, prediction_raw AS predicted FROM scored)"""
LEVELS = S.feature_ctes("merged")

BASE = S.with_(ENR, FEAT, FRAME, PRED)
BASE_COMP = S.with_(ENR, FEAT, FRAME, PRED, COMP)
BASE_LONG = S.with_(ENR, FEAT, FRAME, PRED, LONG)
BLOCK_DOUBLES = ["gasProvided", "gasRefunded", "gasPenalized", "developerFees"]

# --- 2.1 scans, sources, sinks ---------------------------------------------

add("scan_range", S.with_(S.blocks_cte()) + f"""
SELECT ts AS "timestamp", txCount, gasProvided, gasRefunded, gasPenalized, accumulatedFees, developerFees
FROM blocks WHERE CAST(ts AS DATE) BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'""", BLOCK_DOUBLES)

add("month_partitioned", S.with_(S.blocks_cte(), S.daily_cte()) + f""",
part AS (SELECT * FROM daily WHERE day BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'),
bounds AS (SELECT min(day) AS lo, max(day) AS hi FROM part),
months AS (
  SELECT strftime(CAST(m AS DATE), '%Y-%m') AS year_month,
         greatest(CAST(m AS DATE), lo) AS range_start,
         least(last_day(CAST(m AS DATE)), hi) AS range_end
  FROM bounds, unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS g(m)),
counts AS (
  SELECT strftime(day, '%Y-%m') AS year_month, CAST(sum(blocks_count) AS BIGINT) AS blocks, count(*) AS days
  FROM part GROUP BY 1)
SELECT m.year_month, m.range_start, m.range_end, c.blocks, c.days
FROM months m LEFT JOIN counts c ON m.year_month = c.year_month""")

add("multi_read", S.with_(ENR) + f"""
SELECT * FROM merged WHERE day <= DATE '{MULTI_CUT}'
UNION ALL BY NAME
SELECT * FROM daily WHERE day > DATE '{MULTI_CUT}'""", DAILY_DOUBLES + ["price_usd"])

add("price_source", S.with_(ENR) + """
SELECT * FROM price
WHERE day BETWEEN (SELECT min(day) FROM daily) AND (SELECT max(day) FROM daily)""", ["price_usd"])

add("features_sink", S.with_(ENR, FEAT) + "SELECT * FROM features", FEATURES)
add("features_scan", S.with_(ENR, FEAT) + "SELECT * FROM features", FEATURES)

add("metrics_summary", S.with_(ENR, FEAT, FRAME, PRED, COMP) + f"""
SELECT '{TEST_START}' AS start, '{TEST_END}' AS "end", model, metric, value
FROM comparison UNPIVOT (value FOR metric IN (rmse_log, r2_log, rmse_raw, r2_raw))""", ["value"])

# --- 2.2 projections, filters, cleaning --------------------------------------

add("safe_cast", S.with_(S.blocks_cte()) +
    'SELECT ts AS "timestamp", TRY_CAST(accumulatedFees AS DOUBLE) AS accumulated_fees FROM blocks',
    ["accumulated_fees"])

add("raw_projection", S.with_(S.blocks_cte()) + f"""
SELECT ts AS "timestamp", txCount, TRY_CAST(gasProvided AS DOUBLE) AS gasProvided,
       TRY_CAST(gasRefunded AS DOUBLE) AS gasRefunded, TRY_CAST(gasPenalized AS DOUBLE) AS gasPenalized,
       TRY_CAST(accumulatedFees AS DOUBLE) AS accumulatedFees, TRY_CAST(developerFees AS DOUBLE) AS developerFees
FROM blocks WHERE CAST(ts AS DATE) BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'
ORDER BY ts""", BLOCK_DOUBLES + ["accumulatedFees"])

add("decimal_to_double", """
SELECT l_shipdate, l_quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS l_extendedprice,
       CAST(CAST(l_discount AS DECIMAL(4,2)) AS DOUBLE) AS l_discount
FROM lineitem""", ["l_quantity", "l_extendedprice", "l_discount"])

add("ensure_date", S.with_(S.blocks_cte(), S.daily_cte()) + "SELECT *, day AS date FROM daily",
    DAILY_DOUBLES)

add("select_metrics", S.with_(ENR) + "SELECT day AS date, " +
    ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in S.METRICS) + " FROM merged", S.METRICS)

add("resolve_label", S.with_(S.blocks_cte(), S.daily_cte()) +
    "SELECT day AS date, 'tx_count_sum' AS label_metric, CAST(tx_count_sum AS DOUBLE) AS label_value FROM daily",
    ["label_value"])

DIRTY = """dirty AS (
  SELECT l_shipdate AS "timestamp",
         TRY_CAST(CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(l_extendedprice AS VARCHAR) END AS DOUBLE) AS fee,
         TRY_CAST(CASE WHEN l_linenumber = 4 THEN 'NaN' ELSE CAST(l_tax AS VARCHAR) END AS DOUBLE) AS gas
  FROM lineitem)"""
add("nan_to_null", S.with_(DIRTY) +
    "SELECT \"timestamp\", fee, CASE WHEN isnan(gas) THEN NULL ELSE gas END AS gas FROM dirty", ["fee", "gas"])
add("drop_incomplete", S.with_(DIRTY) +
    "SELECT * FROM dirty WHERE fee IS NOT NULL AND NOT isnan(fee) AND gas IS NOT NULL AND NOT isnan(gas)",
    ["fee", "gas"])

CAL = ", ".join(
    f"sin({S.TWO_PI} * CAST({e} AS DOUBLE) / {p}.0) AS {n}_sin, cos({S.TWO_PI} * CAST({e} AS DOUBLE) / {p}.0) AS {n}_cos"
    for n, e, p in (("dow", "dayofweek(day)", 7), ("doy", "dayofyear(day) - 1", 365),
                    ("month", "month(day) - 1", 12), ("woy", "weekofyear(day) - 1", 53)))
CAL_COLS = ["dow_sin", "dow_cos", "doy_sin", "doy_cos", "month_sin", "month_cos", "woy_sin", "woy_cos"]
add("drop_helpers", S.with_(S.blocks_cte(), S.daily_cte()) + f"SELECT *, day AS date, {CAL} FROM daily",
    DAILY_DOUBLES + CAL_COLS)

add("price_rename", S.with_(S.PRICE_RAW_CTE, S.PRICE_CTE) + "SELECT * FROM price", ["price_usd"])

add("time_split", S.with_(ENR, FEAT, FRAME) + """
SELECT 'train' AS split, date, label, label_log, tx_log FROM train
UNION ALL
SELECT 'test' AS split, date, label, label_log, tx_log FROM test""", ["label", "label_log", "tx_log"])

add("feature_columns", S.with_(ENR, FEAT, FRAME) + "SELECT * FROM frame", LEAD[1:] + SORTED_FEATURES)

add("label_diff", S.with_(ENR, FEAT) +
    "SELECT date, label_log, tx_log, label_log - tx_log AS label_diff FROM features",
    ["label_log", "tx_log", "label_diff"])

_NP = S.DAILY_METRICS
add("optional_price_features",
    S.with_(S.blocks_cte(), S.daily_cte(), S.features_cte(metrics=_NP, src="daily")) + "SELECT * FROM features",
    S.feature_columns(_NP))

# --- 2.3 join ------------------------------------------------------------------

add("price_left_join", S.with_(ENR) +
    "SELECT d.*, p.price_usd, p.price_volume FROM daily d LEFT JOIN price p ON d.day = p.day",
    DAILY_DOUBLES + ["price_usd"])

# --- 2.4 aggregations ------------------------------------------------------------

add("daily_rollup", S.with_(S.blocks_cte(), S.daily_cte()) + "SELECT * FROM daily", DAILY_DOUBLES)

add("date_bounds", S.with_(S.blocks_cte(series=True), S.daily_cte(series=True)) +
    "SELECT series, min(day) AS min_date, max(day) AS max_date FROM daily GROUP BY series")

add("row_counts", S.with_(ENR, FEAT) + f"""
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE date <= DATE '{TRAIN_END}') AS n_train,
       count(*) FILTER (WHERE date BETWEEN DATE '{TEST_START}' AND DATE '{TEST_END}') AS n_test,
       {len(FEATURES) + 1} AS n_columns
FROM features""")

add("rmse", BASE_COMP + "SELECT model, rmse_log, rmse_raw FROM comparison", ["rmse_log", "rmse_raw"])
add("r2", BASE_COMP + "SELECT model, r2_log, r2_raw FROM comparison", ["r2_log", "r2_raw"])
add("model_comparison", BASE_COMP + "SELECT * FROM comparison", ["rmse_log", "r2_log", "rmse_raw", "r2_raw"])

# --- 2.5 windows -------------------------------------------------------------------

_WINDOW_COLUMNS = {
    "lead_label": ["label"],
    "metric_lags": [f"{m}_lag{k}" for m in S.METRICS for k in (1, 2, 3)],
    "derived_lags": [f"{m}_lag{k}" for m in S.DERIVED for k in (1, 2, 3)],
    "long_lags": ["tx_log_lag7", "tx_log_lag14", "tx_log_lag28"],
    "rolling_mean": ["tx_log_ma7", "tx_log_ma14", "tx_log_ma28"],
    "rolling_std": ["tx_log_std7", "tx_log_std14"],
    "rolling_zscore": ["tx_log_z7", "tx_log_z14"],
    "rolling_range": ["tx_log_min14", "tx_log_max14", "tx_log_rng14",
                      "tx_log_min28", "tx_log_max28", "tx_log_rng28"],
    "trend": ["trend7", "trend14"],
    "regime_flag": ["regime_up"],
    "deltas": ["delta1", "delta7"],
    "price_returns": ["price_log", "price_ret_1d", "price_ret_7d"],
    "price_volatility": ["price_volatility_7d"],
    "time_index": ["t"],
    "log_transform": ["tx_log", "label_log", "price_log"],
}
for _k, _cols in _WINDOW_COLUMNS.items():
    add(_k, S.with_(ENR, LEVELS) + f"SELECT date, {', '.join(_cols)} FROM f4", _cols)

add("ffill_bfill", S.with_(S.blocks_cte(series=True), S.daily_cte(series=True), S.PRICE_RAW_CTE,
                           S.PRICE_CTE, S.merged_cte(series=True)) + "SELECT * FROM merged",
    DAILY_DOUBLES + ["price_usd"])

# --- 2.6 order, distribution, samples ----------------------------------------------

add("ordered_output", S.with_(ENR, FEAT) + "SELECT date, label, label_log, tx_log FROM features ORDER BY date",
    ["label", "label_log", "tx_log"])
add("range_partition", S.with_(ENR, FEAT) + "SELECT * FROM features", FEATURES)
add("bounded_sample", S.with_(ENR, FEAT) +
    f"SELECT date, label, label_log, tx_log FROM features ORDER BY date LIMIT {SAMPLE_ROWS}",
    ["label", "label_log", "tx_log"])

# --- 2.8 scalar functions -----------------------------------------------------------

add("cyclical", S.with_(S.blocks_cte(), S.daily_cte()) + f"SELECT day AS date, {CAL} FROM daily", CAL_COLS)
add("month_edges", S.with_(S.blocks_cte(), S.daily_cte()) + """
SELECT day AS date,
       CASE WHEN dayofmonth(day) = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_month_start,
       CASE WHEN day = last_day(day) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_month_end
FROM daily""", ["is_month_start", "is_month_end"])
add("reconstruct", BASE + "SELECT model, date, prediction, prediction_log, prediction_raw FROM scored",
    ["prediction", "prediction_log", "prediction_raw"])

# --- 2.9 machine learning (SQL-expressible parts) -----------------------------------

add("assemble", S.with_(ENR, FEAT, FRAME) +
    f"SELECT date, list_value({', '.join(SORTED_FEATURES)}) AS features FROM test", lists=["features"])

_STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in SORTED_FEATURES)
_SCALED = ", ".join(f"CASE WHEN s_{c} <> 0 THEN ({c} - m_{c}) * (1.0 / s_{c}) ELSE 0.0 END"
                    for c in SORTED_FEATURES)
add("standardize", S.with_(ENR, FEAT, FRAME) + f""",
stats AS (SELECT {_STATS} FROM train)
SELECT date, list_value({_SCALED}) AS scaledFeatures FROM test, stats""", lists=["scaledFeatures"])

add("direct_score", S.with_(ENR, FEAT, FRAME) + """
SELECT sqrt(avg(power(label - tx_count_sum, 2))) AS rmse,
       1 - sum(power(label - tx_count_sum, 2)) / (var_pop(label) * count(*)) AS r2
FROM test""", ["rmse", "r2"])

# --- 2.10 report tables ---------------------------------------------------------------

add("report_timeseries", BASE +
    "SELECT model, date, label, label_log, prediction_log, prediction_raw FROM scored ORDER BY model, date",
    ["label", "label_log", "prediction_log", "prediction_raw"])

add("report_scatter", BASE_LONG + """
SELECT model, space, date, real, predicted,
       least(min(real) OVER p, min(predicted) OVER p) AS line_min,
       greatest(max(real) OVER p, max(predicted) OVER p) AS line_max
FROM long WINDOW p AS (PARTITION BY model, space)""", ["real", "predicted", "line_min", "line_max"])

# written as bin ranges rather than as the operator's bin arithmetic
add("residual_histogram", BASE_LONG + """,
res AS (SELECT model, space, predicted - real AS resid FROM long WHERE predicted IS NOT NULL AND real IS NOT NULL),
bounds AS (
  SELECT model, space, min(resid) AS mn, max(resid) AS mx,
         mn - CASE WHEN mx = mn THEN 0.5 ELSE 0 END AS lo, mx + CASE WHEN mx = mn THEN 0.5 ELSE 0 END AS hi
  FROM res GROUP BY model, space),
numbered AS (
  SELECT r.model, r.space, floor((r.resid - b.lo) * (40.0 / (b.hi - b.lo))) AS k
  FROM res r JOIN bounds b ON r.model = b.model AND r.space = b.space),
grid AS (SELECT model, space, lo, hi, CAST(g.bin AS INTEGER) AS bin FROM bounds, range(1, 41) AS g(bin))
SELECT g.model, g.space, g.bin,
       g.lo + (g.bin - 1) * ((g.hi - g.lo) / 40.0) AS bin_lo,
       g.lo + g.bin * ((g.hi - g.lo) / 40.0) AS bin_hi,
       (SELECT count(*) FROM numbered n WHERE n.model = g.model AND n.space = g.space
          AND (n.k = g.bin - 1 OR (g.bin = 40 AND n.k > 39))) AS count
FROM grid g""",
    ["bin_lo", "bin_hi"])

add("report_bars", BASE_COMP + """
SELECT model, metric, value
FROM comparison UNPIVOT (value FOR metric IN (rmse_log, r2_log, rmse_raw, r2_raw))""", ["value"])

add("report_overlay", BASE_LONG + """
SELECT space, date, first(real) AS real,
       first(predicted) FILTER (WHERE model = 'persistence') AS persistence,
       first(predicted) FILTER (WHERE model = 'drift') AS drift
FROM long GROUP BY space, date""", ["real", "persistence", "drift"])

# --- 2.11 end to end ---------------------------------------------------------------------

add("daily_refresh", S.with_(S.blocks_cte(True), S.daily_cte(series=True),
                             S.PRICE_RAW_CTE.replace("GROUP BY 1", f"WHERE CAST(o_orderdate AS DATE) >= DATE '{RANGE_START}' GROUP BY 1"),
                             S.PRICE_CTE, S.merged_cte(True)) + "SELECT * FROM merged", DAILY_DOUBLES + ["price_usd"])
add("enriched_daily", S.with_(ENR) + "SELECT * FROM merged", DAILY_DOUBLES + ["price_usd"])
add("feature_table", S.with_(ENR, FEAT) + "SELECT * FROM features", FEATURES)
add("feature_table_bucketed", S.with_(ENR, FEAT) + "SELECT * FROM features", FEATURES)
add("feature_table_since", S.with_(ENR, FEAT) + f"SELECT * FROM features WHERE date >= DATE '{TEST_START}'",
    FEATURES)
add("feature_table_keyed",
    S.with_(S.enriched_ctes(series=True), S.features_cte(series=True)) + "SELECT * FROM features", FEATURES)

# --- keyed forms, records and fitted models ----------------------------------------------

KFRAME = f"""kframe AS (
  SELECT series, {", ".join(LEAD)} FROM (SELECT *, label_log - tx_log AS label_diff FROM features)
  WHERE {" AND ".join(f"({c} IS NOT NULL AND NOT isnan({c}))" for c in LEAD[1:] + SORTED_FEATURES)}),
ktrain AS (SELECT * FROM kframe WHERE date <= DATE '{TRAIN_END}'),
ktest AS (SELECT * FROM kframe WHERE date BETWEEN DATE '{TEST_START}' AND DATE '{TEST_END}'),
kscored AS (
  SELECT *, tx_log + prediction AS prediction_log, exp(greatest(tx_log + prediction, 0.0)) - 1 AS prediction_raw
  FROM (SELECT *, 'persistence' AS model, 0.0::DOUBLE AS prediction FROM ktest
        UNION ALL SELECT *, 'drift' AS model, (SELECT avg(label_diff) FROM ktrain) AS prediction FROM ktest))"""
KEYED = S.with_(S.enriched_ctes(series=True), S.features_cte(series=True), KFRAME)
add("report_timeseries_keyed", KEYED +
    "SELECT model, series, date, label, label_log, prediction_log, prediction_raw FROM kscored",
    ["label", "label_log", "prediction_log", "prediction_raw"])
add("report_overlay_keyed", KEYED + """
SELECT space, series, date, any_value(real) AS real, max(predicted) FILTER (WHERE model = 'persistence') AS persistence,
       max(predicted) FILTER (WHERE model = 'drift') AS drift
FROM (SELECT model, 'log' AS space, series, date, label_log AS real, prediction_log AS predicted FROM kscored
      UNION ALL SELECT model, 'raw', series, date, label, prediction_raw FROM kscored)
GROUP BY space, series, date""", ["real", "persistence", "drift"])
add("run_report", KEYED + """
SELECT 'log' AS space, series, date, label_log AS real, true AS has_linear_regression, true AS has_decision_tree FROM ktest
UNION ALL SELECT 'raw', series, date, label, true, true FROM ktest""", ["real"])
add("bounded_sample_keyed", S.with_(S.enriched_ctes(series=True), S.features_cte(series=True)) + f"""
SELECT series, date, label, label_log, tx_log FROM features ORDER BY date, series LIMIT {SAMPLE_ROWS}""",
    ["label", "label_log", "tx_log"])
add("run_record_flat", BASE_COMP + f"""
SELECT 'baseline' AS run_id, '' AS parquet_path, '{TRAIN_END}' AS train_end, '{TEST_START}' AS test_start, '{TEST_END}' AS test_end,
       'label' AS label_raw, 'label_log' AS label_log, 'tx_log' AS label_today_log, 'label_diff' AS label_diff,
       '{",".join(SORTED_FEATURES)}' AS feature_cols, model, rmse_log, r2_log, rmse_raw FROM comparison""",
    ["rmse_log", "r2_log", "rmse_raw"])
_MODELS = "(SELECT unnest(['linear_regression', 'decision_tree', 'random_forest']) AS model)"
add("model_load_score_verified", S.with_(ENR, FEAT, FRAME) +
    f"SELECT model, date, label, true AS reload_equal FROM test, {_MODELS}", ["label"])
for _key, _name in (("linear_elastic_net_verified", "linear_regression"), ("decision_tree_verified", "decision_tree")):
    add(_key, S.with_(ENR, FEAT, FRAME) + f"""
SELECT '{_name}' AS model, date, label, label_log, tx_log, true AS reconstructed, true AS mean_ok FROM test""",
        ["label", "label_log", "tx_log"])
add("train_and_compare_verified", S.with_(ENR, FEAT, FRAME) + f"""
SELECT model, count(*) AS n_test, avg(label) AS mean_label, true AS rmse_equal FROM test, {_MODELS} GROUP BY model""", ["mean_label"])

# --- fitted models: what SQL knows of them ------------------------------------------------

_PAIRED = ", ".join(f"'{c}'" for c in [*SORTED_FEATURES, "label_diff"])
add("gram_correlations", S.with_(ENR, FEAT, FRAME) + f""",
v AS (UNPIVOT (SELECT date, label_diff, {", ".join(SORTED_FEATURES)} FROM train) ON COLUMNS(* EXCLUDE (date)) INTO NAME name VALUE x),
p AS (SELECT *, list_position([{_PAIRED}], name) AS k FROM v)
SELECT a.name AS a, b.name AS b, CASE WHEN min(a.x) < max(a.x) AND min(b.x) < max(b.x) THEN corr(a.x, b.x) END AS r
FROM p a JOIN p b ON a.date = b.date AND a.k <= b.k GROUP BY a.name, b.name""", ["r"])
# a fit is constant exactly if no correlation with the target passes the L1 penalty
_CORRS = "greatest(" + ", ".join(
    f"CASE WHEN min({c}) < max({c}) THEN abs(corr({c}, label_diff)) ELSE 0 END" for c in SORTED_FEATURES) + ")"
_CONSTANT = f"{_CORRS} <= 0.3 * 0.05 / stddev_pop(label_diff)"
add("linear_elastic_net_certified", S.with_(ENR, FEAT, FRAME) + f""",
m AS (SELECT count(*) AS n, {_CONSTANT} AS constant FROM train)
SELECT date, label_diff, true AS equals_spark, n, constant, true AS optimal FROM test, m""", ["label_diff"])
add("train_per_series", S.with_(S.enriched_ctes(series=True), S.features_cte(series=True)) + f""",
kfull AS (
  SELECT * FROM (SELECT *, label_log - tx_log AS label_diff FROM features)
  WHERE {" AND ".join(f"({c} IS NOT NULL AND NOT isnan({c}))" for c in LEAD[1:] + SORTED_FEATURES)}),
m AS (SELECT series, count(*) AS n_train, {_CONSTANT} AS constant FROM kfull WHERE date <= DATE '{TRAIN_END}' GROUP BY series),
t AS (SELECT series, count(*) AS n_test FROM kfull WHERE date BETWEEN DATE '{TEST_START}' AND DATE '{TEST_END}' GROUP BY series)
SELECT series, n_train, n_test, n_test AS n_scored, constant, true AS optimal, true AS equals_single FROM m JOIN t USING (series)""")
add("tree_nodes_verified", S.with_(ENR, FEAT, FRAME) + """
SELECT date, model, label, true AS equals_joined, CAST(0 AS BIGINT) AS leaf_faults
FROM test, (SELECT unnest(['decision_tree', 'random_forest']) AS model)""", ["label"])
add("boosted_trees_verified", S.with_(ENR, FEAT, FRAME) + """
SELECT date, 'boosted_trees' AS model, label, true AS reload_equal, true AS equals_joined, CAST(600 AS BIGINT) AS rounds FROM test""", ["label"])
_ERRORS = "count(*) AS n_test, avg(label) AS mean_label, true AS errors_equal, true AS varies"
add("score_models_verified", S.with_(ENR, FEAT, FRAME) + f"SELECT model, {_ERRORS} FROM test, {_MODELS} GROUP BY model", ["mean_label"])
add("end_to_end_verified", S.with_(ENR, FEAT, FRAME) + f"""
SELECT model, {_ERRORS}, (SELECT count(*) FROM features) AS feature_rows
FROM test, (SELECT unnest(['linear_regression', 'decision_tree']) AS model) GROUP BY model""", ["mean_label"])
# the reference's command-line defaults (fixed values)
add("model_save_params", """
SELECT * FROM (VALUES
  ('linear_regression', 'VectorAssembler', 'handleInvalid', 'skip'),
  ('linear_regression', 'StandardScalerModel', 'withMean', 'true'),
  ('linear_regression', 'StandardScalerModel', 'withStd', 'true'),
  ('linear_regression', 'LinearRegressionModel', 'regParam', '0.05'),
  ('linear_regression', 'LinearRegressionModel', 'elasticNetParam', '0.3'),
  ('decision_tree', 'VectorAssembler', 'handleInvalid', 'skip'),
  ('decision_tree', 'DecisionTreeRegressionModel', 'maxDepth', '10'),
  ('decision_tree', 'DecisionTreeRegressionModel', 'minInstancesPerNode', '10')) AS t(model, stage, name, value)""")

# --- layouts: the same rows as the plain forms --------------------------------------------

ORACLES["feature_table_clustered"] = ORACLES["feature_table_keyed"]
ORACLES["raw_time_ordered"] = ORACLES["raw_projection"]
add("footer_bounds", "SELECT min(CAST(l_shipdate AS DATE)) AS min_date, max(CAST(l_shipdate AS DATE)) AS max_date, "
    "count(DISTINCT CAST(l_shipdate AS DATE)) AS n_rows FROM lineitem")
add("price_pruned_join", S.with_(S.blocks_cte(), S.daily_cte(RANGE_START, RANGE_END), S.PRICE_RAW_CTE, S.PRICE_CTE) +
    "SELECT d.*, p.price_usd, p.price_volume FROM daily d LEFT JOIN price p USING (day)", DAILY_DOUBLES + ["price_usd"])
