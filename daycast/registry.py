"""Catalogue of jobs over the driver's tables, one per operator of the survey.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built from the
whole ``lineitem`` / ``orders`` tables through the stand-in views of
:mod:`daycast.sources.testdata`.

Model-free entries that need predictions (metrics, report tables) use two
SQL-expressible predictors of the delta target, so each has an exact DuckDB
oracle: ``persistence`` (tomorrow = today, delta 0) and ``drift`` (the mean
training delta, a scalar subquery).  Entries that fit Spark ML models are
checked by row count only."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from daycast.functions.calendar import add_calendar, calendar_features, drop_helpers, month_edges
from daycast.functions.casting import decimal_to_double, nan_to_null, safe_cast_double
from daycast.functions.transforms import label_diff, reconstruct
from daycast.operators import models as M
from daycast.operators import gram as G
from daycast.operators import trees as T
from daycast.operators.enrich import ffill_bfill, price_left_join, price_rename, price_source
from daycast.operators.metrics import direct_metrics, model_comparison, regression_metrics
from daycast.operators.output import bounded_sample, ordered_output, range_partition
from daycast.operators.report import (report_bars, report_overlay, report_scatter,
                                      report_timeseries, residual_histogram)
from daycast.operators.rollup import date_bounds, daily_rollup, raw_projection, row_counts, scan_range
from daycast.operators.schema import ensure_date, resolve_label, select_metrics
from daycast.operators.split import drop_incomplete, time_split, training_frame
from daycast.operators.windows import ordered_window
from daycast.plans.enriched import enriched_daily
from daycast.plans.features import feature_levels, feature_table, prepare_daily
from daycast.plans.end_to_end import run_end_to_end
from daycast.plans.report import run_report
from daycast.plans.store import DailyStore
from daycast.plans.train import fit_models, train_and_compare
from daycast.session import shared_dir
from daycast.sources import layout as L
from daycast.sources import testdata as td
from daycast.sources.files import (features_scan, features_sink, month_ranges, multi_read,
                                   read_month_range, write_month_partitioned)
from daycast.sources.models_io import model_load_score, model_metadata, model_save, saved_params
from daycast.sources.records import metrics_summary, run_record

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Split of the stand-in data (lineitem days run 1995-01-02 .. 2001-11-04).
TRAIN_END = "1999-12-31"
TEST_START = "2000-01-01"
TEST_END = "2001-12-31"
DAY_BEFORE_TEST = "1999-12-31"
# A day range inside the data, for the range-scan operators.
RANGE_START = "1996-03-01"
RANGE_END = "1998-08-31"
# Cut between the two inputs of the multi-input read.
MULTI_CUT = "1998-12-31"
# Limit given to the bounded sample: under the rows of the feature table, so it binds.
SAMPLE_ROWS = 500
BASELINES = ["persistence", "drift"]

GRID = 1048576.0  # 2**20


def _snap(c):
    return F.rint(c.cast("double") * F.lit(GRID)) / F.lit(GRID)


def round_doubles(df: DataFrame) -> DataFrame:
    """Snap DOUBLE/FLOAT columns (and arrays of them) to a 2**-20 grid,
    half-even, for cross-engine value comparison only.

    Scaling by a power of two and ``rint`` are exact IEEE operations, so two
    engines give bit-identical results unless their inputs straddle a grid
    midpoint — unlike decimal rounding, where data with few decimals lands on
    exact ties and a one-ulp difference in summation order flips the digit."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = _snap(c)
        elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, (DoubleType, FloatType)):
            c = F.transform(c, _snap)
        cols.append(c.alias(f.name))
    return df.select(cols)


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- shared building blocks ------------------------------------------------

def _blocks(spark, sf, series=False):
    return td.blocks(spark, sf, with_series=series)


def _daily(spark, sf, series=False):
    return daily_rollup(_blocks(spark, sf, series), series=["series"] if series else ())


def _price(spark, sf):
    return price_rename(td.price_history(spark, sf))


def _enriched(spark, sf, series=False):
    return enriched_daily(_blocks(spark, sf, series), td.price_history(spark, sf),
                          series=["series"] if series else ())


def _features(spark, sf, series=False):
    return feature_table(_enriched(spark, sf, series), series=["series"] if series else ())


def _levels(spark, sf):
    """Every feature column on every daily row (before the completeness filter)."""
    base, metrics, x = prepare_daily(_enriched(spark, sf))
    return feature_levels(base, metrics, x, ordered_window())


def _written_features(spark, sf, series=False):
    """The feature table written to the shared checkpoint folder and read
    back, as the training and report stages consume it: later stages re-read
    a small Parquet table instead of re-running the raw-data plan, and the
    lineage is cut (a lost executor re-reads files, not the roll-up)."""
    path = _scratch(spark, "features")
    features_sink(_features(spark, sf, series), path)
    return features_scan(spark, path)


def _splits(spark, sf, series=False):
    frame, feats = training_frame(_written_features(spark, sf, series), ["series"] if series else ())
    train, test = time_split(frame, TRAIN_END, TEST_START, TEST_END)
    return train, test, feats


def _baseline_of(train, test, keys=()):
    """Scored test rows of the two SQL-expressible predictors (one pass over
    the test rows: one struct per predictor, exploded)."""
    mean_delta = train.select(F.avg("label_diff")).scalar()
    preds = F.array(F.struct(F.lit("persistence").alias("model"), F.lit(0.0).alias("prediction")),
                    F.struct(F.lit("drift").alias("model"), mean_delta.cast("double").alias("prediction")))
    lead = [*keys, "date", "label", "label_log", "tx_log", "label_diff"]
    return test.select(*lead, F.explode(preds).alias("p")).select(
        *lead, "p.model", "p.prediction", *reconstruct("prediction", "tx_log"))


def _baseline_predictions(spark, sf, series=False):
    train, test, _ = _splits(spark, sf, series)
    return _baseline_of(train, test, ["series"] if series else ())


def _scratch(spark, kind):
    return shared_dir(spark, "registry", f"{kind}-{uuid.uuid4().hex}")


def _fit_models(spark, sf, names, params=None):
    train, test, feats = _splits(spark, sf)
    p = replace(params or M.ModelParams(), models=list(names))
    return fit_models(train, feats, p), train, test


def _model_scores(spark, sf, name):
    models, _, test = _fit_models(spark, sf, [name])
    return M.score(models[name], test, name).select(
        "date", "model", "label", "label_log", "tx_log", "label_diff",
        "prediction", "prediction_log", "prediction_raw")


# --- 2.1 scans, sources, sinks --------------------------------------------

@register("scan_range")
def q_scan_range(spark, sf):
    return scan_range(_blocks(spark, sf), RANGE_START, RANGE_END)


@register("month_partitioned")
def q_month_partitioned(spark, sf):
    """Write the daily table by month, read a day range back (folders outside it
    are pruned) and report every month of the range."""
    path = _scratch(spark, "daily")
    write_month_partitioned(_daily(spark, sf), path)
    days = read_month_range(spark, path, RANGE_START, RANGE_END)
    months = month_ranges(date_bounds(days, "day"))
    counts = days.groupBy(F.col("year_month").cast("string").alias("year_month")).agg(
        F.sum("blocks_count").alias("blocks"), F.count(F.lit(1)).alias("days"))
    return months.join(counts, "year_month", "left")


@register("multi_read")
def q_multi_read(spark, sf):
    """Two Parquet inputs of unequal schema, read as one table."""
    cut = F.lit(MULTI_CUT).cast("date")
    first, second = _scratch(spark, "multi"), _scratch(spark, "multi")
    _enriched(spark, sf).filter(F.col("day") <= cut).write.parquet(first)
    _daily(spark, sf).filter(F.col("day") > cut).write.parquet(second)
    return multi_read(spark, [first, second])


@register("price_source")
def q_price_source(spark, sf):
    return price_source(_price(spark, sf), _daily(spark, sf))


@register("features_sink")
def q_features_sink(spark, sf):
    path = _scratch(spark, "features")
    features_sink(_features(spark, sf), path)
    return spark.read.parquet(path)


@register("features_scan")
def q_features_scan(spark, sf):
    path = _scratch(spark, "features")
    # written with a timestamp date, as a pandas writer would leave it
    features_sink(_features(spark, sf).withColumn("date", F.col("date").cast("timestamp_ntz")), path)
    return features_scan(spark, path)


@register("model_save")
def q_model_save(spark, sf):
    models, _, _ = _fit_models(spark, sf, ["linear_regression"])
    path = model_save(models["linear_regression"], _scratch(spark, "models"), "linear_regression")
    return model_metadata(spark, path).select("class", "uid", "sparkVersion")


def _save_all(models, run_dir):
    for n, m in models.items():
        model_save(m, run_dir, n)
    return run_dir


@register("model_load_score")
def q_model_load_score(spark, sf):
    models, _, test = _fit_models(spark, sf, M.PREFERRED_ORDER)
    run_dir = _save_all(models, _scratch(spark, "models"))
    return model_load_score(run_dir, test).select(
        "model", "date", "label", "label_log", "prediction_log", "prediction_raw")


@register("model_load_score_verified")
def q_model_load_score_verified(spark, sf):
    """Every model saved and reloaded: its predictions equal those in memory."""
    models, _, test = _fit_models(spark, sf, M.PREFERRED_ORDER)
    run_dir = _save_all(models, _scratch(spark, "models"))
    again = model_load_score(run_dir, test).select("model", "date", "label", F.col("prediction").alias("again"))
    kept = None
    for n, m in models.items():
        p = M.score(m, test, n).select("model", "date", "prediction")
        kept = p if kept is None else kept.unionByName(p)
    return again.join(kept, ["model", "date"]).select(
        "model", "date", "label", F.col("again").eqNullSafe(F.col("prediction")).alias("reload_equal"))


@register("run_record")
def q_run_record(spark, sf):
    train, test, feats = _splits(spark, sf)
    comp = model_comparison(_baseline_of(train, test))
    return run_record(comp, "baseline", "", TRAIN_END, TEST_START, TEST_END, feats)


@register("run_record_flat")
def q_run_record_flat(spark, sf):
    """The run record as one row per model and plain columns."""
    return q_run_record(spark, sf).select(
        "run_id", "parquet_path", "train_end", "test_start", "test_end",
        *[F.col(f"label_cols.{k}").alias(f"label_{k}") for k in ("raw", "log", "today_log", "diff")],
        F.array_join("feature_cols", ",").alias("feature_cols"), F.explode("results").alias("model", "r")).select(
        "*", "r.rmse_log", "r.r2_log", "r.rmse_raw").drop("r")


@register("metrics_summary")
def q_metrics_summary(spark, sf):
    return metrics_summary(model_comparison(_baseline_predictions(spark, sf)), TEST_START, TEST_END)


# --- 2.2 projections, filters, cleaning ------------------------------------

@register("safe_cast")
def q_safe_cast(spark, sf):
    return _blocks(spark, sf).select("timestamp", safe_cast_double("accumulatedFees").alias("accumulated_fees"))


@register("raw_projection")
def q_raw_projection(spark, sf):
    return raw_projection(_blocks(spark, sf), RANGE_START, RANGE_END)


@register("decimal_to_double")
def q_decimal_to_double(spark, sf):
    li = td.table(spark, sf, "lineitem")
    return decimal_to_double(li.select(
        F.col("l_shipdate"), F.col("l_quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("l_extendedprice"),
        F.col("l_discount").cast("decimal(4,2)").alias("l_discount")))


@register("ensure_date")
def q_ensure_date(spark, sf):
    return ensure_date(_daily(spark, sf))


@register("select_metrics")
def q_select_metrics(spark, sf):
    return select_metrics(ensure_date(_enriched(spark, sf)))


@register("resolve_label")
def q_resolve_label(spark, sf):
    df = ensure_date(_daily(spark, sf))
    src = resolve_label("tx_count", df.columns)
    return df.select("date", F.lit(src).alias("label_metric"), F.col(src).cast("double").alias("label_value"))


def _dirty(spark, sf):
    """Block values with unparseable text (line 3) and NaN (line 4)."""
    li = td.table(spark, sf, "lineitem")
    txt = F.when(F.col("l_linenumber") == 3, F.lit("n/a")).otherwise(F.col("l_extendedprice").cast("string"))
    nan = F.when(F.col("l_linenumber") == 4, F.lit("NaN")).otherwise(F.col("l_tax").cast("string"))
    return li.select(F.col("l_shipdate").alias("timestamp"),
                     safe_cast_double(txt).alias("fee"), safe_cast_double(nan).alias("gas"))


@register("nan_to_null")
def q_nan_to_null(spark, sf):
    return nan_to_null(_dirty(spark, sf), ["gas"])


@register("drop_incomplete")
def q_drop_incomplete(spark, sf):
    return drop_incomplete(_dirty(spark, sf), ["fee", "gas"])


@register("drop_helpers")
def q_drop_helpers(spark, sf):
    return drop_helpers(add_calendar(ensure_date(_daily(spark, sf))))


@register("price_rename")
def q_price_rename(spark, sf):
    return _price(spark, sf)


@register("time_split")
def q_time_split(spark, sf):
    train, test, _ = _splits(spark, sf)
    cols = ["date", "label", "label_log", "tx_log"]
    return (train.select(F.lit("train").alias("split"), *cols)
            .unionByName(test.select(F.lit("test").alias("split"), *cols)))


@register("feature_columns")
def q_feature_columns(spark, sf):
    return training_frame(_features(spark, sf))[0]


@register("label_diff")
def q_label_diff(spark, sf):
    return _features(spark, sf).select("date", "label_log", "tx_log", label_diff())


@register("optional_price_features")
def q_optional_price_features(spark, sf):
    return feature_table(_daily(spark, sf))


# --- 2.3 join ---------------------------------------------------------------

@register("price_left_join")
def q_price_left_join(spark, sf):
    return price_left_join(_daily(spark, sf), _price(spark, sf))


# --- 2.4 aggregations -------------------------------------------------------

@register("daily_rollup")
def q_daily_rollup(spark, sf):
    return _daily(spark, sf)


@register("date_bounds")
def q_date_bounds(spark, sf):
    return date_bounds(_daily(spark, sf, series=True), "day", ["series"])


@register("row_counts")
def q_row_counts(spark, sf):
    return row_counts(_features(spark, sf), TRAIN_END, TEST_START, TEST_END)


@register("rmse")
def q_rmse(spark, sf):
    m = regression_metrics(_baseline_predictions(spark, sf), by=["model"])
    return m.select("model", "rmse_log", "rmse_raw")


@register("r2")
def q_r2(spark, sf):
    m = regression_metrics(_baseline_predictions(spark, sf), by=["model"])
    return m.select("model", "r2_log", "r2_raw")


@register("model_comparison")
def q_model_comparison(spark, sf):
    return model_comparison(_baseline_predictions(spark, sf))


# --- 2.5 windows (every daily row, partial frames included) -----------------

_WINDOW_COLUMNS = {
    "lead_label": ["label"],
    "metric_lags": [f"{m}_lag{k}" for m in ["blocks_count", "tx_count_sum", "accumulated_fees_sum",
                                            "developer_fees_sum", "gas_provided_avg", "gas_refunded_avg",
                                            "gas_penalized_avg", "price_usd", "price_volume"]
                    for k in (1, 2, 3)],
    "derived_lags": [f"{m}_lag{k}" for m in ["tx_log_std7", "tx_log_std14", "tx_log_z7", "tx_log_z14",
                                             "delta1", "delta7", "trend7", "trend14",
                                             "tx_log_rng14", "tx_log_rng28"] for k in (1, 2, 3)],
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


def _window_query(cols):
    def q(spark, sf):
        return _levels(spark, sf).select("date", *cols)
    return q


for _name, _cols in _WINDOW_COLUMNS.items():
    register(_name)(_window_query(_cols))


@register("ffill_bfill")
def q_ffill_bfill(spark, sf):
    daily = _daily(spark, sf, series=True)
    return ffill_bfill(price_left_join(daily, _price(spark, sf)), order="day", series=["series"])


# --- 2.6 order, distribution, samples -------------------------------------

@register("ordered_output")
def q_ordered_output(spark, sf):
    return ordered_output(_features(spark, sf).select("date", "label", "label_log", "tx_log"), "date")


@register("range_partition")
def q_range_partition(spark, sf):
    return range_partition(_features(spark, sf))


@register("bounded_sample")
def q_bounded_sample(spark, sf):
    return bounded_sample(_features(spark, sf).select("date", "label", "label_log", "tx_log"), SAMPLE_ROWS)


@register("bounded_sample_keyed")
def q_bounded_sample_keyed(spark, sf):
    rows = _features(spark, sf, series=True).select("series", "date", "label", "label_log", "tx_log")
    return bounded_sample(rows, SAMPLE_ROWS, "date", "series")


# --- 2.8 scalar functions ---------------------------------------------------

@register("cyclical")
def q_cyclical(spark, sf):
    return ensure_date(_daily(spark, sf)).select("date", *calendar_features("date"))


@register("month_edges")
def q_month_edges(spark, sf):
    return ensure_date(_daily(spark, sf)).select("date", *month_edges("date"))


@register("reconstruct")
def q_reconstruct(spark, sf):
    return _baseline_predictions(spark, sf).select("model", "date", "prediction", "prediction_log",
                                                   "prediction_raw")


# --- 2.9 machine learning ---------------------------------------------------

@register("assemble")
def q_assemble(spark, sf):
    _, test, feats = _splits(spark, sf)
    return M.assembled_array(test, feats)


@register("standardize")
def q_standardize(spark, sf):
    train, test, feats = _splits(spark, sf)
    return M.standardized_array(train, test, feats)


for _key, _model in (("linear_elastic_net", "linear_regression"), ("decision_tree", "decision_tree"),
                     ("random_forest", "random_forest"), ("boosted_trees", "boosted_trees")):
    register(_key)((lambda m: (lambda spark, sf: _model_scores(spark, sf, m)))(_model))


def _verified(spark, sf, name):
    """What SQL can say of a fitted regression: on the training rows the mean
    prediction is the mean target; for a tree every leaf predicts the mean
    target of its rows."""
    models, train, test = _fit_models(spark, sf, [name])
    fitted = models[name].transform(train).select("prediction", "label_diff")
    mean_ok = fitted.agg((F.abs(F.sum("prediction") - F.sum("label_diff")) < 1e-6).alias("mean_ok"))
    if name == "decision_tree":
        leaves = fitted.groupBy("prediction").agg(F.avg("label_diff").alias("m"))
        mean_ok = mean_ok.crossJoin(leaves.agg(F.max(F.abs(F.col("m") - F.col("prediction"))).alias("d"))).select(
            (F.col("mean_ok") & (F.col("d") < 1e-9)).alias("mean_ok"))
    scored = M.score(models[name], test, name).select("model", "date", "label", "label_log", "tx_log", (
        F.abs(F.col("prediction_log") - F.col("tx_log") - F.col("prediction")) < 1e-9).alias("reconstructed"))
    return scored.withColumn("mean_ok", mean_ok.scalar())


for _key, _model in (("linear_elastic_net_verified", "linear_regression"), ("decision_tree_verified", "decision_tree")):
    register(_key)((lambda m: (lambda spark, sf: _verified(spark, sf, m)))(_model))


@register("gram_correlations")
def q_gram_correlations(spark, sf):
    """The mergeable aggregate behind M3: correlations of all features and the target
    on the training rows."""
    train, _, feats = _splits(spark, sf)
    cols = [*feats, "label_diff"]
    return G.correlations(G.gram_states(train, cols), cols)


def _certified(train, test, feats, keys=()):
    """The certified fits (one row a model) and the scored test rows."""
    p = M.ModelParams()
    model = G.SeriesLinearModel.fit(train, feats, "label_diff", p.lr_regparam, p.lr_elasticnet, keys)
    return model.models.withColumn("constant", ~F.exists("coefficients", lambda w: w != 0)), model.transform(test)


@register("linear_elastic_net_certified")
def q_linear_elastic_net_certified(spark, sf):
    """M3 on the Gram matrix: optimal by its subgradient, within the solver tolerance of Spark ML's model on
    every test row, constant exactly where the penalty says so."""
    train, test, feats = _splits(spark, sf)
    models, own = _certified(train, test, feats)
    theirs = M.fit("linear_regression", train, feats, M.ModelParams()).transform(test).select("date", F.col("prediction").alias("p"))
    facts = models.select(F.struct("n", "constant", (F.col("residual") < 1e-6).alias("optimal"))).scalar()
    return own.join(theirs, "date").select(
        "date", "label_diff", (F.abs(F.col("prediction") - F.col("p")) < 1e-4).alias("equals_spark"), facts.alias("f")).select(
        "date", "label_diff", "equals_spark", "f.*")


@register("train_per_series")
def q_train_per_series(spark, sf):
    """E3 on the keyed table with a model per series: rows, whether each model is
    optimal, constant, and equal to the fit of its series alone."""
    train, test, feats = _splits(spark, sf, series=True)
    models, scored = _certified(train, test, feats, ["series"])
    alone = None
    for key in [r[0] for r in models.select("series").collect()]:  # one row a return flag: three
        one = G.SeriesLinearModel.fit(train.where(F.col("series") == key), feats, "label_diff",
                                      M.ModelParams().lr_regparam, M.ModelParams().lr_elasticnet).models.select(
            F.lit(key).alias("series"), F.col("coefficients").alias("w"))
        alone = one if alone is None else alone.unionAll(one)
    off = F.array_max(F.zip_with("coefficients", "w", lambda a, b: F.abs(a - b)))
    tested = scored.groupBy("series").agg(F.count(F.lit(1)).alias("n_test"), F.count("prediction").alias("n_scored"))
    return models.join(alone, "series").join(tested, "series").select(
        "series", F.col("n").alias("n_train"), "n_test", "n_scored", "constant",
        (F.col("residual") < 1e-6).alias("optimal"), (off < 1e-9).alias("equals_single"))


@register("tree_nodes_verified")
def q_tree_nodes_verified(spark, sf):
    """M4 and M5 as node tables: on every test row the sum over joined leaves is the
    model's own prediction; the single tree's leaves hold the means of their rows."""
    models, train, test = _fit_models(spark, sf, ["decision_tree", "random_forest"])
    run_dir, out = _save_all(models, _scratch(spark, "models")), None
    for name, model in models.items():
        feats = model.stages[0].getInputCols()
        nodes = T.node_table(spark, f"{run_dir}/{name}").persist()
        joined = T.score_by_join(test, nodes, feats, ["date"]).withColumnRenamed("prediction", "joined")
        rows = M.score(model, test, name).select("date", "model", "label", "prediction").join(joined, "date", "left").select(
            "date", "model", "label", (F.abs(F.col("prediction") - F.col("joined")) < 1e-9).alias("equals_joined"))
        if name == "decision_tree":
            leaves = T.leaf_means(train, nodes, feats, ["date"], "label_diff")
            bad = leaves.where("NOT coalesce(abs(value - mean) < 1e-9 AND n = rows, false)")
            rows = rows.withColumn("leaf_faults", bad.agg(F.count(F.lit(1)).alias("k")).scalar())
        else:
            rows = rows.withColumn("leaf_faults", F.lit(0).cast("bigint"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("boosted_trees_verified")
def q_boosted_trees_verified(spark, sf):
    """M6: every round is there; on every test row the reloaded model predicts what the
    fitted one did, and what joining the row to the node table level by level gives."""
    models, _, test = _fit_models(spark, sf, ["boosted_trees"])
    model, run_dir = models["boosted_trees"], _scratch(spark, "models")
    model_save(model, run_dir, "boosted_trees")
    again = model_load_score(run_dir, test).select("date", F.col("prediction").alias("again"))
    joined = T.score_by_join(test, model.nodes, model.feature_cols, ["date"]).withColumnRenamed("prediction", "joined")
    rounds = model.nodes.where("tree >= 0").agg(F.countDistinct("tree").alias("k")).scalar()
    return M.score(model, test, "boosted_trees").join(again, "date").join(joined, "date").select(
        "date", "model", "label", (F.col("prediction") == F.col("again")).alias("reload_equal"),
        (F.abs(F.col("prediction") - F.col("joined")) < 1e-9).alias("equals_joined"), rounds.alias("rounds"))


@register("score_models_verified")
def q_score_models_verified(spark, sf):
    """M7: per model of the comparison, its test rows and mean label, and whether all
    four errors are those of its own predictions."""
    models, _, test = _fit_models(spark, sf, M.PREFERRED_ORDER)
    preds = None
    for n, m in models.items():
        pred = M.score(m, test, n).select("model", "date", "label", "label_log", "prediction_log", "prediction_raw")
        preds = pred if preds is None else preds.unionByName(pred)
    return _errors_verified(model_comparison(preds), preds)


def _errors_verified(comparison, preds):
    """Errors again, from their definitions."""
    log, raw = F.col("label_log") - F.col("prediction_log"), F.col("label") - F.col("prediction_raw")
    again = preds.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_test"), F.avg("label").alias("mean_label"), F.sqrt(F.avg(log * log)).alias("a"),
        (1 - F.sum(log * log) / (F.var_pop("label_log") * F.count(F.lit(1)))).alias("b"), F.sqrt(F.avg(raw * raw)).alias("c"),
        (1 - F.sum(raw * raw) / (F.var_pop("label") * F.count(F.lit(1)))).alias("d"), F.countDistinct("prediction_log").alias("k"))
    close = lambda x, y: F.abs(F.col(x) - F.col(y)) <= 1e-9 * F.greatest(F.abs(F.col(y)), F.lit(1.0))
    return comparison.join(again, "model").select(
        "model", "n_test", "mean_label", (close("rmse_log", "a") & close("r2_log", "b") & close("rmse_raw", "c") & close("r2_raw", "d")).alias("errors_equal"),
        (F.col("k") > 1).alias("varies"))


@register("score_models")
def q_score_models(spark, sf):
    models, _, test = _fit_models(spark, sf, M.PREFERRED_ORDER)
    out = None
    for n, m in models.items():
        pred = M.score(m, test, n).select("model", "date", "label", "label_log", "prediction_log", "prediction_raw")
        out = pred if out is None else out.unionByName(pred)
    return model_comparison(out)


@register("direct_score")
def q_direct_score(spark, sf):
    _, test, _ = _splits(spark, sf)
    return direct_metrics(test.select("label", F.col("tx_count_sum").alias("prediction")))


# --- 2.10 report tables -----------------------------------------------------

@register("report_timeseries")
def q_report_timeseries(spark, sf):
    return report_timeseries(_baseline_predictions(spark, sf))


@register("report_scatter")
def q_report_scatter(spark, sf):
    return report_scatter(_baseline_predictions(spark, sf))


@register("residual_histogram")
def q_residual_histogram(spark, sf):
    return residual_histogram(_baseline_predictions(spark, sf))


@register("report_bars")
def q_report_bars(spark, sf):
    return report_bars(model_comparison(_baseline_predictions(spark, sf)))


@register("report_overlay")
def q_report_overlay(spark, sf):
    return report_overlay(_baseline_predictions(spark, sf), BASELINES)


@register("report_timeseries_keyed")
def q_report_timeseries_keyed(spark, sf):
    return report_timeseries(_baseline_predictions(spark, sf, series=True), ["series"])


@register("report_overlay_keyed")
def q_report_overlay_keyed(spark, sf):
    return report_overlay(_baseline_predictions(spark, sf, series=True), BASELINES, ["series"])


@register("run_report")
def q_run_report(spark, sf):
    """The report plan on fitted models: real values per series and date and
    whether every model predicted them."""
    run_dir = _scratch(spark, "report")
    features = _written_features(spark, sf, series=True)
    train, _ = time_split(training_frame(features, ["series"])[0], TRAIN_END, TEST_START, TEST_END)
    names = ["linear_regression", "decision_tree"]
    _save_all(fit_models(train, training_frame(features, ["series"])[1], M.ModelParams(models=names), ["series"]), run_dir)
    report = run_report(spark, features, run_dir, TEST_START, TEST_END, names, ["series"])
    return report.overlay.select("space", "series", "date", "real", *[F.col(n).isNotNull().alias(f"has_{n}") for n in names])


# --- 2.11 end to end --------------------------------------------------------

@register("feature_table")
def q_feature_table(spark, sf):
    return _features(spark, sf)


@register("feature_table_keyed")
def q_feature_table_keyed(spark, sf):
    return _features(spark, sf, series=True)


@register("feature_table_bucketed")
def q_feature_table_bucketed(spark, sf):
    """E1 in the bucketed halo mode (buckets of a year of rows, fill by
    32-day blocks): the same table as ``feature_table``."""
    daily = enriched_daily(_blocks(spark, sf), td.price_history(spark, sf), fill_block_days=32)
    return feature_table(daily, bucket_rows=365)


def refreshed_store(spark, sf, path):
    """A daily store that holds every raw day before the test start."""
    store = DailyStore(spark, path)
    store.replace_from(_blocks(spark, sf), td.price_history(spark, sf), end=DAY_BEFORE_TEST)
    return store


def features_after_refresh(spark, sf, store):
    """Raw days from the test start on are rolled up and added; features of them."""
    store.replace_from(_blocks(spark, sf), td.price_history(spark, sf), TEST_START)
    return feature_table(store.read(), since=TEST_START)


@register("feature_table_since")
def q_feature_table_since(spark, sf):
    """E1 refreshed from the test start on: only raw days from there are scanned."""
    return features_after_refresh(spark, sf, refreshed_store(spark, sf, _scratch(spark, "store")))


@register("daily_refresh")
def q_daily_refresh(spark, sf):
    """E2 through a keyed store: a first load up to the test start, a refresh from
    there, then late rows of all days (every fifth count); no price before
    ``RANGE_START``, so the first days are filled from later ones."""
    blocks = _blocks(spark, sf, series=True)
    price = td.price_history(spark, sf).where(F.col("Date") >= F.lit(RANGE_START).cast("date"))
    late = F.col("txCount") % 5 == 0
    store = DailyStore(spark, _scratch(spark, "store"), ["series"])
    store.replace_from(blocks.where(~late), price, end=DAY_BEFORE_TEST)
    store.replace_from(blocks.where(~late), price, TEST_START)
    store.add_rows(blocks.where(late), price)
    return store.read()


@register("enriched_daily")
def q_enriched_daily(spark, sf):
    return _enriched(spark, sf)


@register("train_and_compare")
def q_train_and_compare(spark, sf):
    res = train_and_compare(_features(spark, sf), TRAIN_END, TEST_START, TEST_END,
                            run_dir=_scratch(spark, "models"))
    return res.comparison


@register("end_to_end")
def q_end_to_end(spark, sf):
    res = run_end_to_end(spark, _blocks(spark, sf), td.price_history(spark, sf), None, None,
                       TRAIN_END, TEST_START, TEST_END, work_dir=_scratch(spark, "end_to_end"))
    return res.comparison


@register("train_and_compare_verified")
def q_train_and_compare_verified(spark, sf):
    """Per model of the comparison: test rows, their mean label, and whether the
    comparison's error equals the one of the written predictions."""
    res = train_and_compare(_features(spark, sf), TRAIN_END, TEST_START, TEST_END, run_dir=_scratch(spark, "models"))
    again = res.predictions.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_test"), F.avg("label").alias("mean_label"),
        F.sqrt(F.avg(F.pow(F.col("label_log") - F.col("prediction_log"), 2))).alias("e"))
    return res.comparison.join(again, "model").select(
        "model", "n_test", "mean_label", (F.abs(F.col("rmse_log") - F.col("e")) < 1e-9).alias("rmse_equal"))


@register("end_to_end_verified")
def q_end_to_end_verified(spark, sf):
    """Rows of the written feature table, and per model what ``score_models_verified`` says."""
    res = run_end_to_end(spark, _blocks(spark, sf), td.price_history(spark, sf), None, None, TRAIN_END, TEST_START, TEST_END,
                         work_dir=_scratch(spark, "end_to_end"), params=M.ModelParams(models=["linear_regression", "decision_tree"]))
    return _errors_verified(res.comparison, res.predictions).withColumn("feature_rows", F.lit(res.feature_rows).cast("bigint"))


@register("model_save_params")
def q_model_save_params(spark, sf):
    """The parameters that a saved model's files hold, stage by stage."""
    models, _, _ = _fit_models(spark, sf, ["linear_regression", "decision_tree"])
    run_dir = _save_all(models, _scratch(spark, "models"))
    return saved_params(spark, run_dir, list(models)).where("name IN ('regParam', 'elasticNetParam', 'maxDepth', 'minInstancesPerNode', 'withMean', 'withStd', 'handleInvalid')")


# --- layouts ------------------------------------------------------------------

@register("feature_table_clustered")
def q_feature_table_clustered(spark, sf):
    """E1 per series on an enriched table clustered by series: windows without a shuffle."""
    name = L.write_clustered(_enriched(spark, sf, series=True), ["series"], buckets=8)
    return feature_table(spark.table(name), series=["series"])


@register("raw_time_ordered")
def q_raw_time_ordered(spark, sf):
    """P2 / O1 as a layout: raw rows in month folders of time-ordered files, a day range
    read back."""
    path = _scratch(spark, "ordered")
    L.write_time_ordered(raw_projection(_blocks(spark, sf), None, None, ordered=False), path)
    return L.read_time_range(spark, path, RANGE_START, RANGE_END)


@register("footer_bounds")
def q_footer_bounds(spark, sf):
    """A2 and A3 of the written daily table from its footers."""
    path = _scratch(spark, "daily")
    _daily(spark, sf).write.parquet(path)
    return L.footer_bounds(spark, path, "day")


@register("price_pruned_join")
def q_price_pruned_join(spark, sf):
    """S4 and J1 on a month-partitioned price table, pruned by the days of a range."""
    path = _scratch(spark, "price")
    L.write_price_months(td.price_history(spark, sf), path)
    return L.price_of_days(daily_rollup(_blocks(spark, sf), RANGE_START, RANGE_END), path)
