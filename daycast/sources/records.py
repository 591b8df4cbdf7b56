"""Run record and metric summary as one-row DataFrames → JSON."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABEL_COLS = {"raw": "label", "log": "label_log", "today_log": "tx_log", "diff": "label_diff"}


def run_record(comparison: DataFrame, run_id: str, parquet_path: str,
               train_end: str, test_start: str, test_end: str,
               feature_cols: Sequence[str]) -> DataFrame:
    """One row — split dates, label columns, the ordered feature list and
    ``results: map<model, struct<rmse_log, r2_log, rmse_raw>>`` built from the
    comparison table by a Spark aggregate."""
    # A global aggregate always yields exactly one row; the literals ride on it.
    return comparison.agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("model"), F.struct("rmse_log", "r2_log", "rmse_raw")))).alias("results")).select(
        F.lit(run_id).alias("run_id"), F.lit(parquet_path).alias("parquet_path"),
        F.lit(train_end).alias("train_end"), F.lit(test_start).alias("test_start"),
        F.lit(test_end).alias("test_end"),
        F.struct(*[F.lit(v).alias(k) for k, v in LABEL_COLS.items()]).alias("label_cols"),
        F.array(*[F.lit(c) for c in feature_cols]).alias("feature_cols"),
        "results")


def metrics_summary(comparison: DataFrame, start: str, end: str) -> DataFrame:
    """S10 (tidy form): (start, end, model, metric, value) for the four metrics."""
    cols = [c for c in ("rmse_log", "r2_log", "rmse_raw", "r2_raw") if c in comparison.columns]
    return (comparison.unpivot("model", cols, "metric", "value")
                      .select(F.lit(start).alias("start"), F.lit(end).alias("end"),
                              "model", "metric", "value"))


def summary_record(tidy: DataFrame, run_dir: str, features_parquet: str,
                   models: Sequence[str]) -> DataFrame:
    """S10 (nested form): one row with a model→value map per metric, the
    date range and the loaded model list, as the report writes it."""
    maps = (tidy.groupBy("start", "end")
                .pivot("metric", ["rmse_log", "r2_log", "rmse_raw", "r2_raw"])
                .agg(F.map_from_entries(F.collect_list(F.struct("model", "value")))))
    return maps.select(
        F.lit(run_dir).alias("run_dir"), F.lit(features_parquet).alias("features_parquet"),
        F.struct(F.col("start"), F.col("end")).alias("date_range"),
        "rmse_log", "r2_log", "rmse_raw", "r2_raw",
        F.array(*[F.lit(m) for m in models]).alias("models_loaded"),
        F.lit(_dt.datetime.now().isoformat()).alias("generated_at"))


def write_json_record(df: DataFrame, path: str) -> None:
    """A one-row record as a single JSON file folder."""
    df.coalesce(1).write.mode("overwrite").json(path)
