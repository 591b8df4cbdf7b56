"""The report of a training run as one plan: reload models, score a date range
once, compare, and build every report table."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from daycast.operators.metrics import model_comparison
from daycast.operators.report import (report_bars, report_overlay, report_scatter,
                                      report_timeseries, residual_histogram)
from daycast.operators.split import EmptySplitError, time_split, training_frame
from daycast.session import shared_dir
from daycast.sources.models_io import discover_models, model_load_score
from daycast.sources.records import metrics_summary, summary_record, write_json_record


@dataclass
class Report:
    predictions: DataFrame
    comparison: DataFrame
    timeseries: DataFrame
    scatter: DataFrame
    residuals: DataFrame
    bars: DataFrame
    overlay: DataFrame
    summary: DataFrame


def run_report(spark: SparkSession, features: DataFrame, run_dir: str, start: str, end: str,
               models: Sequence[str] | None = None, keys: Sequence[str] = (), out_dir: str | None = None,
               features_path: str = "") -> Report:
    """Score ``[start, end]`` with the models saved in ``run_dir`` (default: all
    of them) and report on the predictions, which are written once and read
    back. With ``out_dir`` the metric summary is saved there as JSON."""
    frame, _ = training_frame(features, keys)
    _, rows = time_split(frame, start, start, end)
    names = discover_models(spark, run_dir, models)
    path = os.path.join(out_dir or shared_dir(spark), "predictions.parquet")
    scored = model_load_score(run_dir, rows, names)
    scored.write.mode("overwrite").parquet(path)
    pred = spark.read.schema(scored.schema).parquet(path)
    if pred.isEmpty():
        raise EmptySplitError(f"no complete rows between {start} and {end}")
    comparison = model_comparison(pred)
    summary = summary_record(metrics_summary(comparison, start, end), run_dir, features_path, names)
    if out_dir:
        write_json_record(summary, os.path.join(out_dir, "metrics_summary"))
    return Report(pred, comparison, report_timeseries(pred, keys), report_scatter(pred, keys),
                  residual_histogram(pred), report_bars(comparison), report_overlay(pred, names, keys), summary)
