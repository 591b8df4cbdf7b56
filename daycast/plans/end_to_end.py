"""E4 — blocks (+ price) → enriched daily → features → Parquet → models."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from daycast.operators.models import ModelParams
from daycast.plans.enriched import enriched_daily
from daycast.plans.features import feature_table
from daycast.plans.train import TrainResult, train_and_compare
from daycast.session import shared_dir
from daycast.sources.files import features_scan, features_sink


def run_end_to_end(spark: SparkSession, blocks: DataFrame, price_raw: DataFrame | None,
                   start: str | None, end: str | None,
                   train_end: str, test_start: str, test_end: str,
                   label: str = "tx_count", mode: str = "daily", series: Sequence[str] = (),
                   work_dir: str | None = None, params: ModelParams | None = None) -> TrainResult:
    """The whole job with one configuration.

    The feature table is written to ``work_dir`` (default: a fresh folder
    under the shared ``spark.checkpoint.dir``) and read back, which cuts the
    lineage between feature engineering and training."""
    if mode != "daily":  # validated before any work starts
        raise ValueError("the end-to-end run needs mode='daily' (the price join is by day)")
    work = work_dir or shared_dir(spark, "end_to_end", os.urandom(6).hex())
    daily = enriched_daily(blocks, price_raw, start, end, series=series)
    features_path = os.path.join(work, "features.parquet")
    rows = features_sink(feature_table(daily, label=label, series=series), features_path)
    features = features_scan(spark, features_path)
    result = train_and_compare(features, train_end, test_start, test_end, params,
                               run_dir=os.path.join(work, "models"),
                               parquet_path=features_path, keys=series)
    result.feature_rows = rows
    return result
