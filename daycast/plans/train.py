"""E3 — features → split → fit/score/save each model → comparison + run record."""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from daycast.operators import models as M
from daycast.operators.metrics import model_comparison
from daycast.operators.rollup import row_counts
from daycast.operators.split import EmptySplitError, time_split, training_frame
from daycast.session import shared_dir
from daycast.sources.files import features_scan, features_sink
from daycast.sources.models_io import model_save
from daycast.sources.records import run_record, write_json_record


@dataclass
class TrainResult:
    run_dir: str | None
    feature_cols: list[str]
    predictions: DataFrame      # union of every model's scored test rows
    comparison: DataFrame       # one row per model
    record: DataFrame           # one-row run record
    feature_rows: int | None = None   # rows of the written feature table (end-to-end runs)


def fit_models(train: DataFrame, feats: Sequence[str], p: M.ModelParams, keys: Sequence[str] = ()) -> dict:
    """Every model of ``p.models`` fitted on the training rows, which are laid
    out once and cached while the models are fitted."""
    rows = M.training_layout(train, p, keys).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {name: M.fit(name, rows, feats, p, keys) for name in p.models}
    finally:
        rows.unpersist()


def train_and_compare(features: DataFrame, train_end: str, test_start: str, test_end: str,
                      params: M.ModelParams | None = None, run_dir: str | None = None,
                      parquet_path: str = "", keys: Sequence[str] = ()) -> TrainResult:
    """Fit every model of ``params.models`` on ``date <= train_end``, score
    ``[test_start, test_end]``, compare, and (with ``run_dir``) save models and
    the run record.

    ``features`` is evaluated once: unless ``parquet_path`` says that it is
    read from there, it is written next to the run and read back. Predictions
    (with the series ``keys``) are written too, so reports do not score again."""
    spark = features.sparkSession
    p = params or M.ModelParams()
    work = run_dir or shared_dir(spark)
    if not parquet_path:
        parquet_path = os.path.join(work + "-features", "features.parquet")
        features_sink(features, parquet_path)
        features = features_scan(spark, parquet_path)
    frame, feats = training_frame(features, keys)
    train, test = time_split(frame, train_end, test_start, test_end)
    counts = row_counts(frame, train_end, test_start, test_end).first()   # one pass, one row
    if counts["n_train"] == 0 or counts["n_test"] == 0:
        raise EmptySplitError(f"empty split: train={counts['n_train']} rows, test={counts['n_test']} rows")
    preds = None
    for name, model in fit_models(train, feats, p, keys).items():
        if run_dir:
            model_save(model, run_dir, name)
        pred = M.score(model, test, name)
        preds = pred if preds is None else preds.unionByName(pred)
    path = os.path.join(work + "-predictions", "predictions.parquet")
    preds.write.mode("overwrite").parquet(path)
    preds = spark.read.schema(preds.schema).parquet(path)
    comparison = model_comparison(preds)
    run_id = os.path.basename(run_dir) if run_dir else _dt.datetime.now().strftime("%Y%m%d_%H%M%S")
    record = run_record(comparison, run_id, parquet_path, train_end, test_start, test_end, feats)
    if run_dir:
        write_json_record(record, os.path.join(run_dir, "run_info"))
    return TrainResult(run_dir, feats, preds, comparison, record)
