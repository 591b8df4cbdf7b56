"""Regression metrics as distributed aggregates.

``rmse = sqrt(avg((y − p)²))`` and ``r2 = 1 − Σ(y − p)² / (var_pop(y)·n)``
equal Spark's ``RegressionEvaluator`` (no weights, not through the origin)
and are computed in one pass, per group when a model column is given."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (metric name, label column, prediction column) of the two spaces.
SPACES = {
    "log": ("label_log", "prediction_log"),
    "raw": ("label", "prediction_raw"),
}


def rmse(label: str, pred: str) -> Column:
    return F.sqrt(F.avg(F.pow(F.col(label) - F.col(pred), 2)))


def r2(label: str, pred: str) -> Column:
    """Over the rows that have both values, like the error sum."""
    both = F.col(label).isNotNull() & F.col(pred).isNotNull()
    ss_res = F.sum(F.pow(F.col(label) - F.col(pred), 2))
    ss_tot = F.var_pop(F.when(both, F.col(label))) * F.count_if(both)
    return F.lit(1.0) - ss_res / ss_tot


def regression_metrics(df: DataFrame, spaces: Sequence[str] = ("log", "raw"),
                       by: Sequence[str] = ()) -> DataFrame:
    """``rmse_<space>`` and ``r2_<space>`` columns, per ``by`` group."""
    aggs = []
    for s in spaces:
        y, p = SPACES[s]
        aggs += [rmse(y, p).alias(f"rmse_{s}"), r2(y, p).alias(f"r2_{s}")]
    return df.groupBy(*by).agg(*aggs)


def direct_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """M8: score ``prediction`` against ``label`` without reconstruction."""
    return df.agg(rmse(label, pred).alias("rmse"), r2(label, pred).alias("r2"))


def model_comparison(predictions: DataFrame) -> DataFrame:
    """One row per model (``model`` column) with RMSE/R² in log and raw space."""
    return regression_metrics(predictions, by=["model"])
