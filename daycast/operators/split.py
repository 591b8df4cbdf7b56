"""Training frame, time split, completeness filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.functions.casting import nan_to_null
from daycast.functions.transforms import label_diff
from daycast.operators.schema import NON_FEATURES, feature_columns

LEAD_COLUMNS = ["date", "label", "label_log", "tx_log", "label_diff"]


class EmptySplitError(RuntimeError):
    """Raised when a split has no rows (e.g. train_end before the data)."""


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows that are NULL or NaN in any of ``subset``."""
    return nan_to_null(df, subset).dropna(subset=list(subset))


def training_frame(features: DataFrame, keys: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """P12 + P13: the complete rows with ``label_diff``, as keys, lead columns
    and the features by name. Returns (frame, features).

    ``keys`` (a series key) are carried in front: they are neither features
    nor required."""
    with_target = features.withColumn("label_diff", label_diff())
    feats = feature_columns(with_target.columns, NON_FEATURES, keys)
    complete = with_target.dropna(subset=[*LEAD_COLUMNS, *feats])
    return complete.select(*keys, *LEAD_COLUMNS, *feats), feats


def time_split(df: DataFrame, train_end: str, test_start: str, test_end: str,
               date: str = "date") -> tuple[DataFrame, DataFrame]:
    """Train is ``date <= train_end``; test is ``[test_start, test_end]``."""
    d = F.col(date)
    train = df.filter(d <= F.lit(train_end).cast("date"))
    test = df.filter(d.between(F.lit(test_start).cast("date"), F.lit(test_end).cast("date")))
    return train, test
