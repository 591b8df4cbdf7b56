"""Log transforms, delta target and prediction reconstruction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_diff(label_log: str | Column = "label_log", today_log: str | Column = "tx_log") -> Column:
    """Training target: tomorrow's log minus today's log."""
    return (_c(label_log) - _c(today_log)).alias("label_diff")


def reconstruct(prediction: str | Column = "prediction", today_log: str | Column = "tx_log",
                log_name: str = "prediction_log", raw_name: str = "prediction_raw") -> list[Column]:
    """Delta prediction → log prediction → raw prediction clamped at zero.

    ``greatest`` skips NULLs, so a NULL prediction gives raw 0.0."""
    pred_log = _c(today_log) + _c(prediction)
    return [pred_log.alias(log_name),
            F.expm1(F.greatest(pred_log, F.lit(0.0))).alias(raw_name)]
