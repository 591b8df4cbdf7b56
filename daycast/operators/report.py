"""The report's charts re-aimed as Spark result tables.

Inputs are prediction tables with ``model``, ``date``, ``label``,
``label_log``, ``prediction_log``, ``prediction_raw`` (see ``models.score``).
Every table is built with grouping, joins and windows — nothing is pulled to
the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.operators.metrics import SPACES

N_BINS = 40  # fixed value: histogram bins of the reference report


def _long(pred: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """One row per (model, space, series, date): real and predicted value.

    A single pass (``explode`` of one struct per space) rather than a union,
    so the prediction plan behind ``pred`` is evaluated once."""
    spaces = F.array(*[F.struct(F.lit(s).alias("space"), F.col(y).alias("real"),
                                F.col(p).alias("predicted"))
                       for s, (y, p) in SPACES.items()])
    return (pred.select("model", *series, "date", F.explode(spaces).alias("s"))
                .select("model", "s.space", *series, "date", "s.real", "s.predicted"))


def report_timeseries(pred: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Date, real and predicted in log and raw units, per model and series,
    by date."""
    return (pred.select("model", *series, "date", "label", "label_log", "prediction_log", "prediction_raw")
                .orderBy("model", *series, "date"))


def report_scatter(pred: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """R2: (real, predicted) pairs with the common min/max of the y = x line
    of their (model, space) panel.

    The bounds are a partial/final aggregate (one row per panel), joined back
    onto the pairs — never a whole panel in one task."""
    long = _long(pred, series)
    bounds = long.groupBy("model", "space").agg(
        F.least(F.min("real"), F.min("predicted")).alias("line_min"),
        F.greatest(F.max("real"), F.max("predicted")).alias("line_max"))
    return long.join(bounds, ["model", "space"]).select(
        "model", "space", *series, "date", "real", "predicted", "line_min", "line_max")


def residual_histogram(pred: DataFrame, bins: int = N_BINS) -> DataFrame:
    """``predicted − real`` in ``bins`` equal-width bins per (model, space).

    Bin edges follow the usual histogram rule: [min, max] split evenly, the
    last bin closed on the right, a zero-width range widened by ±0.5. Rows
    without a residual (a NULL on either side) are in no bin. Empty bins are
    kept (left join of a bins × panels grid, bounded by #panels × bins rows)."""
    res = (_long(pred).select("model", "space", (F.col("predicted") - F.col("real")).alias("resid"))
           .where("resid IS NOT NULL"))
    bounds = (res.groupBy("model", "space")
                 .agg(F.min("resid").alias("mn"), F.max("resid").alias("mx"))
                 .select("model", "space",
                         F.when(F.col("mx") == F.col("mn"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                         F.when(F.col("mx") == F.col("mn"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi")))
    place = F.floor((F.col("resid") - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo")))) + 1
    binned = (res.join(bounds, ["model", "space"])
                 .select("model", "space", F.least(place, F.lit(bins)).cast("int").alias("bin"))
                 .groupBy("model", "space", "bin").agg(F.count(F.lit(1)).alias("count")))
    grid = bounds.select("model", "space", "lo", "hi",
                         F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (grid.join(binned, ["model", "space", "bin"], "left")
                .select("model", "space", "bin",
                        (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_lo"),
                        (F.col("lo") + F.col("bin") * width).alias("bin_hi"),
                        F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def report_bars(comparison: DataFrame) -> DataFrame:
    """One value per (metric, model) for the four comparison charts."""
    cols = [c for c in comparison.columns if c != "model"]
    return comparison.unpivot("model", cols, "metric", "value")


def report_overlay(pred: DataFrame, models: Sequence[str], series: Sequence[str] = ()) -> DataFrame:
    """Real value and every model's prediction by series and date, log and raw.

    One hash aggregate by (space, series, date) with a conditional ``first`` per
    model (the pivot written out, no extra distinct job, no self-join)."""
    long = _long(pred, series)
    per_model = [F.first(F.when(F.col("model") == m, F.col("predicted")), ignorenulls=True).alias(m)
                 for m in models]
    return long.groupBy("space", *series, "date").agg(F.first("real").alias("real"), *per_model)
