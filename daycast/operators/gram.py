"""M3 from one aggregate: centred Gram matrices, merged exactly, and the elastic net
solved on them — for a whole table or for every series of it.

The state of a set of rows is (n, means, centred cross products) of the features and the
target. Two states merge without looking at rows again (the means' difference gives the
correction), so each task folds its own rows, whatever the keys, and the shuffle carries
one state per task and series: its size depends on the number of columns only. States of
one series are merged in two steps, so that no task takes those of all tasks.

The elastic net of the standardised problem needs nothing but that matrix; coordinate
descent runs on it per series (some 100 x 100 numbers). Its optimality is certified by the
subgradient: with correlations ``A`` among features and ``b`` with the target, penalties
``l1`` and ``l2``, every coefficient obeys ``b - A w - l2 w = l1 sign(w)``, or lies within
``l1`` where it is zero. ``residual`` is the largest violation.

Penalties follow Spark ML's linear regression on standardised features and target, so
coefficients equal its own. Rows with a NULL or NaN are skipped; a column without
variance gets coefficient 0; a target without variance gives the mean."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.operators.boosting import complete
from daycast.session import shared_dir

HELD = 64            # series whose states a task holds before it sends them on
SLICES = 16          # first merging step: parts of one series' states
FOLD_ROWS = 65_536   # rows folded by one matrix product
SWEEPS = 100_000
MODEL_CLASS = "daycast.operators.gram.SeriesLinearModel"
STATE = "n bigint, mean array<double>, cross array<double>"


def add_states(a: tuple, b: tuple) -> tuple:
    """Merge (n, mean, cross) of two disjoint sets of rows."""
    (na, ma, ca), (nb, mb, cb) = a, b
    if na == 0 or nb == 0:
        return a if nb == 0 else b
    n, d = na + nb, mb - ma
    return n, ma + d * (nb / n), ca + cb + np.outer(d, d) * (na * nb / n)


def fold(x: np.ndarray) -> tuple:
    """State of rows."""
    mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    c = x - mean
    return len(x), mean, c.T @ c


def _states(keys: list[str], cols: list[str], key_types: list[pa.DataType]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}

        def send():
            rows = list(held.items())
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([k[i] for k, _ in rows], t) for i, t in enumerate(key_types)],
                 pa.array([s[0] for _, s in rows], pa.int64()), pa.array([s[1].tolist() for _, s in rows], pa.list_(pa.float64())),
                 pa.array([s[2].ravel().tolist() for _, s in rows], pa.list_(pa.float64()))], [*keys, "n", "mean", "cross"])
            held.clear()

        for b in batches:
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in cols])
            names = list(zip(*[b.column(k).to_pylist() for k in keys])) if keys else [()] * len(x)
            code, found = pd.factorize(pd.Series(names, dtype=object))
            for i, key in enumerate(found):
                rows = x[code == i]
                for a in range(0, len(rows), FOLD_ROWS):
                    part = fold(rows[a:a + FOLD_ROWS])
                    held[key] = add_states(held[key], part) if key in held else part
                if len(held) >= HELD:
                    yield from send()
        if held:
            yield from send()
    return run


def _merge(names: list[str]):
    def run(states: pd.DataFrame) -> pd.DataFrame:
        states = states.sort_values("_task")
        total = None
        for n, mean, cross in zip(states["n"], states["mean"], states["cross"]):
            part = int(n), np.asarray(mean), np.asarray(cross).reshape(len(mean), len(mean))
            total = part if total is None else add_states(total, part)
        head = states[names].iloc[:1].reset_index(drop=True)
        return head.assign(n=total[0], mean=[total[1].tolist()], cross=[total[2].ravel().tolist()])
    return run


def gram_states(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, n, mean, cross): one state per series, of all complete rows of ``cols``."""
    from pyspark.sql.pandas.types import to_arrow_type
    keys, cols = list(by), list(cols)
    rows = complete(df, cols).select(*keys, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)])
    types = [rows.schema[k].dataType for k in keys]
    head = "".join(f"`{k}` {t.simpleString()}, " for k, t in zip(keys, types))
    parts = rows.mapInArrow(_states(keys, [f"_x{i}" for i in range(len(cols))], [to_arrow_type(t) for t in types]), head + STATE)
    parts = parts.withColumn("_task", F.spark_partition_id()).withColumn("_slice", F.col("_task") % SLICES)
    first = parts.groupBy(*keys, "_slice").applyInPandas(_merge([*keys, "_slice"]), f"{head}_slice int, {STATE}")
    last = first.withColumn("_task", F.col("_slice"))
    if not keys:
        return last.groupBy(F.lit(0).alias("_all")).applyInPandas(_merge([]), STATE)
    return last.groupBy(*keys).applyInPandas(_merge(keys), head + STATE)


def correlations(states: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, a, b, r): correlation of every pair of columns (a not after b in ``cols``);
    NULL where one has no variance."""
    k = len(cols)
    names = F.array(*[F.lit(c) for c in cols])
    pairs = F.explode(F.expr(f"flatten(transform(sequence(0, {k - 1}), i -> transform(sequence(i, {k - 1}), j -> struct(i, j))))"))
    at = lambda i, j: F.get("cross", i * k + j)
    i, j = F.col("p.i"), F.col("p.j")
    spread = F.sqrt(at(i, i)) * F.sqrt(at(j, j))
    flat = states.select(*by, "cross", pairs.alias("p"))
    return flat.select(*by, F.get(names, i).alias("a"), F.get(names, j).alias("b"),
                       F.when((at(i, i) > 0) & (at(j, j) > 0), at(i, j) / spread).alias("r"))


def elastic_net(n: int, mean: np.ndarray, cross: np.ndarray, reg: float, mix: float) -> tuple[float, np.ndarray, float]:
    """(intercept, coefficients, residual) from a state whose last column is the target."""
    spread = np.sqrt(np.maximum(np.diag(cross), 0) / max(n, 1))
    y, sy = mean[-1], spread[-1]
    live = np.flatnonzero(spread[:-1] > 1e-12 * np.maximum(np.abs(mean[:-1]), 1e-300))
    if n < 2 or sy <= 0 or not len(live):
        return float(y), np.zeros(len(mean) - 1), 0.0
    a = cross[np.ix_(live, live)] / n / np.outer(spread[live], spread[live])
    b = cross[live, -1] / n / (spread[live] * sy)
    l1, l2 = mix * reg / sy, (1 - mix) * reg / sy
    w, fit = np.zeros(len(live)), np.zeros(len(live))   # fit = a @ w
    size = np.diag(a) + l2

    def sweep(which) -> float:
        moved = 0.0
        for j in which:
            z = b[j] - fit[j] + a[j, j] * w[j]
            new = np.sign(z) * max(abs(z) - l1, 0.0) / size[j]
            if new != w[j]:
                fit[:] += a[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]))
                w[j] = new
        return moved

    for _ in range(SWEEPS):
        if sweep(range(len(live))) < 1e-13:
            break
        for _ in range(SWEEPS):  # the columns in use first, then all again
            if sweep(np.flatnonzero(w)) < 1e-13:
                break
    gap = b - a @ w - l2 * w
    residual = np.where(w != 0, np.abs(gap - l1 * np.sign(w)), np.maximum(np.abs(gap) - l1, 0)).max()
    coefficients = np.zeros(len(mean) - 1)
    coefficients[live] = w * sy / spread[live]
    return float(y - coefficients @ mean[:-1]), coefficients, float(residual)


def fit_elastic_nets(train: DataFrame, feature_cols: Sequence[str], target: str, reg: float, mix: float,
                     by: Sequence[str] = ()) -> DataFrame:
    """(by, n, intercept, coefficients, residual): a model per series, all from one pass
    over the rows."""
    keys = list(by)
    states = gram_states(train, [*feature_cols, target], keys)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for n, mean, cross in zip(pdf["n"], pdf["mean"], pdf["cross"]):
                m = np.asarray(mean)
                out.append(elastic_net(int(n), m, np.asarray(cross).reshape(len(m), len(m)), reg, mix))
            yield pdf[[*keys, "n"]].assign(intercept=[o[0] for o in out], coefficients=[o[1].tolist() for o in out],
                                           residual=[o[2] for o in out])

    head = "".join(f"`{k}` {train.schema[k].dataType.simpleString()}, " for k in keys)
    return states.mapInPandas(solve, f"{head}n bigint, intercept double, coefficients array<double>, residual double")


def score_linear(rows: DataFrame, models: DataFrame, feature_cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``rows`` (complete ones) with ``prediction`` of their series' model; rows of a
    series without a model are left out."""
    ready = complete(rows.drop("prediction"), feature_cols)
    m = F.struct(F.col("intercept").alias("b"), F.col("coefficients").alias("w")).alias("_m")
    if by:
        models = models.select(*[F.col(k).alias(f"_{k}") for k in by], m)
        joined = ready.join(models, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by]))
    else:
        joined = ready.withColumn("_m", models.select(m).scalar())  # one row
    x = F.array(*[F.col(c).cast("double") for c in feature_cols])
    total = F.aggregate(F.zip_with(x, "_m.w", lambda v, w: v * w), F.col("_m.b"), lambda s, t: s + t)
    return joined.select(*ready.columns, total.alias("prediction"))


class SeriesLinearModel:
    """A table of linear models, one row per series (one row in all without keys)."""

    def __init__(self, models: DataFrame, feature_cols: Sequence[str], by: Sequence[str] = ()):
        self.models, self.feature_cols, self.by = models, list(feature_cols), list(by)

    @classmethod
    def fit(cls, train: DataFrame, feature_cols: Sequence[str], target: str, reg: float, mix: float,
            by: Sequence[str] = ()) -> SeriesLinearModel:
        """Fitted in one pass; the table is written to the shared folder."""
        path = shared_dir(train.sparkSession)
        models = fit_elastic_nets(train, feature_cols, target, reg, mix, by)
        models.write.parquet(path)
        return cls(train.sparkSession.read.schema(models.schema).parquet(path), feature_cols, by)

    def transform(self, df: DataFrame) -> DataFrame:
        return score_linear(df, self.models, self.feature_cols, self.by)

    def save(self, path: str) -> None:
        spark = self.models.sparkSession
        self.models.write.mode("overwrite").parquet(path + "/models")
        spark.createDataFrame([(MODEL_CLASS, "linear_per_series", spark.version, self.feature_cols, self.by)],
                              "class string, uid string, sparkVersion string, featureCols array<string>, by array<string>"
                              ).coalesce(1).write.mode("overwrite").json(path + "/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SeriesLinearModel:
        meta = spark.read.json(path + "/metadata").first()
        return cls(spark.read.parquet(path + "/models"), meta["featureCols"], meta["by"] or [])
