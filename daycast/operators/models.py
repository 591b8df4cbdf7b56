"""M1–M8: regression models on the delta target.

Linear, tree and forest models are Spark ML pipelines (tree learners aggregate
split statistics per partition; the linear model uses one distributed
normal-equation pass or L-BFGS/OWL-QN passes for wide data); boosting is
:mod:`daycast.operators.boosting`.  The training table is at day grain, so
its size is bounded by the calendar, not by the raw data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor,
                                   LinearRegression, RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.functions.transforms import reconstruct
from daycast.operators.boosting import BoostedTreesModel, BoostParams, boost
from daycast.operators.gram import SeriesLinearModel

TARGET = "label_diff"

# The forest caches node ids per row instead of shipping 200 growing trees
# every pass (same result, ~10 % faster measured; the cache is checkpointed
# every 10 iterations into the shared checkpoint folder).  For one tree per
# pass (tree, plain GBT) the checkpoints cost more than they save.  Row samples
# of Spark ML are drawn per input partition, so the training rows get one fixed layout
# (``training_layout``): a seed gives the same forest on every cluster.


@dataclass
class ModelParams:
    """Defaults of the reference's command line (fixed values)."""
    lr_regparam: float = 0.05
    lr_elasticnet: float = 0.3
    dt_max_depth: int = 10
    dt_min_instances: int = 10
    rf_trees: int = 200
    rf_max_depth: int = 8
    rf_min_instances: int = 10
    rf_subsample: float = 0.7
    rf_feature_subset: str = "sqrt"
    seed: int = 42
    gbt_step: float = 0.05
    gbt_max_depth: int = 6
    gbt_subsample: float = 0.8
    gbt_feature_subset: str = "0.8"   # per tree in boosted_trees, per node in the plain GBT
    gbt_l2: float = 1.0
    gbt_rounds: int = 600
    # own parameter: partitions of the training rows, part of what a seed means
    train_partitions: int = 8
    models: Sequence[str] = field(default_factory=lambda: [
        "linear_regression", "decision_tree", "random_forest"])


# Preferred order of model folders (fixed value).
PREFERRED_ORDER = ["linear_regression", "decision_tree", "random_forest"]


def assembler(feature_cols: Sequence[str], output: str = "features") -> VectorAssembler:
    """M1: ordered columns → dense vector; rows with a NULL/NaN input are skipped."""
    return VectorAssembler(inputCols=list(feature_cols), outputCol=output, handleInvalid="skip")


def standardizer(input_col: str = "features", output: str = "scaledFeatures") -> StandardScaler:
    """M2: centre and scale by the sample standard deviation (fitted on train)."""
    return StandardScaler(inputCol=input_col, outputCol=output, withMean=True, withStd=True)


def linear_elastic_net(p: ModelParams) -> LinearRegression:
    """M3."""
    return LinearRegression(featuresCol="scaledFeatures", labelCol=TARGET, predictionCol="prediction",
                            regParam=p.lr_regparam, elasticNetParam=p.lr_elasticnet)


def decision_tree(p: ModelParams) -> DecisionTreeRegressor:
    """M4."""
    return DecisionTreeRegressor(featuresCol="features", labelCol=TARGET, predictionCol="prediction",
                                 maxDepth=p.dt_max_depth, minInstancesPerNode=p.dt_min_instances)


def random_forest(p: ModelParams) -> RandomForestRegressor:
    """M5."""
    return RandomForestRegressor(featuresCol="features", labelCol=TARGET, predictionCol="prediction",
                                 numTrees=p.rf_trees, maxDepth=p.rf_max_depth,
                                 minInstancesPerNode=p.rf_min_instances,
                                 subsamplingRate=p.rf_subsample,
                                 featureSubsetStrategy=p.rf_feature_subset, seed=p.seed,
                                 cacheNodeIds=True)


def boosted_trees(p: ModelParams) -> BoostParams:
    """M6: squared loss with an L2 leaf penalty, rows and columns sampled per tree."""
    return BoostParams(rounds=p.gbt_rounds, learning_rate=p.gbt_step, max_depth=p.gbt_max_depth,
                       row_share=p.gbt_subsample, column_share=float(p.gbt_feature_subset), l2=p.gbt_l2, seed=p.seed)


def gbt_regressor(p: ModelParams) -> GBTRegressor:
    """The plain boosting learner that older runs name: no leaf penalty, columns
    sampled per node, several jobs a round."""
    return GBTRegressor(featuresCol="features", labelCol=TARGET, predictionCol="prediction",
                        lossType="squared", stepSize=p.gbt_step, maxDepth=p.gbt_max_depth,
                        subsamplingRate=p.gbt_subsample, featureSubsetStrategy=p.gbt_feature_subset,
                        maxIter=p.gbt_rounds, seed=p.seed)


def pipeline_for(name: str, feature_cols: Sequence[str], p: ModelParams) -> Pipeline:
    asm = assembler(feature_cols)
    if name == "linear_regression":
        return Pipeline(stages=[asm, standardizer(), linear_elastic_net(p)])
    if name == "decision_tree":
        return Pipeline(stages=[asm, decision_tree(p)])
    if name == "random_forest":
        return Pipeline(stages=[asm, random_forest(p)])
    if name == "gbt_regressor":
        return Pipeline(stages=[asm, gbt_regressor(p)])
    raise ValueError(f"unknown model {name!r}")


def training_layout(train: DataFrame, p: ModelParams, keys: Sequence[str] = ()) -> DataFrame:
    """Training rows in ``train_partitions`` partitions by date, in date (and
    key) order inside each: the same for any number of cores or input files."""
    return train.repartition(p.train_partitions, "date").sortWithinPartitions("date", *keys)


Model = PipelineModel | BoostedTreesModel | SeriesLinearModel


def fit(name: str, train: DataFrame, feature_cols: Sequence[str], p: ModelParams, keys: Sequence[str] = ()) -> Model:
    """Fit one model; ``linear_per_series`` fits one for each value of ``keys``, the
    others one over all rows."""
    if name in ("boosted_trees", "xgboost"):
        return boost(train, feature_cols, TARGET, boosted_trees(p))
    if name == "linear_per_series":
        return SeriesLinearModel.fit(train, feature_cols, TARGET, p.lr_regparam, p.lr_elasticnet, keys)
    return pipeline_for(name, feature_cols, p).fit(train)


def score(model: Model, test: DataFrame, name: str | None = None,
          reconstruct_delta: bool = True) -> DataFrame:
    """M7 scoring half: transform, then delta → log → raw reconstruction.

    ``reconstruct_delta=False`` is direct scoring (M8) for models that predict
    the label itself: ``prediction`` is left as it is, to be scored against
    ``label`` with ``metrics.direct_metrics``.  Vector columns are dropped so
    the result is plain SQL types."""
    pred = model.transform(test)
    keep = [c for c in pred.columns if c not in ("features", "scaledFeatures")]
    out = pred.select(*keep, *(reconstruct("prediction", "tx_log") if reconstruct_delta else []))
    return out.withColumn("model", F.lit(name)) if name else out


def assembled_array(df: DataFrame, feature_cols: Sequence[str], keep: Sequence[str] = ("date",),
                    vector: str = "features") -> DataFrame:
    """M1 as a SQL-comparable table: ``vector_to_array`` of the assembler output."""
    out = assembler(feature_cols, vector).transform(df)
    return out.select(*keep, vector_to_array(vector).alias(vector))


def standardized_array(train: DataFrame, test: DataFrame, feature_cols: Sequence[str],
                       keep: Sequence[str] = ("date",)) -> DataFrame:
    """M2 as a table: the scaler is fitted on train, applied to test."""
    model = Pipeline(stages=[assembler(feature_cols), standardizer()]).fit(train)
    out = model.transform(test)
    return out.select(*keep, vector_to_array("scaledFeatures").alias("scaledFeatures"))
