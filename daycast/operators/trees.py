"""Tree models as node tables: read them from saved Spark ML models, and score rows by
joining them to the table level by level.

A node table has one row per node: tree, node, depth, feature (-1 in a leaf; a place in
the feature list), threshold (rows go left where ``value <= threshold``), the children's
node numbers, value and training rows. A prediction is the sum over trees of the value
of the leaf a row ends in; tree -1, if there is one, holds a base value."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.operators.boosting import NODES, complete

_COLUMNS = [x.split()[0] for x in NODES.split(", ")]


def _last_stage(spark: SparkSession, saved: str) -> str:
    """Folder of a saved pipeline's last stage (any Hadoop file system)."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(saved + "/stages")
    found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    names = [st.getPath().getName() for st in found]
    return f"{saved}/stages/{max(names, key=lambda n: int(n.split('_')[0]))}"


def _depths(nodes: pd.DataFrame) -> pd.DataFrame:
    """Depth of every node of one tree (at most 2 ** (depth + 1) rows)."""
    depth = {0: 0}
    for n, left, right in sorted(zip(nodes["node"], nodes["left"], nodes["right"])):
        if left >= 0:
            depth[left] = depth[right] = depth[n] + 1  # a parent's number is below its children's
    return nodes.assign(depth=[depth[n] for n in nodes["node"]])[_COLUMNS]


def node_table(spark: SparkSession, saved: str) -> DataFrame:
    """The node table of a saved Spark ML pipeline that ends in a tree or a forest, read
    from the model's own files. A forest's values are divided by its number of trees."""
    data = spark.read.parquet(_last_stage(spark, saved) + "/data")
    if "treeID" in data.columns:
        trees = data.select(F.countDistinct("treeID")).scalar()
        nodes = data.select(F.col("treeID").alias("tree"), "nodeData.*").withColumn("prediction", F.col("prediction") / trees)
    else:
        nodes = data.withColumn("tree", F.lit(0))
    inner = F.col("leftChild") >= 0
    none = F.lit(-1)
    flat = nodes.select(
        F.col("tree").cast("int").alias("tree"), F.col("id").cast("int").alias("node"), F.lit(0).alias("depth"),
        F.when(inner, F.col("split.featureIndex")).otherwise(none).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner, F.col("leftChild")).otherwise(none).alias("left"),
        F.when(inner, F.col("rightChild")).otherwise(none).alias("right"),
        F.col("prediction").alias("value"), F.col("rawCount").cast("bigint").alias("rows"))
    return flat.groupBy("tree").applyInPandas(_depths, NODES)


def walk(rows: DataFrame, nodes: DataFrame, feature_cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, tree, node): the leaf of every tree that each row ends in. One join a
    level; the node table is bounded by the model's parameters, the planner and AQE
    choose whether it is sent to the rows."""
    inner = nodes.where("tree >= 0")
    x = F.array(*[F.col(c).cast("double") for c in feature_cols])
    trees = inner.select(F.array_sort(F.collect_set("tree"))).scalar()
    at = complete(rows, feature_cols).select(*keys, x.alias("_x"), F.explode(trees).alias("tree"), F.lit(0).alias("node"))
    steps = inner.where("feature >= 0").select("tree", "node", "feature", "threshold", "left", "right")
    depth = nodes.agg(F.max("depth")).first()[0] or 0
    for _ in range(depth):
        left = F.get("_x", F.col("feature")) <= F.col("threshold")
        at = at.join(steps, ["tree", "node"], "left").select(
            *keys, "_x", "tree", F.when(F.col("feature").isNull(), F.col("node")).when(left, F.col("left"))
            .otherwise(F.col("right")).alias("node"))
    return at.select(*keys, "tree", "node")


def score_by_join(rows: DataFrame, nodes: DataFrame, feature_cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, prediction) of complete rows; ``keys`` name a row."""
    leaves = walk(rows, nodes, feature_cols, keys).join(
        nodes.where("feature < 0 AND tree >= 0").select("tree", "node", "value"), ["tree", "node"])
    base = nodes.where("tree < 0").select(F.coalesce(F.sum("value"), F.lit(0.0))).scalar()
    return leaves.groupBy(*keys).agg((F.sum("value") + base).alias("prediction"))


def leaf_means(train: DataFrame, nodes: DataFrame, feature_cols: Sequence[str], keys: Sequence[str], target: str) -> DataFrame:
    """(tree, node, value, rows, mean, n): every leaf's value and training rows as the
    model has them, and the mean target and number of the rows that end in it."""
    placed = walk(train, nodes, feature_cols, keys).join(train.select(*keys, target), list(keys))
    found = placed.groupBy("tree", "node").agg(F.avg(target).alias("mean"), F.count(F.lit(1)).alias("n"))
    return nodes.where("feature < 0 AND tree >= 0").select("tree", "node", "value", "rows").join(found, ["tree", "node"], "left")
