"""Save fitted pipelines, reload and score them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.operators import boosting, gram
from daycast.operators.models import PREFERRED_ORDER, Model, score

# models that are tables of their own
TABLES = {boosting.MODEL_CLASS: boosting.BoostedTreesModel, gram.MODEL_CLASS: gram.SeriesLinearModel}


def model_save(model: Model, run_dir: str, name: str) -> str:
    """Overwrite-save under ``<run_dir>/<name>``."""
    path = run_dir.rstrip("/") + "/" + name
    if isinstance(model, tuple(TABLES.values())):
        model.save(path)
    else:
        model.write().overwrite().save(path)
    return path


def model_load(spark: SparkSession, path: str) -> Model:
    """A saved model, by the class its metadata names."""
    kind = model_metadata(spark, path).select("class").first()[0]
    return TABLES[kind].load(spark, path) if kind in TABLES else PipelineModel.load(path)


def model_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The saved pipeline's metadata record (class, uid, Spark version, params)."""
    return spark.read.json(path.rstrip("/") + "/metadata")


def saved_params(spark: SparkSession, run_dir: str, names: Sequence[str]) -> DataFrame:
    """(model, stage, name, value): the parameters set on every stage of saved Spark ML
    pipelines, read from their files."""
    out = None
    for name in names:
        meta = spark.read.text(f"{run_dir}/{name}/stages/*/metadata")
        stage = F.element_at(F.split(F.get_json_object("value", "$.class"), r"\."), -1)
        params = F.from_json(F.get_json_object("value", "$.paramMap"), "map<string,string>")
        rows = meta.select(F.lit(name).alias("model"), stage.alias("stage"), F.explode(params).alias("name", "value"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _subfolders_with_metadata(spark: SparkSession, run_dir: str) -> list[str]:
    """Sub-folders of ``run_dir`` that hold a saved Spark ML object, listed
    through the Hadoop FileSystem API (works for local, HDFS and object-store
    paths alike)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(run_dir)
    fs = root.getFileSystem(conf)
    out = []
    for st in fs.listStatus(root):
        if st.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "metadata")):
            out.append(st.getPath().getName())
    return sorted(out)


def discover_models(spark: SparkSession, run_dir: str, names: Sequence[str] | None = None) -> list[str]:
    """Model folders of a run: the given list, else every sub-folder with the
    preferred ones first."""
    if names:
        return list(names)
    found = _subfolders_with_metadata(spark, run_dir)
    ordered = [m for m in PREFERRED_ORDER if m in found]
    return ordered + [m for m in found if m not in ordered]


def model_load_score(run_dir: str, test: DataFrame, names: Sequence[str] | None = None,
                     reconstruct_delta: bool = True) -> DataFrame:
    """Load each saved pipeline and score the test rows; one table with a
    ``model`` column (the union is lazy, models score in parallel tasks).
    ``reconstruct_delta=False`` scores older models that predict the label
    directly (see ``models.score``)."""
    out = None
    for name in discover_models(test.sparkSession, run_dir, names):
        pred = score(model_load(test.sparkSession, run_dir.rstrip("/") + "/" + name), test, name, reconstruct_delta)
        out = pred if out is None else out.unionByName(pred)
    if out is None:
        raise RuntimeError(f"{run_dir} holds no saved model")
    return out
