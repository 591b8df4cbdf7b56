"""Session helpers: sane defaults for local runs, shared folder for lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "daycast",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. On a cluster pass ``master=None`` and let
    spark-submit decide; locally this gives ``local[*]`` with AQE on and the
    UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster sets it; only when it is unset on a local master (tests) do
    we pick a fresh scratch folder ourselves — on a cluster an unset value
    is an error, never a machine-local folder."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store): "
                               "lineage cuts and written tables must survive executor loss")
        d = tempfile.mkdtemp(prefix="daycast-ckpt-")  # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (for written tables
    that cut lineage and survive executor loss)."""
    base = ensure_checkpoint_dir(spark)
    leaf = os.path.join(base, *parts) if parts else os.path.join(base, uuid.uuid4().hex)
    return leaf


def cut_lineage(df):
    """Materialise ``df`` with a reliable checkpoint in the shared
    ``spark.checkpoint.dir`` (survives executor loss; later uses re-read the
    files instead of recomputing the upstream plan)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
