"""Small files on any Hadoop file system (local, HDFS, object stores): list, read, and
write under a name that nobody has taken."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, p = _fs(spark, folder)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def commit_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file whole or not at all; raises if the name is taken."""
    fs, p = _fs(spark, path)
    _, draft = _fs(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(draft, p):
        fs.delete(draft, False)
        raise FileExistsError(path)
