"""Shared helpers of the corpus operators: table reading, lineage cuts, keys
for repeated rows, and distributed connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: later
    uses re-read files that survive executor loss, and reads prune columns."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_batches(df: DataFrame, rows: int = 512) -> DataFrame:
    """``df``, with Arrow batches of at most ``rows`` rows from here on: whole
    texts go through Python workers, whose memory a batch must fit."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(name))
    if now <= 0 or now > rows:
        df.sparkSession.conf.set(name, str(rows))
    return df


def crc_mod(doc_id, n: int):
    """``crc32(doc_id as text) mod n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def partitions_for(spark: SparkSession, rows: int, per_task: int) -> int:
    """Shuffle width for ``rows`` rows at about ``per_task`` rows a task, never
    under the session's own setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def give_back() -> None:
    """Return freed memory to the system (where the C library can): workers are kept
    between stages, and what an idle one holds is missing to the rest of the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean_batches(f):
    """``f``, a function of ``mapInPandas``, that gives its memory back at the end."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from f(batches)
        give_back()
    return run


def lean_group(f):
    """``f``, a function of ``applyInPandas``, that gives its memory back at the end."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = f(pdf)
        give_back()
        return out
    return run


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replace a task's edges by a spanning forest of them (linear in nodes)."""
    parent: dict = {}

    def find(x):
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for pdf in batches:
        for u, v in zip(pdf["u"].tolist(), pdf["v"].tolist()):
            a, b = find(u), find(v)
            if a != b:
                if b < a:
                    a, b = b, a
                parent[b] = a
    nodes = list(parent)
    for i in range(0, len(nodes), 50_000):
        part = nodes[i:i + 50_000]
        yield pd.DataFrame({"u": part, "v": [find(x) for x in part]}, dtype=object)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; root is the smallest
    node of its component. Alternating large-star / small-star rounds, each
    written to the shared folder; nothing is collected but a checksum.

    Hot nodes are pre-aggregated map-side (``min``) and their joins are left to
    the skew-join rule. An edge list without rows gives an empty result."""
    spark = edges.sparkSession
    kind = edges.schema["u"].dataType.simpleString()
    local = edges.where("u <> v").mapInPandas(lean_batches(_forest), f"u {kind}, v {kind}")
    e = cut(local.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        e = cut(small)
        new = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(new) == state:
            break
        state = tuple(new)
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def as_uint64(a: np.ndarray) -> np.ndarray:
    return a.astype(np.int64, copy=False).view(np.uint64)
