"""Packing documents into fixed-capacity sequences by Harmonic classes.

Class k takes pieces of length in (capacity/(k+1), capacity/k]; a bin of class k
always takes exactly k pieces, so bins of different classes — and full bins of
one class — never depend on each other. Since documents may be cut, a document
gives as many full-capacity pieces (class 1) as it can, and its rest is either
one piece, where k of its size fill a bin but for ``slack`` tokens, or first
gives a piece of capacity/(k+1) tokens (class k+1, whose bins it fills).

Workers cut on their own; the pieces' class numbers come from a prefix sum over
(class, worker) counts, so bins fill across workers and only the last bin of a
class stays open: under k pieces of each class, in all under one capacity of
tokens a class, whatever the input. These leftovers are packed together,
longest first, into the fullest bin they fit.

Defined results: null text is an empty document, which still has its end token;
equal rows are packed each; null ids are values like any other; other columns
are ignored; an empty table gives an empty result.

Scale: texts are read once and never shuffled; what is written and shuffled is
one narrow row per piece, by (class, bin) — at most ``capacity`` rows a group."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycast.llm.common import cut, lean_batches, text_batches
from daycast.llm.tokens import chunk_ids

CAPACITY = 2048
SLACK = CAPACITY // 32
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, klass int, worker int, number long"


def cut_lengths(total: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[tuple[int, int]]:
    """``(length, class)`` of the pieces of a document, in order."""
    out = [(capacity, 1)] * (total // capacity)
    rest = total % capacity
    while rest:
        k = capacity // rest
        if capacity - k * rest <= slack:
            out.append((rest, k))
            break
        k += 1
        out.append((capacity // k, k))
        rest -= capacity // k
    return out


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY,
           slack: int = SLACK, with_ids: bool = False) -> DataFrame:
    """Every document's pieces with their class and the worker's running number
    in it; ``with_ids`` adds the token ids themselves."""
    schema = PIECE + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = chunk_ids(tokenizer_path)
        worker = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        plans: dict[int, list] = {}
        for pdf in batches:
            ids_of = encoder.batch(pdf["text"].fillna("").tolist())
            rows = []
            for doc, ids in zip(pdf["doc_id"].astype(object).where(pdf["doc_id"].notna(), None), ids_of):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4", copy=False)
                n, at = len(ids), 0
                if n not in plans:
                    plans[n] = cut_lengths(n, capacity, slack)
                for length, k in plans[n]:
                    part = ids[at:at + length]
                    number = seen[k] = seen.get(k, -1) + 1
                    rows.append((doc, at, length, zlib.crc32(part.tobytes()), n, k, worker, number)
                                + ((part.astype(np.int32),) if with_ids else ()))
                    at += length
            if len(plans) > 50_000:
                plans.clear()
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return text_batches(docs).select("doc_id", "text").mapInPandas(lean_batches(run), schema)


def _leftovers(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # best fit of the longest first; ties by the piece's place
        pdf = pdf.sort_values(["length", "klass", "idx"], ascending=[False, True, True], kind="stable")
        room = np.empty(0, np.int64)
        bins, offsets = [], []
        for length in pdf["length"]:
            fits = np.flatnonzero(room >= length)
            b = fits[np.argmin(room[fits])] if len(fits) else len(room)
            if b == len(room):
                room = np.append(room, capacity)
            bins.append(b)
            offsets.append(capacity - room[b])
            room[b] -= length
        return pdf.assign(sequence_id=np.array(bins, np.int64) + pdf["bins_before"], offset=np.array(offsets, np.int64))
    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, slack: int = SLACK,
         with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``
    (and ``ids``) per piece; sequence ids are 0, 1, ... without gaps."""
    rows = cut(pieces(docs, tokenizer_path, end_id, capacity, slack, with_ids))
    counts = rows.groupBy("klass", "worker").agg(F.count(F.lit(1)).alias("n"))
    by_worker = Window.partitionBy("klass").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("klass", "worker", F.coalesce(F.sum("n").over(by_worker), F.lit(0)).alias("before"))
    # at most `capacity` classes: where each one's full bins begin
    classes = counts.groupBy("klass").agg(F.sum("n").alias("n_class")).withColumn(
        "full", F.floor(F.col("n_class") / F.col("klass")))
    classes = classes.withColumn("base", F.coalesce(F.sum("full").over(
        Window.orderBy("klass").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn(
        "bins_before", F.sum("full").over(Window.partitionBy()))
    placed = (rows.join(before, ["klass", "worker"]).join(F.broadcast(classes), "klass")
              .withColumn("idx", F.col("before") + F.col("number"))
              .withColumn("bin", F.floor(F.col("idx") / F.col("klass"))))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + (["ids"] if with_ids else [])
    inside = Window.partitionBy("klass", "bin").orderBy("idx")
    full = (placed.where("bin < full").withColumn("offset", F.sum("length").over(inside) - F.col("length"))
            .withColumn("sequence_id", F.col("base") + F.col("bin")).select(*names))
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "klass", "idx", "bins_before"] + (["ids"] if with_ids else [])
    rest = placed.where("bin >= full").select(*kept)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest.schema) + ", sequence_id long, offset long"
    # bounded by the capacity alone (see above), so one task may take it
    rest = rest.groupBy(F.lit(0).alias("_all")).applyInPandas(_leftovers(capacity), schema).select(*names)
    return full.unionByName(rest)
