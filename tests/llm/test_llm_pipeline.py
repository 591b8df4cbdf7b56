"""The pipeline's stages: order, columns, decisions that take effect, and the
whole run against a plain-Python version of what it must keep."""

import collections
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
import edge
from daycast.llm import mixing, packing

public_tokenizers = pytest.importorskip("public_tokenizers")


def corpus():
    rows = [(i, edge.prose(i, 30 + i % 40), "en", f"s{i % 5}") for i in range(120)]
    rows += [(200 + i, edge.prose(i, 30 + i % 40) + " end", "en", f"s{i % 3}") for i in range(0, 40, 2)]  # near copies
    rows += [(300 + i, f"mail ab.c{i}@example.com card 4757965300669737 " + edge.prose(700 + i, 30), None, None) for i in range(12)]
    rows += [(400 + i, f"{i} 123 !!!", None, "junk") for i in range(5)]
    rows += [(500 + i, "été là où les élèves " + edge.prose(800 + i, 8) + " déjà vu", "fr", "s9") for i in range(30)]
    return rows


@pytest.fixture()
def folder(spark, tmp_path):
    from pyspark.sql import functions as F
    df = edge.frame(spark, corpus(), clash=False).withColumn("n_chars", F.length("text").cast("long"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard", "pii", "mixing", "packing"]


def test_stages_take_effect_and_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, seen[-1], folder)
        out.write.parquet(f"{folder}/{name}")
        seen.append(spark.read.parquet(f"{folder}/{name}"))
        if i < 4:
            assert seen[-1].columns == docs.columns and dict(seen[-1].dtypes) == dict(docs.dtypes)
    ids = [{r[0] for r in d.select("doc_id").collect()} for d in seen]
    assert ids[0] - ids[1] == set(range(400, 405))
    assert ids[1] - ids[2] == {200 + i for i in range(0, 40, 2)}
    assert ids[2] == ids[3]
    texts = {r["doc_id"]: r for r in seen[3].collect()}
    raw = {d: t for d, t, _, _ in corpus()}
    for d, r in texts.items():
        assert r["n_chars"] == len(r["text"])
        if 300 <= d < 320:
            assert "4757965300669737" not in r["text"] and f"ab.c{d - 300}@" not in r["text"]
        else:
            assert r["text"] == raw[d]
    assert all(r["lang"] for r in texts.values())
    copies = collections.Counter(r[0] for r in seen[4].select("doc_id").collect())
    assert set(copies.values()) <= {1, 2} and set(copies) <= ids[3]
    words = lambda t: len(re.findall(mixing.WORDS, t))
    total = sum(words(r["text"]) for r in texts.values())
    assert abs(sum(words(texts[d]["text"]) * n for d, n in copies.items()) - 1.5 * total) <= 600


def test_run_packs_exactly_the_mix(spark, folder):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, folder)
    want = collections.Counter()
    for r in docs.collect():
        ids = np.array(t.encode(r["text"], add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for length, _ in packing.cut_lengths(len(ids)):
            want[r["doc_id"], at, length, zlib.crc32(ids[at:at + length].tobytes())] += 1
            at += length
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want


def test_stages_on_edge_rows_and_empty_tables(spark, tmp_path):
    for name, rows in (("edge", edge.ROWS), ("empty", [])):
        path = str(tmp_path / name)
        edge.frame(spark, rows).write.parquet(f"{path}/documents.parquet")
        docs = spark.read.parquet(f"{path}/documents.parquet")
        for step, stage in corpus_pipeline.STAGES:
            stage(spark, docs, path).write.parquet(f"{path}/{step}")
            docs = spark.read.parquet(f"{path}/{step}")
        assert (docs.count() > 0) == bool(rows)


def test_language_is_told_once_a_text(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.STAGES[0][1](spark, docs, folder)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # the filter on the answer must not predict again


def test_workers_give_memory_back():
    import pandas as pd

    from daycast.llm import common

    calls = []
    now, common.give_back = common.give_back, lambda: calls.append(1)
    try:
        one = pd.DataFrame({"a": [1, 2]})
        assert common.lean_group(lambda pdf: pdf * 2)(one)["a"].tolist() == [2, 4] and len(calls) == 1
        run = common.lean_batches(lambda batches: (b + 1 for b in batches))
        assert [b["a"].tolist() for b in run(iter([one, one]))] == [[2, 3], [2, 3]] and len(calls) == 2
    finally:
        common.give_back = now
    common.give_back()
