"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with elastic net,
then temperature-calibrated.

Text is lower-cased and every run of other characters than letters becomes one
space. Features are character n-grams of 1 to 3, hashed to ``SLOTS``; a
document's vector is log(1 + count) * idf, scaled to length 1. Document
frequencies cover all training documents. The classifier is fitted on a bounded
sample of labelled documents (at most about ``TRAIN_ROWS``, spread evenly over the
labels, chosen by a hash of the text): three quarters train the weights, one
quarter fits the temperature. L1 keeps the weights sparse.

Defined results: null text and text without a letter give ``und`` and score 0,
as does everything when there is no labelled text; rows with a null label do
not train; null ids and equal rows are predicted each; other columns are
ignored; an empty table gives an empty result.

Scale: two passes over the texts (document frequencies, predictions) without a
shuffle of text; the model has a fixed size per label."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycast.llm.common import crc_mod, lean_batches, lean_group, text_batches

SLOTS = 1 << 15
TRAIN_ROWS = 3000
EPOCHS = 4
MINIBATCH = 16
ALPHA, BETA, L1, L2 = 8.0, 1.0, 2e-4, 1e-3
_OTHER = re.compile(r"[\W\d_]+")
# numbers that \w holds beside letters and digits: fractions, superscripts, numerals
_NUMBERS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
_NO_LETTER = re.compile(rf"[ {re.escape(_NUMBERS)}]+")
_PIECE = 1 << 20  # characters hashed at a time


def clean(text: str) -> str:
    """Letters, with single spaces around every run of them; empty without one."""
    words = _OTHER.sub(" ", text.lower()).strip()
    if words and not words.replace(" ", "").isalpha():  # rare, and the large class is slow
        words = _NO_LETTER.sub(" ", words).strip()
    return f" {words} " if words else ""


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of a cleaned text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    total = np.zeros(SLOTS, np.int64)
    for at in range(0, len(points), _PIECE):
        a = points[at:at + _PIECE + 2]
        h = a * np.uint32(0x9E3779B1)
        grams = [h[:_PIECE]]
        for _ in (2, 3):
            h = (h[:-1] ^ a[len(a) - len(h) + 1:]) * np.uint32(0x85EBCA6B)
            h = h ^ h >> np.uint32(15)
            grams.append(h[:_PIECE])
        total += np.bincount((np.concatenate(grams) * np.uint32(0xC2B2AE35) >> np.uint32(17)).astype(np.int64), minlength=SLOTS)
    return total


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and TF-IDF values (length 1) of a cleaned text."""
    n = counts(text)
    slots = np.flatnonzero(n)
    x = np.log1p(n[slots]) * idf[slots]
    norm = np.sqrt((x * x).sum())
    return slots, (x / norm if norm > 0 else x)


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    df, docs = np.zeros(SLOTS, np.int64), 0
    for pdf in batches:
        for text in pdf["text"]:
            text = clean(text or "")
            if text:
                df += counts(text) > 0
                docs += 1
    yield pd.DataFrame({"slot": np.append(np.arange(SLOTS), -1), "df": np.append(df, docs)})


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Smoothed idf of every slot over all the texts (a fixed-size result)."""
    df, docs = np.zeros(SLOTS), 0
    for r in text_batches(texts).select("text").mapInPandas(lean_batches(_frequencies), "slot int, df long").groupBy("slot").agg(F.sum("df").alias("df")).collect():
        if r["slot"] < 0:
            docs = r["df"]
        else:
            df[r["slot"]] = r["df"]
    return np.log((1 + docs) / (1 + df)) + 1


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, labels: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights ``(SLOTS + 1, labels)``; the last row is the bias, which has no
    penalty."""
    z = np.zeros((SLOTS + 1, labels))
    n = np.zeros((SLOTS + 1, labels))
    l1, l2 = np.full((SLOTS + 1, 1), L1), np.full((SLOTS + 1, 1), L2)
    l1[-1] = l2[-1] = 0

    def weights():
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + l2), 0)

    w, rng = weights(), np.random.default_rng(7)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for begin in range(0, len(y), MINIBATCH):
            at = order[begin:begin + MINIBATCH]
            dense = np.zeros((len(at), SLOTS + 1))
            dense[:, -1] = 1
            for row, i in enumerate(at):
                dense[row, x[i][0]] = x[i][1]
            p = softmax(dense @ w)
            p[np.arange(len(at)), y[at]] -= 1
            g = dense.T @ p / len(at)
            sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
            z += g - sigma * w
            n += g * g
            w = weights()
    return w


def scores(w: np.ndarray, slots: np.ndarray, values: np.ndarray) -> np.ndarray:
    return values @ w[slots] + w[-1]


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits that gives held-back labels most likelihood
    (golden-section search on its logarithm). Labels count as 1 - 1 / (n + 2)
    sure, so a sample without errors does not make every answer certain."""
    if not len(y):
        return 1.0

    doubt = 1 / (len(y) + 2)
    target = np.full(z.shape, doubt / max(1, z.shape[1] - 1))
    target[np.arange(len(y)), y] = 1 - doubt

    def loss(t):
        return -(target * np.log(np.maximum(softmax(z / np.exp(t)), 1e-300))).sum(axis=1).mean()

    lo, hi, ratio = -4.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(50):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _fit(idf: np.ndarray, labels: list[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "lang", "text"]).reset_index(drop=True)
        number = {label: i for i, label in enumerate(labels)}
        x = [vector(clean(t), idf) for t in pdf["text"]]
        x = [(s.astype(np.int32), v.astype(np.float32)) for s, v in x]
        y = np.array([number[v] for v in pdf["lang"]], np.int64)
        held = np.arange(len(y)) % 4 == 3
        w = fit_ftrl([x[i] for i in np.flatnonzero(~held)], y[~held], len(labels))
        z = np.array([scores(w, *x[i]) for i in np.flatnonzero(held)]).reshape(-1, len(labels))
        w = w / temperature(z, y[held])
        return pd.DataFrame({"label": labels, "w": [w[:, i].astype(np.float32).tobytes() for i in range(len(labels))]})
    return run


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``(labels, weights with the temperature in them, idf)`` from ``text,
    lang`` rows."""
    with_letters = labelled.where("lang IS NOT NULL AND text RLIKE '\\\\p{L}'").select("text", "lang")
    idf = inverse_frequencies(with_letters)
    drawn = with_letters.withColumn("h", F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(1 << 62)))
    # distinct texts of each label (one row per label), so copies neither fill nor empty the sample
    per = {r["lang"]: r["n"] for r in drawn.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = sorted(per)
    if not labels:
        return [], np.zeros((SLOTS + 1, 0), np.float32), idf
    share = -(-rows // len(labels))
    # candidates, about twice the share or all, then the share with the smallest hashes
    below = F.create_map(*[v for k in labels for v in (F.lit(k), F.lit(int(min(1.0, (2 * share + 100) / per[k]) * (1 << 62))))])
    candidates = drawn.where(F.col("h") < below[F.col("lang")]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    picked = candidates.withColumn("place", place).where(F.col("place") <= share).drop("place")
    # a bounded sample, fitted by one task
    fitted = picked.groupBy(F.lit(0).alias("_all")).applyInPandas(lean_group(_fit(idf, labels)), "label string, w binary").collect()
    w = {r["label"]: np.frombuffer(bytes(r["w"]), np.float32) for r in fitted}
    return labels, np.stack([w[k] for k in labels], axis=1), idf


def predict(docs: DataFrame, model: tuple) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``. Only texts go through the
    model: the other columns pass it by in the same rows."""
    from pyspark.sql.functions import pandas_udf

    labels, w, idf = model

    @pandas_udf("lang_pred string, score double")
    def identify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for some in texts:
            best, score = [], []
            for text in some:
                text = clean(text or "")
                if not text or not labels:
                    best.append("und")
                    score.append(0.0)
                    continue
                p = softmax(scores(w, *vector(text, idf)))
                i = int(p.argmax())
                best.append(labels[i])
                score.append(float(p[i]))
            yield pd.DataFrame({"lang_pred": best, "score": score})

    # not deterministic to the planner: a later filter on the answer would else predict every text twice
    identify = identify.asNondeterministic()
    return (text_batches(docs).withColumn("_language", identify("text"))
            .withColumns({"lang_pred": F.col("_language.lang_pred"), "score": F.col("_language.score")}).drop("_language"))


def is_training(docs: DataFrame) -> DataFrame:
    return docs.where(crc_mod(F.col("doc_id"), 4) != 2)


def language_report(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; learned from the documents that
    are not held out."""
    model = train(is_training(docs).select("text", "lang"))
    rows = docs.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")
