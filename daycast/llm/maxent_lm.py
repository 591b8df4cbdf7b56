"""Language-model scoring: a hashed maximum-entropy model with a class-factored
softmax.

A token's probability is P(class | context) * P(token | class). Classes are learned:
the ``ANCHORS`` most frequent words are anchors, and each of the ``CLASSED`` most frequent
words joins the anchor that it follows most beyond chance (the last anchor before it
counts); other words have hash classes. The class softmax has a bias and three hashed
features of the context — the last word, the last two words (n-gram) and the last word
before it that is among the ``SKIP_WORDS`` most frequent, over any rare words between
(skip) — each with a weight per class. Inside a class a token has the smoothed share
(c + 0.5) / (N_k + 0.5 (V_k + 1)) of the class's training tokens, one unseen word
included. So every text gets a proper probability, and the score differs from the
unigram base only by what the context tells about the class.

Training, every pass over all training documents (their token hashes are written once):
word counts; anchor counts; observed
feature-class counts, which are the gradient at zero and give the first weights; then
distributed gradient steps until they settle. What the weights expect of a token depends
on its context's three slots alone, so the distinct contexts of all training tokens are
counted once and every step runs over those. In a step workers add up the counts that the
current weights expect, sums are taken per block of features, and every weight moves along
observed less expected (less a small L2 pull), divided by the expected count, which is the
curvature of its bias-only problem, and goes on with ``MOMENTUM`` of its last move. A move
that lowers the penalised likelihood is taken back and halved. Training ends when a step
promises less than ``SETTLED`` nats a token; it has no fixed number of steps. Weights have a fixed size (3 x ``SLOTS`` x ``CLASSES``); counts
of words grow with the corpus and stay distributed.

Scoring: one pass scores classes in numpy batches and looks up the ``HOT_WORDS``
most frequent words (a bounded table that goes to every worker); rarer words of
a document are joined with the distributed counts. So no key of that join is
frequent in the training texts.

Defined results: null text is empty and has its end token; rows of one id, null
ids and equal rows are scored each; without any training document all counts
are 0 and the base and the score are those of the smoothing alone; other
columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import crc_mod, cut, lean_batches, lean_group, partitions_for, text_batches

ANCHORS = 24
RARE_CLASSES = 8     # hash classes of the words that no anchor has
CLASSES = ANCHORS + RARE_CLASSES
CLASSED = 32_768
SKIP_WORDS = 1_024
SLOTS = 4096  # per kind of feature
KINDS = 3
STEP, PULL = 0.7, 0.05
MOMENTUM = 0.4
SETTLED = 5e-4  # nats a token that a step must promise for another one
MAX_PASSES = 200  # raises beyond
HOT_WORDS = 200_000
FLUSH = 2_000_000
BATCH = 32_768
STEP_TOKENS = 2_048  # softmax rows at a time: they stay in the cache
CONTEXT_ENTRIES = 2_000_000  # of a bucket of contexts, before they are merged
CONTEXT_ROW, CONTEXT_STEP = 4_096, 8_192  # contexts in a row, contexts at a time: they stay in the cache
BLOCK_ROWS = 256
SCALE = 65_536  # expected counts are sent as integers of this fraction, so sums do not depend on their order
PRIOR = 4.0
END = np.uint64(0xC0DEC0DEC0DEC0DE)
_M = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def token_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words, then the end."""
    words = raw.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def hashed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``raw`` (UTF-8 texts, null: empty) replaced by the packed hashes of
    its tokens, written: every later pass reads them instead of hashing words again."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                packed = [token_hashes(t or b"").tobytes() for t in part.column("raw").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()) if n == "raw" else part.column(n) for n in names], names)

    return cut(rows.mapInArrow(run, rows.schema))


def _places(sorted_hashes: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each hash is in a sorted list, and whether it is there."""
    if not len(sorted_hashes):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    i = np.minimum(np.searchsorted(sorted_hashes, h), len(sorted_hashes) - 1)
    return i, sorted_hashes[i] == h


ONE = np.zeros(1, np.int64)  # where the texts begin, of one text


def last_before(marked: np.ndarray, begins: np.ndarray = ONE) -> np.ndarray:
    """The last marked place before each place in its text, or -1."""
    last = np.maximum.accumulate(np.where(marked, np.arange(len(marked)), -1))
    last = np.concatenate([[-1], last[:-1]]).astype(np.int64)
    last[last < np.repeat(begins, np.diff(np.append(begins, len(marked))))] = -1
    return last


@dataclass(frozen=True)
class Words:
    """Bounded word lists by hash, sorted: anchors, words with a learned class, skip words."""
    anchors: np.ndarray
    classed: np.ndarray
    klass: np.ndarray
    skip: np.ndarray

    def classes_of(self, h: np.ndarray) -> np.ndarray:
        i, known = _places(self.classed, h)
        rare = ANCHORS + (h & np.uint64(RARE_CLASSES - 1)).astype(np.int64)
        return np.where(known, self.klass[i], rare) if len(self.klass) else rare

    def context_rows(self, h: np.ndarray, begins: np.ndarray = ONE, marked: np.ndarray | None = None) -> np.ndarray:
        """Feature rows ``(token, kind)`` of the tokens of texts that begin at ``begins``;
        ``marked``: the skip words among them, if known."""
        one, two = np.zeros(len(h), np.uint64), np.zeros(len(h), np.uint64)
        one[1:], two[2:] = h[:-1], h[:-2]
        one[begins] = two[begins] = 0
        two[begins[begins + 1 < len(h)] + 1] = 0
        at = last_before(_places(self.skip, h)[1] if marked is None else marked, begins)
        skip = np.where(at >= 0, h[at], np.uint64(0))
        slot = lambda x: (x * _M[0] >> np.uint64(40) & np.uint64(SLOTS - 1)).astype(np.int64)
        return np.stack([slot(one), SLOTS + slot(one * _M[1] ^ two >> np.uint64(7)), 2 * SLOTS + slot(skip ^ _M[1])], axis=1)


def _joined(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts' hashes in a row, and where each text (of one token at least) begins."""
    lens = np.array([len(x) for x in held], np.int64)
    return np.concatenate(held), np.cumsum(lens) - lens


def _texts(batches: Iterator[pd.DataFrame]):
    """``(hashes, begins)`` of many documents at a time; long ones alone."""
    held, size = [], 0
    for pdf in batches:
        for raw in pdf["raw"]:
            held.append(np.frombuffer(raw, np.uint64))
            size += len(held[-1])
            if size >= BATCH:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _batches(batches: Iterator[pd.DataFrame], words: Words):
    """``(hashes, feature rows)`` of many documents at a time."""
    for h, begins in _texts(batches):
        yield h, words.context_rows(h, begins)


def _logits(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = weights[rows[:, 0]]
    for k in range(1, KINDS):
        z += weights[rows[:, k]]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    return z


def log_softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = _logits(weights, bias, rows)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


def softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = np.exp(_logits(weights, bias, rows))
    z /= z.sum(axis=1, keepdims=True)
    return z


def log_chosen(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Log probability of the class ``k`` of each row; classes lie along the first axis here."""
    z = _by_class(weights, bias, rows.T)
    z -= z.max(axis=0)
    own = z[k, np.arange(len(k))]
    return own - np.log(np.exp(z, out=z).sum(axis=0))


def _by_class(weights: np.ndarray, bias: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Logits ``(class, context)``."""
    z = np.take(weights, slots[0], axis=0)
    for k in range(1, KINDS):
        z += np.take(weights, slots[k], axis=0)
    z = np.ascontiguousarray(z.T)
    z += bias[:, None]
    return z


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = [], 0

    def flush():
        u, n = np.unique(np.concatenate(held), return_counts=True)
        return pd.DataFrame({"h": u.view(np.int64), "n": n.astype(np.int64)})

    for pdf in batches:
        for raw in pdf["raw"]:
            held.append(np.frombuffer(raw, np.uint64))
            size += len(held[-1])
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _send(matrix: np.ndarray) -> pd.DataFrame:
    """Integer matrix in packed blocks of rows."""
    blocks = np.array_split(matrix, max(1, len(matrix) // BLOCK_ROWS))
    return pd.DataFrame({"b": np.arange(len(blocks)), "m": [zlib.compress(x.astype("<i8").tobytes(), 1) for x in blocks]})


def _sum_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(m), "<i8") for m in pdf["m"])
    return pd.DataFrame({"b": [pdf["b"].iloc[0]], "m": [zlib.compress(total.tobytes(), 1)]})


def _gather(sent: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sum of the workers' matrices; the fixed-size result comes to the driver."""
    rows = sent.groupBy("b").applyInPandas(_sum_blocks, SENT).collect()
    parts = [np.frombuffer(zlib.decompress(bytes(r["m"])), "<i8") for r in sorted(rows, key=lambda r: r["b"])]
    return (np.concatenate(parts) if parts else np.zeros(shape[0] * shape[1])).reshape(shape).astype(np.float64)


SENT = "b int, m binary"


def _followed(anchors: np.ndarray, classed: np.ndarray):
    """How often each classed word has each anchor as the last one before it (the last
    column: none)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, held, size = np.zeros(len(classed) * (len(anchors) + 1), np.int64), [], 0
        for h, begins in _texts(batches):
            number, marked = _places(anchors, h)
            at = last_before(marked, begins)
            anchor = np.where(at >= 0, number[np.maximum(at, 0)], len(anchors))
            word, known = _places(classed, h)
            held.append((word * (len(anchors) + 1) + anchor)[known])
            size += len(held[-1])
            if size >= FLUSH:
                total += np.bincount(np.concatenate(held), minlength=len(total))
                held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        yield _send(total.reshape(len(classed), -1))
    return run


def learn_words(raw: DataFrame, hot: np.ndarray, hot_count: np.ndarray) -> Words:
    """Word lists and classes from training texts and the most frequent words."""
    order = np.lexsort((hot, -hot_count))
    ranked = hot[order][hot[order] != END]
    anchors, classed, skip = (np.sort(ranked[:n]) for n in (ANCHORS, CLASSED, SKIP_WORDS))
    if not len(classed):
        return Words(anchors, classed, np.zeros(0, np.int64), skip)
    m = _gather(raw.mapInPandas(lean_batches(_followed(anchors, classed)), SENT), (len(classed), len(anchors) + 1))
    share = np.maximum(m.sum(axis=0), 0.5) / max(m.sum(), 1)
    lift = (m + 4 * share) / (m.sum(axis=1, keepdims=True) + 4) / share
    return Words(anchors, classed, lift[:, :len(anchors)].argmax(axis=1).astype(np.int64), skip)


def _seen(words: Words):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(KINDS * SLOTS * CLASSES, np.int64)
        for h, rows in _batches(batches, words):
            total += np.bincount((rows * CLASSES + words.classes_of(h)[:, None]).ravel(), minlength=len(total))
        yield _send(total.reshape(-1, CLASSES))
    return run


def _pack(keys: np.ndarray) -> bytes:
    """Context keys, 12 bits a slot, in five bytes each."""
    return keys.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _slots(packed: bytes) -> np.ndarray:
    """Feature rows ``(kind, context)`` of packed keys."""
    raw = np.frombuffer(packed, np.uint8).reshape(-1, 5).T.astype(np.uint16)
    return np.stack([raw[0] | (raw[1] & 15) << 8, (raw[1] >> 4 | raw[2] << 4) + SLOTS, (raw[3] | (raw[4] & 15) << 8) + 2 * SLOTS])


def _send_contexts(words: Words, buckets: int):
    """Distinct contexts per flush with their numbers, by bucket."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            place = ((keys.astype(np.uint64) * _M[0] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(buckets + 1))
            parts = [(b, order[cuts[b]:cuts[b + 1]]) for b in range(buckets)]
            return pd.DataFrame([(b, _pack(keys[at]), n[at].astype("<i8").tobytes()) for b, at in parts if len(at)], columns=["b", "keys", "n"])

        for _, rows in _batches(batches, words):
            held.append(rows[:, 0] | (rows[:, 1] - SLOTS) << 12 | (rows[:, 2] - 2 * SLOTS) << 24)
            size += len(rows)
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()
    return run


def _merge_contexts(pdf: pd.DataFrame) -> pd.DataFrame:
    raw = np.frombuffer(b"".join(pdf["keys"]), np.uint8).reshape(-1, 5)
    keys = np.zeros((len(raw), 8), np.uint8)
    keys[:, :5] = raw
    keys, n = keys.view("<i8").ravel(), np.frombuffer(b"".join(pdf["n"]), "<i8")
    order = np.argsort(keys)
    first = np.flatnonzero(np.append(True, np.diff(keys[order]) > 0))
    keys, n = keys[order][first], np.add.reduceat(n[order], first)
    cuts = range(0, len(keys), CONTEXT_ROW)
    return pd.DataFrame({"keys": [_pack(keys[at:at + CONTEXT_ROW]) for at in cuts], "n": [n[at:at + CONTEXT_ROW].tobytes() for at in cuts]})


def contexts(raw: DataFrame, words: Words, tokens: float) -> DataFrame:
    """The distinct contexts of all training tokens and how often each comes, packed."""
    buckets = partitions_for(raw.sparkSession, int(tokens), CONTEXT_ENTRIES)
    sent = raw.mapInPandas(lean_batches(_send_contexts(words, buckets)), "b int, keys binary, n binary")
    return text_batches(cut(sent.groupBy("b").applyInPandas(lean_group(_merge_contexts), "keys binary, n binary")))


def _expected(weights: np.ndarray, bias: np.ndarray):
    """Counts that the weights expect; a last row holds the sum of the tokens' log
    normalisers."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, logs = np.zeros((KINDS, CLASSES, SLOTS), np.float64), 0.0

        def add(keys, n):
            nonlocal logs
            slots, n = _slots(b"".join(keys)), np.frombuffer(b"".join(n), "<i8").astype(np.float64)
            z = _by_class(weights, bias, slots)
            top = z.max(axis=0)
            z -= top
            np.exp(z, out=z)
            norm = z.sum(axis=0)
            logs += ((np.log(norm) + top) * n).sum()
            z *= (n / norm).astype(np.float32)
            for k in range(KINDS - 1):
                at = slots[k].astype(np.intp) - k * SLOTS
                for c in range(CLASSES):
                    total[k, c] += np.bincount(at, z[c], SLOTS)
            # merged contexts are sorted by their last kind: long runs of one slot
            first = np.flatnonzero(np.append(True, slots[-1][1:] != slots[-1][:-1]))
            np.add.at(total[-1].T, slots[-1][first].astype(np.intp) - (KINDS - 1) * SLOTS, np.add.reduceat(z, first, axis=1).T)

        keys, n, size = [], [], 0
        for pdf in batches:
            for k, c in zip(pdf["keys"], pdf["n"]):
                keys.append(k)
                n.append(c)
                size += len(c) // 8
                if size >= CONTEXT_STEP:
                    add(keys, n)
                    keys, n, size = [], [], 0
        if keys:
            add(keys, n)
        last = np.zeros((1, CLASSES))
        last[0, 0] = logs
        yield _send(np.rint(np.concatenate([*total.transpose(0, 2, 1), last]) * SCALE).astype(np.int64))
    return run


def train(raw: DataFrame, words: Words, rounds: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights (feature, class) and bias from training texts: gradient steps until they
    settle, or ``rounds`` of them."""
    shape = KINDS * SLOTS, CLASSES
    seen = _gather(raw.mapInPandas(lean_batches(_seen(words)), SENT), shape)
    by_class = seen[:SLOTS].sum(axis=0) + 0.5
    share = by_class / by_class.sum()
    bias = np.log(share)
    smooth = PRIOR * CLASSES * share
    # at zero weights the expected counts are known: each kind of feature gets half the log lift
    total = seen.sum(axis=1, keepdims=True)
    weights = np.log((seen + smooth) / (total + PRIOR * CLASSES) / share) / 2
    tokens = seen[:SLOTS].sum()
    known = contexts(raw, words, tokens)
    move, rate, best = np.zeros(shape), 1.0, None
    for done in range(MAX_PASSES if rounds is None else rounds):
        sums = _gather(known.mapInPandas(_expected(weights.astype(np.float32), bias.astype(np.float32)), SENT), (shape[0] + 1, CLASSES)) / SCALE
        expected, log_norm = sums[:-1], sums[-1, 0]
        pull = PULL * smooth * weights
        likely = (seen * weights).sum() + ((by_class - 0.5) * bias).sum() - log_norm - (pull * weights).sum() / 2
        if best is not None and likely < best[0]:
            rate, move = rate / 2, np.zeros(shape)  # back to the last point, with half its step
            likely, weights, step, _ = best
        else:
            gradient = seen - expected - pull
            step = np.clip(STEP * gradient / (expected + smooth), -1, 1)
            best = likely, weights, step, (gradient * step).sum()
        if rounds is None and best[3] <= SETTLED * tokens:
            break
        move = MOMENTUM * move + rate * step
        weights = weights + move
    else:
        if rounds is None:
            raise RuntimeError(f"the weights did not settle in {MAX_PASSES} passes")
    return weights.astype(np.float32), bias.astype(np.float32)


def _hot_count(counts: DataFrame, hot_words: int) -> int:
    """Smallest count such that at most ``hot_words`` words have as many, from a
    histogram on a logarithmic scale (a few hundred rows)."""
    steps = counts.groupBy(F.floor(F.log2("c") * 16).alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).collect()
    total, least = 0, 2**62
    for r in sorted(steps, key=lambda r: -r["step"]):
        total += r["n"]
        if total > hot_words:
            break
        least = r["c"]
    return least


PARTIAL = ("uid long, doc_id long, held_out boolean, n_tokens long, hot long, log_c double, log_class double, "
           "tail array<long>, times array<int>")


def _score(words, weights, bias, hot, hot_count, log_total):
    """Per document: what classes and frequent words give, and its rare words."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number = TaskContext.get().partitionId(), 0
        log_hot = np.log10(hot_count + 0.5)
        # what a token's place among the frequent words tells, so each is looked up once
        hot_class, hot_skip = words.classes_of(hot), _places(words.skip, hot)[1]
        listed = np.isin(words.classed, hot).all() and np.isin(words.skip, hot).all()
        for pdf in batches:
            texts = pdf["raw"].tolist()
            out, at = [], 0
            while at < len(texts):
                held, size = [], 0
                while at < len(texts) and (not held or size < BATCH):
                    held.append(np.frombuffer(texts[at], np.uint64))
                    size += len(held[-1])
                    at += 1
                h, begins = _joined(held)
                place, known = _places(hot, h)
                if listed and len(hot):
                    rows = words.context_rows(h, begins, known & hot_skip[place])
                    k = np.where(known, hot_class[place], ANCHORS + (h & np.uint64(RARE_CLASSES - 1)).astype(np.int64))
                else:
                    rows, k = words.context_rows(h, begins), words.classes_of(h)
                log_class = np.empty(len(h))
                for i in range(0, len(h), STEP_TOKENS):
                    log_class[i:i + STEP_TOKENS] = log_chosen(weights, bias, rows[i:i + STEP_TOKENS], k[i:i + STEP_TOKENS])
                log_class = log_class / np.log(10) - log_total[k]
                log_c = np.where(known, log_hot[place] if len(hot) else 0.0, 0.0)
                begin = 0
                for x in held:
                    s = slice(begin, begin + len(x))
                    rare, times = np.unique(x[~known[s]], return_counts=True)
                    out.append((len(x), int(known[s].sum()), float(log_c[s].sum()), float(log_class[s].sum()), rare.view(np.int64), times.astype(np.int32)))
                    begin += len(x)
            frame = pd.DataFrame(out, columns=["n_tokens", "hot", "log_c", "log_class", "tail", "times"])
            frame["doc_id"], frame["held_out"] = pdf["doc_id"].astype("Int64").values, pdf["held_out"].values
            frame["uid"] = (part << 40) + number + np.arange(len(frame))
            number += len(frame)
            yield frame[[c.split()[0] for c in PARTIAL.split(", ")]]
    return run


@dataclass(frozen=True)
class Model:
    words: Words
    weights: np.ndarray
    bias: np.ndarray
    hot: np.ndarray          # hashes of the most frequent words, sorted, and their counts
    hot_count: np.ndarray
    log_total: np.ndarray    # log10 of every class's smoothed total
    n_all: int
    v_all: int


def fit(training: DataFrame, counts: DataFrame, rounds: int | None = None, hot_words: int = HOT_WORDS) -> Model:
    """The model of training texts (``raw``: packed hashes) whose word counts (``h, c``) are given."""
    top = counts.where(F.col("c") >= _hot_count(counts, hot_words)).toPandas()  # at most hot_words rows
    hot = top["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hot)
    hot, hot_count = hot[order], top["c"].to_numpy(np.float64)[order]
    words = learn_words(training, hot, hot_count)

    # tokens and distinct words of each class: of the hash classes first, then those moved by learning
    by_class = np.zeros((CLASSES, 2))
    for r in counts.groupBy(F.col("h").bitwiseAND(RARE_CLASSES - 1).alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        by_class[ANCHORS + r["k"]] = r["n"], r["v"]
    n_all, v_all = int(by_class[:, 0].sum()), int(by_class[:, 1].sum())
    moved = hot_count[np.searchsorted(hot, words.classed)]
    for k, sign in ((ANCHORS + (words.classed & np.uint64(RARE_CLASSES - 1)).astype(np.int64), -1), (words.klass, 1)):
        by_class[:, 0] += sign * np.bincount(k, moved, CLASSES)
        by_class[:, 1] += sign * np.bincount(k, minlength=CLASSES)
    log_total = np.log10(by_class[:, 0] + 0.5 * (by_class[:, 1] + 1))
    weights, bias = train(training, words, rounds)
    return Model(words, weights, bias, hot, hot_count, log_total, n_all, v_all)


def lm_scores(docs: DataFrame, rounds: int | None = None, hot_words: int = HOT_WORDS) -> DataFrame:
    """The score report of every document."""
    rows = hashed(docs.select("doc_id", F.col("text").cast("binary").alias("raw"), (crc_mod(F.col("doc_id"), 5) == 1).alias("held_out")))
    training = rows.where("NOT held_out").select("raw")
    counts = cut(training.mapInPandas(lean_batches(_word_counts), "h long, n long").groupBy("h").agg(F.sum("n").alias("c")))
    m = fit(training, counts, rounds, hot_words)
    partial = cut(rows.mapInPandas(_score(m.words, m.weights, m.bias, m.hot, m.hot_count, m.log_total), PARTIAL))
    tail = (partial.where(F.size("tail") > 0).select("uid", F.explode(F.arrays_zip("tail", "times")).alias("x"))
            .select("uid", F.col("x.tail").alias("h"), F.col("x.times").alias("t")))
    got = tail.join(counts, "h", "left").select("uid", "t", F.coalesce("c", F.lit(0)).alias("c"))
    sums = got.groupBy("uid").agg(F.sum(F.col("t") * F.log10(F.col("c") + 0.5)).alias("tail_log"),
                                  F.sum(F.when(F.col("c") > 0, F.col("t")).otherwise(0)).alias("tail_known"))
    log_c = F.col("log_c") + F.coalesce("tail_log", F.lit(0.0))
    return partial.drop("tail", "times").join(sums, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("hot") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(m.n_all).cast("long").alias("train_tokens"),
        (log_c - F.col("n_tokens") * float(np.log10(m.n_all + 0.5 * (m.v_all + 1)))).alias("base_score"),
        (log_c + F.col("log_class")).alias("score"))
