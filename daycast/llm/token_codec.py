"""Adaptive context-mixing range coder for token ids, and its file format.

A *block* is up to ``BLOCK`` ids coded from a fresh model, as lanes of ``LANE`` ids;
a *frame* is a run of whole documents as blocks, with document ids and lengths in its
header, and a CRC-32 over every block's ids, over its bytes and over the header. Frames are rows of a Parquet
folder, so files are splittable, live on any store Spark writes to and each
frame is decoded on its own.

Model. Order 2 (hash of the last two ids) and order 1 (last id) each
remember one predicted id and a confidence; order 0 counts high bytes, and low bytes
under each. An id is coded as binary decisions: is it what order 2 says, is it what
order 1 says, else its high byte and its low byte by the counts. The probability of a
decision is mixed from three adaptive predictions of it: by order 2's confidence, by
order 1's confidence and whether it agrees, and by the order-0 share of the predicted
id's high byte. They are weighted in the logistic domain, and the weights follow the
coding error. Mixing is done in whole numbers, so coder and decoder agree on any
machine. Decisions and symbols go through a 32-bit range coder with carry, 16 bits at
a time.

Blocks are independent. The lanes of a block are coded in step: one numpy operation
advances every lane by one id. They have one model, which learns from all ids of a step
after they are coded (of two lanes with the same slot the last one stays), so lanes may
be short and the tables stay in the cache. Every lane has a coder, and mixing weights,
of its own.

Defined results: null text is an empty document, which still has its end id;
null doc ids come last; rows of one id go by text hash, equal rows stay; other
columns are ignored; an empty table writes no frame and reads back empty. A
block whose checksum does not match raises. Ids must be under 65,536."""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daycast.llm.common import lean_batches, text_batches
from daycast.llm.tokens import chunk_ids
from daycast.session import shared_dir

LANE = 1024  # ids
BLOCK = 8192 * LANE
FRAME_IDS = BLOCK
MAGIC = b"TIDS"
MAX_ID = 1 << 16
_S2 = 1 << 18  # slots of order 2; order 1 has one an id
_TOTAL = 1 << 13  # of the counts as coded
_INC = 32
_EVERY = 32  # steps between two readings of the low bytes' counts


#: Logistic domain in 256ths: ln(p / (1 - p)) of a 12-bit probability, and back.
_STRETCH = np.array([round(256 * math.log(max(p, 0.5) / (4096 - max(p, 0.5)))) for p in range(4096)], np.int64)
_SQUASH = np.array([min(max(round(4096 / (1 + math.exp(-x / 256))), 24), 4072) for x in range(-2047, 2048)], np.int64)
#: Half the number of bits of a share in 4096ths: the states of the order-0 prediction.
_BITS = np.array([min(i.bit_length() // 2, 7) for i in range(4097)], np.int64)
_RATE, _PACE = 10, 64  # of the weights as a shift; of the adaptive predictions in decisions


def _sums(counts: np.ndarray) -> np.ndarray:
    """Running sums of each row's 256 counts, brought to ``_TOTAL`` (each at least one)."""
    out = np.zeros((len(counts), 257), np.int64)
    np.cumsum(1 + counts * (_TOTAL - 256) // counts.sum(axis=1, keepdims=True), axis=1, out=out[:, 1:])
    out[:, 256] = _TOTAL
    return out


class _Model:
    """Adaptive state, the same in coder and decoder: the tables are common to all
    lanes and learn from every lane's id of a step at once; weights are a lane's own."""

    def __init__(self, lanes: int):
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.t2, self.c2 = np.zeros(_S2, np.uint16), np.zeros(_S2, np.uint8)
        self.t1, self.c1 = np.zeros(MAX_ID, np.uint16), np.zeros(MAX_ID, np.uint8)
        self.count, self.low_count = np.ones((1, 256), np.int64), np.ones((256, 256), np.int64)
        self.missed: list[np.ndarray] = []
        # per decision: predictions by state (order 2, order 1, order 0), and weights
        self.chance = [[np.full(n, 2048, np.int64) for n in (8, 16, 8)] for _ in range(2)]
        self.weight = [np.full((3, lanes), 26_000, np.int64) for _ in range(2)]

    def predict(self, a: int, step: int):
        """Look the predictions up; which lanes have one of order 2."""
        self.high = _sums(self.count)[0]
        self.level = _BITS[self.count[0] * 4096 // self.count.sum()]
        if step & (step - 1) == 0 or step % _EVERY == 0:  # the low bytes follow their counts with a lag
            if self.missed:
                self.low_count += _INC * np.bincount(np.concatenate(self.missed), minlength=MAX_ID).reshape(256, 256)
                self.missed = []
            self.low, self.low_of = _sums(self.low_count).reshape(-1), None
        last = self.last[:a]
        self.i2, self.i1 = (self.before[:a] * 0x9E3779B1 + last * 0x85EBCA6B >> 12) & (_S2 - 1), last
        self.k2, self.k1 = self.c2[self.i2], self.c1[last]
        self.q2, self.q1 = self.t2[self.i2].astype(np.int64), self.t1[last].astype(np.int64)
        self.same = (self.k1 > 0) & (self.q1 == self.q2)
        return np.flatnonzero(self.k2 > 0)

    def find_high(self, v):
        """High bytes of values under ``_TOTAL``."""
        return np.repeat(np.arange(256), np.diff(self.high))[v]

    def find_low(self, high, v):
        """Their low bytes, under the high ones."""
        if self.low_of is None:  # by table: 2 MB, made when the counts are read
            self.low_of = np.repeat(np.tile(np.arange(256, dtype=np.uint8), 256), np.diff(self.low.reshape(256, 257)).reshape(-1))
        return self.low_of[high * _TOTAL + v]

    def second(self, lanes):
        """Of the lanes that are still open, those with another prediction of order 1."""
        return lanes[(self.k1[lanes] > 0) & ((self.k2[lanes] == 0) | ~self.same[lanes])]

    def mix(self, which: int, lanes):
        """12-bit probabilities that the decision's predicted id comes."""
        q = (self.q2, self.q1)[which][lanes]
        k2 = self.k2[lanes]
        agree = self.same[lanes] if which == 0 else k2 > 0
        self.at = (k2, self.k1[lanes] + 8 * agree, self.level[q >> 8])
        self.s = [_STRETCH[t][i] for t, i in zip(self.chance[which], self.at)]
        self.w = [w[lanes] for w in self.weight[which]]
        dot = self.w[0] * self.s[0] + self.w[1] * self.s[1] + self.w[2] * self.s[2] >> 16
        self.mixed = _SQUASH[np.clip(dot, -2047, 2047) + 2047]
        return self.mixed

    def learn_decision(self, which: int, lanes, hit):
        error = (hit.astype(np.int64) << 12) - self.mixed
        for weight, w, s in zip(self.weight[which], self.w, self.s):
            weight[lanes] = w + (s * error >> _RATE)
        for t, i in zip(self.chance[which], self.at):
            misses, hits = np.bincount(i + len(t) * hit, minlength=2 * len(t)).reshape(2, -1)
            t += (hits * 4095 - (misses + hits) * t) // (misses + hits + _PACE)

    def learn_id(self, a: int, x):
        for t, c, i, k, q in ((self.t2, self.c2, self.i2, self.k2, self.q2), (self.t1, self.c1, self.i1, self.k1, self.q1)):
            hit = (q == x) & (k > 0)
            c[i] = np.where(hit, np.minimum(k, 6) + 1, np.where(k > 1, k >> 1, 1))
            t[i] = np.where(hit | (k <= 1), x, q)
        self.count[0] += np.bincount(x >> 8, minlength=256)
        self.before[:a] = self.last[:a]
        self.last[:a] = x


_TOP = 4294967296.0


class _Encoder:
    """Coder state of all blocks in doubles: whole numbers under 2^53, so every
    step is exact, and division is vectorised."""

    def __init__(self, lanes: int, words: int):
        self.low, self.range = np.zeros(lanes), np.full(lanes, _TOP - 1)
        self.out, self.at = np.zeros((lanes, words), np.uint16), np.zeros(lanes, np.int64)

    def put(self, lanes, start, freq, total):
        r = np.floor(self.range[lanes] / total)
        low = self.low[lanes] + r * start
        rng = r * freq
        over = np.flatnonzero(low >= _TOP)
        if len(over):
            low[over] -= _TOP
            who = lanes[over]
            place = self.at[who] - 1
            while len(who):
                self.out[who, place] += 1
                on = self.out[who, place] == 0
                who, place = who[on], place[on] - 1
        short = np.flatnonzero(rng < 65536)
        if len(short):
            who, some = lanes[short], low[short]
            word = np.floor(some / 65536)
            self.out[who, self.at[who]] = word
            self.at[who] += 1
            low[short] = (some - word * 65536) * 65536
            rng[short] *= 65536
        self.low[lanes], self.range[lanes] = low, rng

    def finish(self) -> list[bytes]:
        lanes = np.arange(len(self.low))
        low = self.low.astype(np.int64)
        for word in (low >> 16, low & 0xFFFF):
            self.out[lanes, self.at] = word
            self.at += 1
        return [self.out[i, :n].astype("<u2").tobytes() for i, n in enumerate(self.at.tolist())]


class _Decoder:
    def __init__(self, payloads: list[bytes]):
        lens = [len(p) // 2 for p in payloads]
        self.words = np.zeros((len(payloads), max(lens) + 2), np.uint16)
        for i, p in enumerate(payloads):
            self.words[i, :lens[i]] = np.frombuffer(p, "<u2")
        self.code = self.words[:, 0] * 65536.0 + self.words[:, 1]
        self.at, self.range = np.full(len(payloads), 2, np.int64), np.full(len(payloads), _TOP - 1)

    def value(self, lanes, total):
        self.r = np.floor(self.range[lanes] / total)
        return np.minimum(np.floor(self.code[lanes] / self.r), total - 1)

    def take(self, lanes, start, freq):
        code, rng = self.code[lanes] - self.r * start, self.r * freq
        short = np.flatnonzero(rng < 65536)
        if len(short):
            who = lanes[short]
            code[short] = code[short] * 65536 + self.words[who, np.minimum(self.at[who], self.words.shape[1] - 1)]
            self.at[who] += 1
            rng[short] *= 65536
        self.code[lanes], self.range[lanes] = code, rng


def _f(a):
    return a.astype(np.float64)


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Payload of each block of ids: its lanes' sizes in bytes, and the lanes."""
    out = []
    for block in blocks:
        lanes = _encode_lanes([block[i:i + LANE] for i in range(0, len(block), LANE)])
        out.append(np.array([len(p) for p in lanes], "<u4").tobytes() + b"".join(lanes))
    return out


def decode_blocks(payloads: list[bytes], counts: list[int]) -> list[np.ndarray]:
    """The ids of each block."""
    out = []
    for payload, count in zip(payloads, counts):
        n = -(-count // LANE)
        sizes = np.frombuffer(payload, "<u4", n).astype(np.int64) if n else np.empty(0, np.int64)
        ends = 4 * n + np.cumsum(sizes)
        if n and ends[-1] != len(payload):
            raise ValueError("a block's lanes do not fill it")
        lanes = _decode_lanes([payload[e - k:e] for e, k in zip(ends.tolist(), sizes.tolist())],
                              [min(LANE, count - LANE * i) for i in range(n)])
        out.append(np.concatenate([np.empty(0, np.uint32), *lanes]))
    return out


def _encode_lanes(blocks: list[np.ndarray]) -> list[bytes]:
    """Payload of each lane of a block, all coded in step."""
    if not blocks:
        return []
    sizes = np.array([len(b) for b in blocks])
    order = np.argsort(-sizes, kind="stable")
    if any(b.max(initial=0) >= MAX_ID for b in blocks):
        raise ValueError(f"ids must be under {MAX_ID}")
    ids = np.zeros((len(blocks), sizes.max()), np.uint16)
    for lane, b in enumerate(order):
        ids[lane, :sizes[b]] = blocks[b]
    ids = np.ascontiguousarray(ids.T)
    active = np.searchsorted(-sizes[order], -np.arange(sizes.max()), side="left")  # lanes longer than the step
    model, coder = _Model(len(blocks)), _Encoder(len(blocks), int(sizes.max()) * 4 + 4)
    for step, a in enumerate(active.tolist()):
        x, open_ = ids[step, :a].astype(np.int64), np.ones(a, bool)
        lanes = model.predict(a, step)
        for which in (0, 1):
            if which:
                lanes = model.second(np.flatnonzero(open_))
            if len(lanes):
                p = _f(model.mix(which, lanes))
                hit = x[lanes] == (model.q1 if which else model.q2)[lanes]
                coder.put(lanes, np.where(hit, 0, p), np.where(hit, p, 4096 - p), 4096.0)
                model.learn_decision(which, lanes, hit)
                open_[lanes[hit]] = False
        miss = np.flatnonzero(open_)
        if len(miss):
            y = x[miss]
            high = y >> 8
            start = model.high[high]
            coder.put(miss, start, model.high[high + 1] - start, float(_TOTAL))
            start = model.low[y + high]
            coder.put(miss, start, model.low[y + high + 1] - start, float(_TOTAL))
            model.missed.append(y)
        model.learn_id(a, x)
    payloads = coder.finish()
    out: list = [b""] * len(blocks)
    for lane, b in enumerate(order):
        out[b] = payloads[lane]
    return out


def _decode_lanes(payloads: list[bytes], counts: list[int]) -> list[np.ndarray]:
    """The ids of each lane."""
    if not payloads:
        return []
    sizes = np.array(counts)
    order = np.argsort(-sizes, kind="stable")
    active = np.searchsorted(-sizes[order], -np.arange(sizes.max()), side="left")
    model, coder = _Model(len(payloads)), _Decoder([payloads[b] for b in order])
    ids = np.zeros((sizes.max(), len(payloads)), np.uint16)
    for step, a in enumerate(active.tolist()):
        open_ = np.ones(a, bool)
        lanes = model.predict(a, step)
        x = model.q2.copy()
        for which in (0, 1):
            if which:
                lanes = model.second(np.flatnonzero(open_))
            if len(lanes):
                p = _f(model.mix(which, lanes))
                hit = coder.value(lanes, 4096.0) < p
                coder.take(lanes, np.where(hit, 0, p), np.where(hit, p, 4096 - p))
                model.learn_decision(which, lanes, hit)
                open_[lanes[hit]] = False
                x[lanes[hit]] = (model.q1 if which else model.q2)[lanes[hit]]
        miss = np.flatnonzero(open_)
        if len(miss):
            v = coder.value(miss, float(_TOTAL)).astype(np.int64)
            high = model.find_high(v)
            start = model.high[high]
            coder.take(miss, start, model.high[high + 1] - start)
            v = coder.value(miss, float(_TOTAL)).astype(np.int64)
            y = high << 8 | model.find_low(high, v)
            start = model.low[y + high]
            coder.take(miss, start, model.low[y + high + 1] - start)
            model.missed.append(y)
            x[miss] = y
        model.learn_id(a, x)
        ids[step, :a] = x
    out: list = [None] * len(payloads)
    ids = np.ascontiguousarray(ids.T)
    for lane, b in enumerate(order):
        out[b] = ids[lane, :sizes[b]].astype(np.uint32)
    return out


def pack_frame(doc_ids: list, docs: list[np.ndarray]) -> bytes:
    """Header (document ids, lengths, blocks, checksums) and payloads."""
    ids = np.concatenate(docs)
    blocks = [ids[i:i + BLOCK] for i in range(0, len(ids), BLOCK)]
    payloads = encode_blocks(blocks)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    head = struct.pack("<III", len(docs), len(blocks), LANE) + known.tobytes()
    head += np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + np.array([len(d) for d in docs], "<u4").tobytes()
    head += b"".join(struct.pack("<IIII", len(b), len(p), zlib.crc32(b.astype("<u4").tobytes()), zlib.crc32(p)) for b, p in zip(blocks, payloads))
    return MAGIC + struct.pack("<II", len(head), zlib.crc32(head)) + head + b"".join(payloads)


def unpack_frame(frame: bytes) -> tuple[list, list[np.ndarray]]:
    """``(document ids, their token ids)``; raises on a bad checksum."""
    size, check = struct.unpack_from("<II", frame, 4)
    head = frame[12:12 + size]
    if frame[:4] != MAGIC or zlib.crc32(head) != check:
        raise ValueError("not a frame, or its header is damaged")
    n, m, _ = struct.unpack_from("<III", head, 0)
    known = np.frombuffer(head, np.uint8, n, 12)
    doc_ids = np.frombuffer(head, "<i8", n, 12 + n)
    lens = np.frombuffer(head, "<u4", n, 12 + 9 * n).astype(np.int64)
    table = np.frombuffer(head, "<u4", 4 * m, 12 + 13 * n).reshape(m, 4).astype(np.int64)
    ends = 12 + size + np.cumsum(table[:, 1])
    payloads = [frame[e - k:e] for e, k in zip(ends.tolist(), table[:, 1].tolist())]
    if [zlib.crc32(p) for p in payloads] != table[:, 3].tolist():
        raise ValueError("a block is damaged")
    blocks = decode_blocks(payloads, table[:, 0].tolist())
    for b, crc in zip(blocks, table[:, 2].tolist()):
        if zlib.crc32(b.astype("<u4").tobytes()) != crc:
            raise ValueError("a block's ids do not match their checksum")
    docs = np.split(np.concatenate(blocks), np.cumsum(lens)[:-1])
    return [d if k else None for d, k in zip(doc_ids.tolist(), known.tolist())], docs


FRAMES = "part int, frame int, n_ids long, data binary"


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, path: str) -> None:
    """Tokenise every text and write the frames, in ascending id order over
    (part, frame), to ``path``."""
    spark = docs.sparkSession

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part = chunk_ids(tokenizer_path), TaskContext.get().partitionId()
        names, held, size, frame = [], [], 0, 0
        for pdf in batches:
            for doc, ids in zip(pdf["doc_id"].astype(object).where(pdf["doc_id"].notna(), None), encoder.batch(pdf["text"].fillna("").tolist())):
                names.append(doc)
                held.append(np.append(ids, np.uint32(end_id)))
                size += len(ids) + 1
                if size >= FRAME_IDS:
                    yield pd.DataFrame([(part, frame, size, pack_frame(names, held))], columns=["part", "frame", "n_ids", "data"])
                    names, held, size, frame = [], [], 0, frame + 1
        if held:
            yield pd.DataFrame([(part, frame, size, pack_frame(names, held))], columns=["part", "frame", "n_ids", "data"])

    rows = text_batches(docs).select("doc_id", "text", F.xxhash64("text").alias("h"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("h")]
    (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
     .mapInPandas(lean_batches(run), FRAMES).write.parquet(path))


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Decode the frames: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``)
    per document; ``start`` counts the ids of all documents before it."""
    schema = "part int, frame int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, frame, data in zip(pdf["part"], pdf["frame"], pdf["data"]):
                names, docs = unpack_frame(data)
                lens = np.array([len(d) for d in docs], np.int64)
                out = pd.DataFrame({"part": part, "frame": frame, "doc_id": pd.array(names, dtype="Int64"), "at": np.cumsum(lens) - lens,
                                    "n_tokens": lens, "ids_crc32": [zlib.crc32(d.astype("<u4").tobytes()) for d in docs]})
                yield out.assign(ids=[d.astype(np.int32) for d in docs]) if with_ids else out

    frames = spark.read.schema(FRAMES).parquet(path)
    base = frames.select("part", "frame", F.coalesce(F.sum("n_ids").over(
        Window.orderBy("part", "frame").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    # one frame a row of a few MB: few rows a batch and a task of its own
    docs = frames.select("part", "frame", "data").mapInPandas(lean_batches(run), schema)
    return docs.join(base, ["part", "frame"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, with_ids: bool = False) -> DataFrame:
    """Write to a fresh folder under the shared one and read back."""
    path = shared_dir(docs.sparkSession)
    write_token_files(docs, tokenizer_path, end_id, path)
    return read_token_files(docs.sparkSession, path, with_ids)
