"""SentencePiece encoding and decoding by tables of distinct chunks.

No piece of such a vocabulary reaches over a whitespace marker, so a text is cut
before every run of markers (and, where no piece holds a newline, before every run
of newlines), each distinct chunk is segmented once by the sentencepiece library,
and the ids are joined back by position. Decoding is the library's ``decode(ids)``: it only
looks pieces up, so a table in front of it would cost more than it saves.

Whether the cuts are certain is read from the model: identity normalisation, a
marker put in front, white space kept, no piece with a marker behind another
character. For any other model each text is one chunk, so results stay the library's.

A task keeps one table of chunks, bounded in entries and in the length of an
entry; what is longer or pushed out is segmented again. Nothing is shuffled or
sent to the driver; a lost task is run again from its input rows.

Defined results: a null text counts as empty (begin and end ids only, empty decoded
text); null ids decode to null; texts of any length are cut alike; repeated rows
and ties give equal rows; an empty table gives an empty table; other columns pass
through, and a column with an output's name is replaced."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
TABLE_ENTRIES = 200_000
LONGEST_KEY = 256     # longer chunks are segmented without being remembered
TEXTS_AT_ONCE = 256
_LOADED: dict[str, PieceTables] = {}


class _Table(dict):
    """Distinct chunk -> number in order of appearance; new chunks wait for their ids."""

    def __init__(self):
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, chunk):
        self.waiting.append(chunk)
        self[chunk] = n = len(self)
        return n

    def take_waiting(self) -> list[str]:
        waiting, self.waiting = self.waiting, []
        return waiting


class PieceTables:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as model

        self.lib = SentencePieceProcessor(model_file=path)
        spec = model.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        kinds = model.ModelProto.SentencePiece
        words = [p.piece for p in spec.pieces if p.type not in (kinds.CONTROL, kinds.UNKNOWN, kinds.BYTE)]
        norm = spec.normalizer_spec
        plain = (not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces
                 and not norm.remove_extra_whitespaces and not spec.trainer_spec.treat_whitespace_as_suffix
                 and not any(p.type == kinds.USER_DEFINED for p in spec.pieces))
        self.cuts = plain and not any(re.search(f"[^{MARK}]{MARK}", w) for w in words)
        self.lines = self.cuts and not any("\n" in w for w in words)
        self.chunks = re.compile(f"{MARK}+[^{MARK}\n]*|\n+[^{MARK}\n]*" if self.lines else f"{MARK}+[^{MARK}]*")
        self.mark = [self.lib.piece_to_id(MARK)]
        self.begin, self.end = self.lib.bos_id(), self.lib.eos_id()
        self._new_encoder()

    def _new_encoder(self):
        self.enc = _Table()
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _segment(self, chunks: list[str]) -> list[np.ndarray]:
        """Ids of chunks as they stand inside a text. The library puts a marker in
        front of what it is given (but of nothing): the chunk's own first marker is left
        to it, and for a chunk that opens with a newline its id is taken off again."""
        ids = self.lib.encode([c[1:] if c[0] == MARK else c for c in chunks], num_threads=1)
        return [np.array(self.mark if c == MARK else i if c[0] == MARK else i[1:], np.uint32)
                for c, i in zip(chunks, ids)]

    def _learn(self):
        chunks = self.enc.take_waiting()
        if not chunks:
            return
        ids = self._segment(chunks)
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.flat = np.concatenate([self.flat, *ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, begin and end ids included."""
        if not self.cuts:
            return [np.array([self.begin, *i, self.end], np.uint32) for i in self.lib.encode(texts, num_threads=1)]
        out = []
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            if len(self.enc) > TABLE_ENTRIES:
                self._new_encoder()
            cut, long = [], {}
            for text in texts[at:at + TEXTS_AT_ONCE]:
                # an empty text has no marker put in front
                chunks = self.chunks.findall(MARK + text.replace(" ", MARK)) if text else []
                if max(map(len, chunks), default=0) > LONGEST_KEY:
                    long.update((c, None) for c in chunks if len(c) > LONGEST_KEY)
                cut.append(chunks)
            if long:
                long = dict(zip(long, self._segment(list(long))))
            look = self.enc.__getitem__
            known = [[c for c in chunks if c not in long] for chunks in cut] if long else cut
            numbers = [np.fromiter(map(look, chunks), np.int64, len(chunks)) for chunks in known]
            self._learn()
            for chunks, number in zip(cut, numbers):
                lens = self.count[number]
                ends = np.cumsum(lens)
                total = int(ends[-1]) if len(ends) else 0
                ids = self.flat[np.repeat(self.first[number] - (ends - lens), lens) + np.arange(total)]
                if long and any(c in long for c in chunks):
                    ids = self._with_long(chunks, long, ids, lens)
                whole = np.empty(len(ids) + 2, np.uint32)
                whole[0], whole[1:-1], whole[-1] = self.begin, ids, self.end
                out.append(whole)
        return out

    @staticmethod
    def _with_long(chunks, long, ids, lens) -> np.ndarray:
        """Put the ids of chunks that are not in the table at their places."""
        parts, at, taken = [], 0, 0
        sizes = lens.tolist()
        done = 0
        for c in chunks:
            if c in long:
                parts += [ids[taken:done], long[c]]
                taken = done
            else:
                done += sizes[at]
                at += 1
        return np.concatenate([*parts, ids[taken:]])

    def decode(self, rows: list[np.ndarray]) -> list[str]:
        """The library's string of each id sequence."""
        return self.lib.decode([r.tolist() for r in rows])


def piece_tables(path: str) -> PieceTables:
    """The process's tables of a model file (workers are used again)."""
    if path not in _LOADED:
        _LOADED[path] = PieceTables(path)
    return _LOADED[path]


def _replace(batch: pa.RecordBatch, drop: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    keep = [c for c in batch.schema.names if c not in drop and c not in new]
    return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *new.values()], [*keep, *new])


def _schema(df: DataFrame, drop: list[str], new: str) -> str:
    names = {*drop, *[x.split()[0] for x in new.split(",")]}
    kept = ["`{}` {}".format(f.name.replace("`", "``"), f.dataType.simpleString()) for f in df.schema if f.name not in names]
    return ", ".join([*kept, new])


def encode_pieces(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``text`` replaced by ``n_tokens`` (all ids) and ``ids`` (binary,
    little-endian unsigned 32-bit integers, begin and end ids included)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = piece_tables(path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                ids = tables.encode([t or "" for t in part.column(text).to_pylist()])
                yield _replace(part, [text], {
                    "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                    "ids": pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())})

    return df.mapInArrow(run, _schema(df, [text], "n_tokens bigint, ids binary"))


def decode_pieces(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the text that its packed ids stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = piece_tables(path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                packed = part.column(ids).to_pylist()
                texts = iter(tables.decode([np.frombuffer(p, "<u4") for p in packed if p is not None]))
                yield _replace(part, [], {"decoded": pa.array(
                    [None if p is None else next(texts) for p in packed], pa.string())})

    return df.mapInArrow(run, _schema(df, [], "decoded string"))


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, sha256 of the packed ids and of the decoded text."""
    both = decode_pieces(encode_pieces(docs.select("doc_id", "text"), path), path)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
