"""Exact token ids at scale: the tokenizers library, asked once per distinct word.

Both vocabularies cut text before merging; every cut used here is one they
make: at a single space or newline, and between a word and a comma or full stop
that ends it. Each distinct word without them, its core, is encoded once by the library,
many in one call, and remembered: told apart by the spaces that begin a token each where
the vocabulary is byte-level, by the tokens that end a word else, and where neither is
certain by a separator whose token cannot merge. A text's ids
are its chunks' ids in a row; the distinct chunks of many texts are found, cut and
looked up as Arrow columns. Texts for which those cuts are not certain — white
space meeting white space, or separators other than space and newline — are
encoded whole, as is a chunk whose closing stop does not follow a Latin letter.
The memory is bounded: when full, the half used most stays."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO = 200_000  # cores, about 60 bytes each; workers keep them while other stages run
#: White space other than single spaces and newlines between words.
OTHER_SPACE = [c for c in map(chr, range(0x10000)) if c.isspace() and c not in " \n"]
TOUCHING = ["  ", " \n", "\n ", "\n\n"]
SPACE = "\u0120"  # how byte-level vocabularies write a space
END = "</w>"  # how the others mark a word's end
GROUP = 1 << 21  # characters of texts looked up together
RUN = 256  # words joined in one text of the library: its tables of a long one leave the cache
_CACHE: dict[str, ChunkIds] = {}
#: Whether a stop's cut behind a code point is certain: a Latin letter, and one in lower case.
_LATIN = np.array([c < 0x250 and chr(c).isalpha() and chr(c).lower()[-1].isalpha() for c in range(2048)])
_OTHER = re.compile("[\u0130\u0250-\U0010ffff]")


class ChunkIds:
    """Chunks are words as the text has them; ``\\n`` in front stands for the
    newline before a word, ``\\0`` for no separator, nothing for a space. Cores have
    no newline and no cut stop."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # special strings in a text are ordinary text
        # a byte-level cut keeps the space with the word behind it
        self.spaced = self.tokenizer.normalizer is None
        # ids that begin with that space, or end a word: one a cut
        vocab = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocab.values()) + 1, bool)
        self.edge[[i for t, i in vocab.items() if (t[0] == SPACE if self.spaced else t.endswith(END))]] = True
        # single ids: newline (byte-level), the stops, the separator of joined words
        self.newline = self._encode(["\n"])[0][:1]
        self.stops = [self._encode([t])[0][0] for t in ".,"]
        self.mark = self._encode(["\n" if self.spaced else "|"])[0][0]
        self._reset()

    def _reset(self):
        self.cores = pa.array([], pa.large_string())
        self.first = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)
        self.uses = np.empty(0, np.int64)  # by the texts, halved at each forgetting
        self.flat = np.empty(0, np.uint32)

    @property
    def index(self) -> list[str]:
        """The remembered cores."""
        return self.cores.to_pylist()

    def _encode(self, texts):
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _append(self, ids: np.ndarray) -> int:
        """Store ids; returns where they begin."""
        begin = len(self.flat)
        self.flat = np.concatenate([self.flat, ids])
        return begin

    def _numbers(self, cores: pa.Array) -> np.ndarray:
        """Numbers of distinct cores; unseen ones are learned together."""
        known = pc.index_in(cores, value_set=self.cores)
        number = pc.fill_null(known, 0).to_numpy().astype(np.int64)
        if known.null_count:
            new = cores.filter(known.is_null())
            number[known.is_null().to_numpy(zero_copy_only=False)] = len(self.cores) + np.arange(len(new))
            first, count = self._encode_new(new.to_pylist())
            self.cores = pa.concat_arrays([self.cores, new])
            self.first, self.count = np.concatenate([self.first, first]), np.concatenate([self.count, count])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        return number

    def _encode_new(self, cores: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Store the ids of new cores: their places."""
        first, count = np.zeros(len(cores), np.int64), np.zeros(len(cores), np.int64)
        mark = "\n" if self.spaced else "|"
        bare = {i for i, c in enumerate(cores) if c[:1] == "\0"}
        alone = [i for i, c in enumerate(cores) if mark in c]
        text = lambda c: c[1:] if c[:1] == "\0" else " " + c if self.spaced else c
        # cores that cut themselves: each has one id that begins with the space, or that ends a word
        rest = np.ones(len(cores), bool) if self.spaced else np.array([_one_word(c) for c in cores], bool)
        rest[[*bare, *alone]] = False
        at = np.flatnonzero(rest).tolist()
        if at:
            lead = " " if self.spaced else ""
            runs = [at[i:i + RUN] for i in range(0, len(at), RUN)]
            ids = np.concatenate(self._encode([lead + " ".join([cores[i] for i in run]) for run in runs]))
            cuts = np.flatnonzero(self.edge[ids])
            if len(cuts) != len(at) or not self.spaced and cuts[-1] != len(ids) - 1:
                raise ValueError("a space merged")
            begins = cuts if self.spaced else np.append(0, cuts[:-1] + 1)
            first[at] = self._append(ids) + begins
            count[at] = np.diff(begins, append=len(ids))
        rest[alone] = True  # those go alone, what is left behind separators
        at = np.flatnonzero(~rest).tolist()
        if at:
            joined = ("\n" if self.spaced else " | ").join([text(cores[i]) for i in at])
            ids = self._encode([joined])[0]
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) != len(at) - 1:
                raise ValueError("separator token merged")
            edges = np.concatenate([[-1], cuts, [len(ids)]])
            lens = np.diff(edges) - 1
            first[at] = self._append(ids[ids != self.mark]) + np.cumsum(lens) - lens
            count[at] = lens
        for i, ids in zip(alone, self._encode([text(cores[i]) for i in alone])):
            first[i], count[i] = self._append(ids), len(ids)
        return first, count

    def _forget(self):
        """Keep the half used most, the last learned of equals; old uses fade."""
        uses = self.uses
        keep = np.sort(np.lexsort((np.arange(len(uses)), uses))[-(MEMO // 2):])
        lens = self.count[keep]
        ends = np.cumsum(lens)
        self.flat = self.flat[_spans(self.first[keep], lens)]
        self.first, self.count, self.uses = ends - lens, lens, uses[keep] >> 1
        self.cores = self.cores.take(pa.array(keep))

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text (uint32)."""
        out: list = [None] * len(texts)
        known, size = [], 0
        for i, text in enumerate(texts):
            if not text:
                out[i] = np.empty(0, np.uint32)
                continue
            holds = text.__contains__
            # every white space is one space or newline between two words
            if text[0] in " \n" or text[-1] in " \n" or holds("\0") or any(map(holds, TOUCHING)) or any(map(holds, OTHER_SPACE)):
                out[i] = self._encode([text])[0]
                continue
            known.append(i)
            size += len(text)
            if size >= GROUP:
                self._group(texts, known, out)
                known, size = [], 0
        if known:
            self._group(texts, known, out)
        return out

    def _group(self, texts: list[str], places: list[int], out: list):
        """Put the ids of the texts at ``places``, which have certain cuts, into
        ``out``: each distinct chunk of the group is cut and put together once,
        each distinct core looked up once."""
        front, line = ("\0", " \n") if self.spaced else ("", " ")
        parts = pc.split_pattern(pa.array([front + texts[i].replace("\n", line) for i in places], pa.large_string()), " ")
        words = parts.flatten().dictionary_encode()
        cores, lead, stop = _cores(words.dictionary)
        cores = cores.dictionary_encode()
        which, at = cores.indices.to_numpy(), words.indices.to_numpy()
        number = self._numbers(cores.dictionary)
        used = np.bincount(at, minlength=len(which))
        self.uses[number] += np.bincount(which, used, len(number)).astype(np.int64)
        # the chunks' ids: newline, core, stop
        own = number[which]
        inner = self.count[own]
        lens = inner + lead + (stop > 0)
        first = np.cumsum(lens) - lens
        flat = np.empty(lens.sum(), np.uint32)
        flat[_spans(first + lead, inner)] = self.flat[_spans(self.first[own], inner)]
        flat[first[lead]] = self.newline
        for byte, stop_id in zip(b".,", self.stops):
            flat[(first + lens)[stop == byte] - 1] = stop_id
        edges = parts.offsets.to_numpy().tolist()
        for i, begin, end in zip(places, edges, edges[1:]):  # text by text: small arrays stay in the cache
            chunks = at[begin:end]
            out[i] = flat[_spans(first[chunks], lens[chunks])]
        if len(self.cores) > MEMO:
            self._forget()


def _one_word(core: str) -> bool:
    """Whether a vocabulary with word ends takes the core as one word for certain."""
    return core.isalpha() and (core.isascii() or not _OTHER.search(core))


def _spans(first: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places ``first, first + 1, ...`` of each span, one span after the other."""
    ends = np.cumsum(lens)
    return np.repeat(first - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)


def _cores(chunks: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Each chunk without the newline in front (then a word without separator) and
    without a stop behind a Latin letter; whether it had that newline; its stop or 0."""
    _, offsets, data = chunks.buffers()
    ends = np.frombuffer(offsets, np.int64)[chunks.offset:chunks.offset + len(chunks) + 1]
    begins, ends = ends[:-1], ends[1:]
    data = np.frombuffer(data, np.uint8)[:ends[-1]].copy()
    last = data[ends - 1]
    # the bytes before it: a chunk of one byte uses neither, one of two not the second
    before, lead = data[np.maximum(ends - 2, 0)], data[np.maximum(ends - 3, 0)]
    letter = np.where(before < 128, _LATIN[before & 127], (lead >= 0xC2) & (lead <= 0xC9) & _LATIN[(lead & 31).astype(np.int64) << 6 | before & 63])
    stop = np.where((ends - begins > 1) & letter & ((last == 46) | (last == 44)), last, 0)
    line = data[begins] == 10
    data[begins[line]] = 0
    keep = np.ones(len(data), bool)
    keep[:begins[0]] = False
    keep[ends[stop > 0] - 1] = False
    places = np.concatenate([[0], np.cumsum(ends - begins - (stop > 0))])
    return pa.LargeStringArray.from_buffers(len(chunks), pa.py_buffer(places), pa.py_buffer(data[keep])), line, stop


def chunk_ids(path: str) -> ChunkIds:
    """The process's encoder of a vocabulary file (workers are used again)."""
    if path not in _CACHE:
        _CACHE[path] = ChunkIds(path)
    return _CACHE[path]
