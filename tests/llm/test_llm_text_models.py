"""Operators 2, 6, 7, 9 and 10 against brute force, round trips and held-out
accuracy, on small fixtures and edge rows."""

import collections
import functools
import hashlib
import math
import random
import struct
import zlib

import numpy as np
import pytest

import edge
from daycast.llm import fingerprints as fp
from daycast.llm import langid, maxent_lm, packing, token_codec
from daycast.llm.tokens import ChunkIds

SF = "/root/testdata/sf0.001"
public_tokenizers = pytest.importorskip("public_tokenizers")


@functools.cache
def library(name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return t


def library_ids(name, text, end):
    return np.array(library(name).encode(text or "", add_special_tokens=False).ids + [end], "<u4")


ODD = ["", " ", "a  b", "\n", "a\n b", "  x", "x ", "x\n", "a\n\nb", " a", "\na", "it's 's I'll", "<|endoftext|> z", "1234 a1b2", "a, b. c",
       "***, x", "x., y", "a_, b", "a.,b, c.\nD", "a\tb c", "\x1ca b", "日本語. テスト", "\0a b", "a|b | c", "é, x́. "]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunked_ids_equal_the_library(name, monkeypatch):
    import daycast.llm.tokens as tokens
    monkeypatch.setattr(tokens, "MEMO", 50)  # forgets again and again
    c = ChunkIds(public_tokenizers.path(name))
    texts = ODD + [edge.prose(i, 40) + f". X{i}, y\nNew" for i in range(600)] + ODD
    for ids, text in zip(c.batch(texts), texts):
        assert np.append(ids, np.uint32(9)).tolist() == library_ids(name, text, 9).tolist(), repr(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_mixed_white_space_equals_the_library(name):
    rng = random.Random(4)
    texts = ["foo\n\n\nbar\tx\ty", "x\ty\tz\n\n", "a\tb c \t d", " a\rb", "a  b\u00a0c", " \n \n a\tb\tc\td\te"]
    texts += ["".join(rng.choice(["ab", "c.", " ", " ", "\n", "\t", "\r", "\u00a0", "\u3000"]) for _ in range(rng.randrange(2, 14))) for _ in range(3000)]
    for ids, text in zip(ChunkIds(public_tokenizers.path(name)).batch(texts), texts):
        assert np.append(ids, np.uint32(9)).tolist() == library_ids(name, text, 9).tolist(), repr(text)


def test_new_words_are_asked_once_and_without_separators():
    c = ChunkIds(public_tokenizers.path("byte_bpe_50k.json"))
    got = []
    inner = c._encode
    c._encode = lambda texts: got.append(inner(texts)) or got[-1]
    words = [edge.prose(i, 1).strip(" .,").lower() + "qz" * (1 + i % 3) + chr(97 + i % 26) for i in range(300)]
    texts = ["the " + " ".join(words[i:i + 30]) for i in range(0, 300, 10)]
    ids = c.batch(texts)
    assert [a.tolist() for a in ids] == [library_ids("byte_bpe_50k.json", t, 1).tolist()[:-1] for t in texts]
    own = [library_ids("byte_bpe_50k.json", " " + w, 1)[:-1] for w in dict.fromkeys(words)]
    # the library gives the distinct words' own ids and those of the text's first word
    assert sum(len(a) for call in got for a in call) == sum(map(len, own)) + 1


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_the_memory_keeps_what_texts_use_most(name, monkeypatch):
    import daycast.llm.tokens as tokens
    monkeypatch.setattr(tokens, "MEMO", 60)
    c = ChunkIds(public_tokenizers.path(name))
    c.batch([" ".join(f"filler{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(4200))])  # forgets: 30 stay
    c.batch(["often often often often often often"])
    texts = [" ".join(f"x{chr(97 + i)}{chr(97 + j)}" for j in range(26)) for i in range(5)]
    for text in texts:
        c.batch([text])
    assert "often" in c.index and len(c.index) <= 60
    assert c.batch(["an often b"])[0].tolist() == library_ids(name, "an often b", 1).tolist()[:-1]


@pytest.mark.parametrize("name, want", [("byte_bpe_50k.json", ["\0caf\u00e9", "\0word", "caf\u00e9", "word", "x"]), ("word_bpe_49k.json", ["caf\u00e9", "word", "x"])])
def test_words_share_their_core(name, want):
    """A word is asked and kept once, whatever stop follows it or newline stands before it."""
    c = ChunkIds(public_tokenizers.path(name))
    texts = ["word word. word, caf\u00e9, caf\u00e9. x\nword.\nword,\ncaf\u00e9."]
    assert [a.tolist() for a in c.batch(texts)] == [library_ids(name, t, 1).tolist()[:-1] for t in texts]
    assert sorted(c.index) == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_stops_behind_any_letter(name):
    """Each text is a group of its own: its first and last chunk lie at the buffer's ends."""
    c = ChunkIds(public_tokenizers.path(name))
    heads = ["", "a", "Z", "1", "_", "\u00aa", "\u00d7", "\u00e9", "\u0130", "\u01c5", "\u024f", "\u0250", "\u02b0", "\u0301", "e\u0301", "\u05d0", "\u0965",
             "\u65e5", "\uffdd", "\U00010400", "\U0001f600"]
    texts = [h + stop for h in heads for stop in (".", ",", "..", ".,", ".a", "")]
    texts += [f"b {t}\n{t} {t}\nb" for t in texts] + [f"{a}\n{b}" for a in texts for b in texts if a and b]
    for text in texts:
        assert c.batch([text])[0].tolist() == library_ids(name, text, 9).tolist()[:-1], repr(text)


def test_packing_covers_every_id_once(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack(edge.frame(spark), path, 1, with_ids=True).collect()
    by_doc = collections.defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        by_doc[r["doc_id"]].append(r)
    want = collections.Counter()
    for d, t, _, _ in edge.ROWS:
        for i in library_ids("byte_bpe_50k.json", t, 1).tolist():
            want[d, i] += 1
    got = collections.Counter((r["doc_id"], i) for r in rows for i in r["ids"])
    assert got == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(bins) == list(range(len(bins)))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert packing.pack(edge.frame(spark, []), path, 1).count() == 0


def test_packing_wastes_little(spark):
    from daycast.llm.queries import QUERIES
    length = collections.Counter()
    for r in QUERIES["op7_harmonic_packing"](spark, SF).collect():
        length[r["sequence_id"]] += r["length"]
    full = sum(length.values())
    padded = sum(n if n & (n - 1) == 0 else packing.CAPACITY for n in length.values())
    assert (padded - full) / padded < 0.02


@pytest.mark.parametrize("total", [1, 2, 3, 64, 67, 100, 1024, 1500, 2047, 2048, 2049, 100_000])
def test_cut_lengths(total):
    parts = packing.cut_lengths(total)
    assert sum(n for n, _ in parts) == total
    assert all(n * k <= packing.CAPACITY and n > 0 for n, k in parts)
    assert all(packing.CAPACITY - n * k <= max(packing.SLACK, k) for n, k in parts)


def test_codec_round_trip_and_damage():
    rng = np.random.default_rng(5)
    for _ in range(12):
        docs = [rng.integers(0, rng.choice([1, 3, 300, token_codec.MAX_ID]), rng.integers(1, rng.choice([2, 50, 3000]))).astype(np.uint32)
                for _ in range(rng.integers(1, 30))]
        names = [None if rng.random() < 0.2 else int(rng.integers(-9, 9)) for _ in docs]
        frame = token_codec.pack_frame(names, docs)
        got_names, got = token_codec.unpack_frame(frame)
        assert got_names == names and all(np.array_equal(a, b) for a, b in zip(docs, got))
    bad = bytearray(frame)
    bad[-3] ^= 64
    with pytest.raises(ValueError):
        token_codec.unpack_frame(bytes(bad))
    with pytest.raises(ValueError):
        token_codec.encode_blocks([np.array([token_codec.MAX_ID])])


def test_codec_uses_its_contexts():
    """A sequence that order 2 tells costs far less than its ids at random."""
    rng = np.random.default_rng(6)
    pattern = rng.integers(0, 40_000, 200)
    told = token_codec.encode_blocks([np.tile(pattern, 20)])[0]
    blind = token_codec.encode_blocks([rng.integers(0, 40_000, 4000)])[0]
    assert len(told) * 4 < len(blind)


def test_codec_lanes_learn_from_each_other():
    """What one lane of a block has seen is cheap in the others."""
    pattern = np.random.default_rng(7).integers(0, 40_000, 1024)
    lanes = [np.roll(pattern, 29 * i) for i in range(40)]
    together = token_codec.encode_blocks([np.concatenate(lanes)])
    assert len(together[0]) * 2 < 40 * len(token_codec.encode_blocks(lanes[:1])[0])
    assert np.array_equal(token_codec.decode_blocks(together, [40 * 1024])[0], np.concatenate(lanes))


def test_codec_damage_anywhere_raises():
    rng = np.random.default_rng(8)
    docs = [rng.integers(0, n, 700).astype(np.uint32) for n in (3, 300, 65_536)]
    frame = token_codec.pack_frame([1, 2, 3], docs)
    for at in rng.integers(0, len(frame), 40).tolist():
        bad = bytearray(frame)
        bad[at] ^= 1 << int(rng.integers(0, 8))
        with pytest.raises((ValueError, struct.error)):
            token_codec.unpack_frame(bytes(bad))


@pytest.mark.parametrize("sizes", [[1], [0, 5, 0], [3000, 1, 2], [1024] * 70, [257, 256, 255]])
def test_codec_blocks_of_any_size(sizes):
    rng = np.random.default_rng(9)
    blocks = [rng.integers(0, 1 << int(rng.integers(1, 17)), n).astype(np.uint32) for n in sizes]
    back = token_codec.decode_blocks(token_codec.encode_blocks(blocks), sizes)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))


def test_token_files_edge_rows(spark):
    rows = token_codec.token_files(edge.frame(spark), public_tokenizers.path("word_bpe_49k.json"), 2, with_ids=True).collect()
    rows.sort(key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    known = [d for d in ids if d is not None]
    assert known == sorted(known) and ids[len(known):] == [None] * (len(ids) - len(known))
    at = 0
    for r in rows:
        assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    want = sorted((d is None, d or 0, tuple(library_ids("word_bpe_49k.json", t, 2).tolist())) for d, t, _, _ in edge.ROWS)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(r["ids"])) for r in rows) == want
    assert token_codec.token_files(edge.frame(spark, []), public_tokenizers.path("word_bpe_49k.json"), 2).count() == 0


def test_prefix_hashes_answer_span_equality():
    random.seed(3)
    text = "".join(random.choice("ab") for _ in range(400))
    arrays = [fp.prefix_array(fp.code_points(text), w) for w in (0, 1)]
    for _ in range(500):
        i, j, k = random.randrange(380), random.randrange(380), random.randrange(1, 21)
        same = all(fp.span_hash(a, w, i, k) == fp.span_hash(a, w, j, k) for w, a in enumerate(arrays))
        assert same == (text[i:i + k] == text[j:j + k])
        n = fp.common_extension(arrays, arrays, i, j)
        assert text[i:i + n] == text[j:j + n] and (i + n == 400 or j + n == 400 or text[i + n] != text[j + n])


def test_fingerprints_edge_rows(spark):
    rows = [r for r in edge.ROWS if r[0] is not None and r[0] != 10] + [(10, edge.ROWS[12][1], None, None)]
    out = {}
    for r in fp.fingerprints(edge.frame(spark, rows)).collect():
        out.setdefault(r["doc_id"], []).append(r)
    order = sorted(rows, key=lambda r: r[0])
    texts = [t or "" for _, t, _, _ in order]
    prints = {}
    for i, (d, _, _, _) in enumerate(order):
        t, after = texts[i], texts[(i + 1) % len(texts)]
        k = len(t) // 2
        edited = t[:len(t) - k] + after[:k]
        r = next(r for r in out[d] if r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest())
        assert r["n_chars"] == len(t) and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert r["prefix_next"] == next((j for j, (a, b) in enumerate(zip(t, after)) if a != b), min(len(t), len(after)))
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        if t == after:
            assert r["near_next"] == 1
    assert len(set(prints.values())) == len(prints)
    near = [r for r in out[9]][0]
    assert 0.3 < near["near_edited"] < 0.98  # the next document is short: less than half goes
    assert fp.fingerprints(edge.frame(spark, [])).count() == 0
    whole = fp.fingerprints(edge.frame(spark))
    assert whole.count() == len(edge.ROWS)


def test_language_accuracy_and_edge_rows(spark):
    from daycast.llm.common import table
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = langid.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = out.where("held_out").selectExpr("avg(CAST(lang_pred = lang AS INT))", "min(score)", "max(score)", "count(*)").first()
    assert held[0] > 0.98 and held[1] >= 0 and held[2] <= 1 and held[3] > 200
    rows = [(1000 + i, f"le la les des une {edge.prose(i, 3)} été", "fr", None) for i in range(20)]
    rows += [(2000 + i, "the and of with this that " + edge.prose(i, 9), "en", None) for i in range(20)]
    got = langid.language_report(edge.frame(spark, rows + edge.ROWS)).collect()
    assert len(got) == len(rows) + len(edge.ROWS)
    by = collections.defaultdict(set)
    for r in got:
        by[r["doc_id"]].add(r["lang_pred"])
        assert 0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 4 == 2)
    assert by[4] == by[5] == by[6] == by[11] == {"und"} and "und" in by[None]
    assert langid.language_report(edge.frame(spark, [])).count() == 0
    unlabelled = edge.frame(spark, [(i, t, None, s) for i, t, _, s in edge.ROWS])
    assert {r["lang_pred"] for r in langid.language_report(unlabelled).collect()} == {"und"}


def test_language_sample_is_of_distinct_texts(spark):
    """A label that is nearly all copies of one text, and one that is nothing else."""
    rows = [("the and of this " + edge.prose(0, 9), "en")] * 900 + [(f"the and of this {edge.prose(i, 9)}", "en") for i in range(1, 31)]
    rows += [("le la les des une", "fr")] * 400
    labels, w, _ = langid.train(spark.createDataFrame(rows, "text string, lang string"), rows=20)
    assert labels == ["en", "fr"] and w.shape[1] == 2
    docs = spark.createDataFrame([(1, "the and of this river"), (2, "le la les des une")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, (labels, w, _)).collect()}
    assert got == {1: "en", 2: "fr"}


def test_lm_scores(spark):
    rows = [(i, edge.prose(i % 40, 30 + i % 17), None, None) for i in range(150)] + edge.ROWS
    held = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 5 == 1
    tokens = [(t or "").encode().lower().split() + [None] for _, t, _, _ in rows]
    count = collections.Counter(w for (d, _, _, _), ws in zip(rows, tokens) if not held(d) for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted((d is None, d or 0, len(ws), sum(count[w] > 0 for w in ws), round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6))
                  for (d, _, _, _), ws in zip(rows, tokens))
    for hot in (maxent_lm.HOT_WORDS, 7):  # nearly all words by lookup, nearly all by join
        got = maxent_lm.lm_scores(edge.frame(spark, rows), rounds=2, hot_words=hot).collect()
        assert all(r["train_tokens"] == n and r["held_out"] == held(r["doc_id"]) for r in got)
        assert [x[:4] for x in sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["base_score"]) for r in got)] == [x[:4] for x in want]
        assert np.allclose(sorted(r["base_score"] for r in got), sorted(x[4] for x in want), atol=1e-5)
        assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    empty = maxent_lm.lm_scores(edge.frame(spark, []))
    assert empty.count() == 0


def test_lm_class_model_is_a_distribution():
    rng = np.random.default_rng(1)
    w, bias = rng.normal(size=(maxent_lm.KINDS * maxent_lm.SLOTS, maxent_lm.CLASSES)), rng.normal(size=maxent_lm.CLASSES)
    none = np.zeros(0, np.uint64)
    rows = maxent_lm.Words(none, none, np.zeros(0, np.int64), none).context_rows(maxent_lm.token_hashes(edge.BASE.encode()))
    assert np.allclose(np.exp(maxent_lm.log_softmax(w, bias, rows)).sum(axis=1), 1)
    assert np.allclose(np.exp(maxent_lm.log_softmax(w, bias, rows)), maxent_lm.softmax(w, bias, rows))


def test_lm_many_texts_at_a_time():
    """Rows of texts in a row are those of each alone; expected counts and scores again."""
    import zlib as z

    import pandas as pd
    L, rng = maxent_lm, np.random.default_rng(4)
    held = [L.token_hashes(t.encode()) for t in ("", edge.BASE, "one", "", edge.prose(3, 50), "two words")]
    h, begins = L._joined(held)
    skip = np.sort(np.unique(h)[::3])
    words = L.Words(skip[:2], skip, np.arange(len(skip)) % L.ANCHORS, skip)
    rows = np.concatenate([words.context_rows(x) for x in held])
    assert (words.context_rows(h, begins) == rows).all() and (words.context_rows(h, begins, np.isin(h, skip)) == rows).all()
    w, bias = rng.normal(size=(L.KINDS * L.SLOTS, L.CLASSES)).astype(np.float32), rng.normal(size=L.CLASSES).astype(np.float32)
    k = words.classes_of(h)
    assert np.allclose(L.log_chosen(w, bias, rows, k), L.log_softmax(w, bias, rows)[np.arange(len(k)), k], atol=1e-5)
    keys, n = rows[:, 0] | (rows[:, 1] - L.SLOTS) << 12 | (rows[:, 2] - 2 * L.SLOTS) << 24, np.arange(1, len(rows) + 1)
    want = np.zeros((L.KINDS * L.SLOTS + 1, L.CLASSES))  # contexts in any order, some more than once
    for j in range(L.KINDS):
        np.add.at(want, rows[:, j], L.softmax(w, bias, rows) * n[:, None])
    logits = w[rows].astype(float).sum(axis=1) + bias
    want[-1, 0] = (np.log(np.exp(logits).sum(axis=1)) * n).sum()
    sent = next(L._expected(w, bias)(iter([pd.DataFrame({"keys": [L._pack(keys)], "n": [n.astype("<i8").tobytes()]})])))
    got = np.concatenate([np.frombuffer(z.decompress(m), "<i8") for m in sent["m"]]).reshape(want.shape) / L.SCALE
    assert np.allclose(got, want, rtol=1e-4, atol=1e-3)


def test_lm_training_settles(spark):
    """Distinct contexts are those of all tokens; the gradient at the trained weights, token
    by token, promises next to nothing."""
    L = maxent_lm
    texts = [edge.prose(i % 50, 40 + i % 9) for i in range(120)]
    raw = L.hashed(spark.createDataFrame([(t.encode(),) for t in texts], "raw binary").repartition(3))
    hashes = [L.token_hashes(t.encode()) for t in texts]
    h, c = np.unique(np.concatenate(hashes), return_counts=True)
    words = L.learn_words(raw, h, c)
    rows, k = np.concatenate([words.context_rows(x) for x in hashes]), np.concatenate([words.classes_of(x) for x in hashes])
    got = collections.Counter()
    for r in L.contexts(raw, words, len(k)).collect():
        slots, n = L._slots(bytes(r["keys"])).T.tolist(), np.frombuffer(bytes(r["n"]), "<i8").tolist()
        assert len(slots) == len(n)
        got.update(dict(zip(map(tuple, slots), n)))
    assert got == collections.Counter(map(tuple, rows.tolist()))
    w, bias = L.train(raw, words)
    p, seen, expected = L.softmax(w, bias, rows), np.zeros(w.shape), np.zeros(w.shape)
    for j in range(L.KINDS):
        np.add.at(seen, (rows[:, j], k), 1)
        np.add.at(expected, rows[:, j], p)
    share = (np.bincount(k, minlength=L.CLASSES) + 0.5) / (len(k) + 0.5 * L.CLASSES)
    smooth = L.PRIOR * L.CLASSES * share
    gradient = seen - expected - L.PULL * smooth * w
    assert (gradient * np.clip(L.STEP * gradient / (expected + smooth), -1, 1)).sum() < 1e-3 * len(k)


def test_lm_scores_by_hand(spark):
    """Counts, classes, gradient steps and scores again, token by token."""
    from pyspark.sql import functions as F
    L = maxent_lm
    texts = [edge.prose(i, 25) + (" le la" if i % 3 else " the of") for i in range(60)]
    docs = edge.frame(spark, [(i, t, None, None) for i, t in enumerate(texts)]).repartition(3)
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(60)]
    hashes = [[int(h) for h in L.token_hashes(t.encode())] for t in texts]
    count = collections.Counter(h for i, hs in enumerate(hashes) if not held[i] for h in hs)
    raw = docs.where(~F.col("doc_id").isin([i for i in range(60) if held[i]])).select(F.col("text").cast("binary").alias("raw"))
    raw = L.hashed(raw)
    counts = spark.createDataFrame([(h - (1 << 64) if h >= 1 << 63 else h, c) for h, c in count.items()], "h long, c long")
    m = L.fit(raw, counts)
    ranked = [h for h, _ in sorted(count.items(), key=lambda x: (-x[1], x[0])) if h != int(L.END)]
    anchors, skip = set(ranked[:L.ANCHORS]), set(ranked[:L.SKIP_WORDS])
    follow = collections.defaultdict(collections.Counter)
    for i, hs in enumerate(hashes):
        last = None
        for h in hs:
            if not held[i] and h in set(ranked[:L.CLASSED]):
                follow[h][last] += 1
            last = h if h in anchors else last
    assert {int(x) for x in m.words.anchors} == anchors and {int(x) for x in m.words.skip} == skip
    share = collections.Counter(a for c in follow.values() for a in c.elements())
    order, klass = sorted(anchors), {}
    for h, c in follow.items():
        total = sum(share.values())
        lift = [(c[a] + 4 * max(share[a], 0.5) / total) / (sum(c.values()) + 4) / (max(share[a], 0.5) / total) for a in order]
        klass[h] = int(np.argmax(lift))
    assert klass == dict(zip(map(int, m.words.classed), m.words.klass.tolist()))
    cls = lambda h: klass.get(h, L.ANCHORS + h % L.RARE_CLASSES)
    tokens, words = collections.Counter(), collections.Counter()
    for h, c in count.items():
        tokens[cls(h)] += c
        words[cls(h)] += 1

    def p_classes(w, bias, row):
        z = [bias[k] + sum(w[f][k] for f in row) for k in range(L.CLASSES)]
        e = [math.exp(x - max(z)) for x in z]
        return [x / sum(e) for x in e]

    rows = [m.words.context_rows(np.array(hs, np.uint64)).tolist() for hs in hashes]
    seen, expected = np.zeros((L.KINDS * L.SLOTS, L.CLASSES)), np.zeros((L.KINDS * L.SLOTS, L.CLASSES))
    train = [(h, r) for i, hs in enumerate(hashes) if not held[i] for h, r in zip(hs, rows[i])]
    for h, r in train:
        seen[r, cls(h)] += 1
    prior = np.array([tokens[k] + 0.5 for k in range(L.CLASSES)])
    prior /= prior.sum()
    smooth, bias = L.PRIOR * L.CLASSES * prior, np.log(prior)
    w = np.log((seen + smooth) / (seen.sum(axis=1, keepdims=True) + L.PRIOR * L.CLASSES) / prior) / 2
    first, _ = L.train(raw, m.words, rounds=1)
    for h, r in train:
        p = p_classes(w, bias, r)
        for f in r:
            expected[f] += p
    w = w + np.clip(L.STEP * (seen - expected - L.PULL * smooth * w) / (expected + smooth), -1, 1)
    assert np.allclose(first, w, atol=2e-3)
    got = {r["doc_id"]: r["score"] for r in L.lm_scores(docs).collect()}
    for i, hs in enumerate(hashes):
        want = sum(math.log10(p_classes(m.weights, m.bias, r)[cls(h)] * (count[h] + 0.5) / (tokens[cls(h)] + 0.5 * (words[cls(h)] + 1)))
                   for h, r in zip(hs, rows[i]))
        assert abs(got[i] - want) < 1e-3
