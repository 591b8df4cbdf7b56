"""Collocations against counting with plain counters."""

import random
import re
from collections import Counter

import edge
import numpy as np
import pyarrow as pa
import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counters(rows, max_words):
    f = [Counter() for _ in range(max_words + 1)]
    for _, text, lang, _ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            for m in range(1, max_words + 1):
                f[m].update((lang or "und", *ws[i:i + m]) for i in range(len(ws) - m + 1))
    return f


def brute(rows, max_words=3, min_count=10, overlap=50, top=2000):
    f = counters(rows, max_words)
    n = Counter()
    for (lang, _), c in f[1].items():
        n[lang] += c
    found = {k: c for m in range(2, max_words + 1) for k, c in f[m].items() if c >= min_count}
    out = {}
    for (lang, *ws), a in found.items():
        inside = [c for (other, *vs), c in found.items() if other == lang and len(vs) > len(ws)
                  and any(vs[i:i + len(ws)] == ws for i in range(len(vs)))]
        if any(100 * c >= overlap * a for c in inside):
            continue
        cuts = [(1000000 * a * a // (f[k][(lang, *ws[:k])] * f[len(ws) - k][(lang, *ws[k:])]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), f[k][(lang, *ws[:k])], f[len(ws) - k][(lang, *ws[k:])]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, rest in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(rest)[:top], 1))


def rows_for_test():
    r = random.Random(2)
    words = ["The", "the", "new", "york", "times", "Été", "of", "日本", "a\x00b", "x\xa0y", "\x1c"]
    rows = [(i, "".join(r.choice(words) + r.choice([" ", "  ", "\t", ". ", ",", "\r\n", " ", " "]) for _ in range(60)),
             r.choice(["en", None, "und", "fr"]), "s") for i in range(120)]
    rows += [(500, "new york times " * 400, "en", "s"), (501, "aa " * 30 + "bb. aa bb cc", "de", None)]
    return rows + [(i, t, la, s) for i, t, la, s in edge.ROWS if not (t and len(t) > 100_000)]


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("kw", [{}, {"max_words": 4, "min_count": 3, "overlap": 80, "top": 5}, {"max_words": 2, "min_count": 2}])
def test_phrases_are_the_brute_force(spark, kw):
    from daycast.llm.collocations import collocations
    rows = rows_for_test()
    got = collocations(edge.frame(spark, rows).repartition(4), **kw)
    assert sorted(tuple(x) for x in got.select(COLUMNS).collect()) == brute(rows, **kw)


def test_empty_table_and_wordless_texts(spark):
    from daycast.llm.collocations import collocations
    assert collocations(edge.frame(spark).limit(0)).count() == 0
    assert collocations(edge.frame(spark, [(1, " .,", "en", "a"), (2, None, None, None)])).count() == 0


def test_stripes_merge_alike_in_any_cut(monkeypatch):
    """Hot prefixes in buckets, small slices, small batches and early merges."""
    from daycast.llm import collocations as C
    monkeypatch.setattr(C, "WORDS_AT_ONCE", 500)
    monkeypatch.setattr(C, "MERGE_AT", 7)
    rows = rows_for_test()
    tasks = [rows[i::3] for i in range(3)]
    batch = lambda part: pa.RecordBatch.from_arrays(
        [pa.array([r[2] or "und" for r in part]), pa.array([(r[1] or "").encode() for r in part], pa.binary())], ["lang", "text"])
    the = np.array([C._word_hash(b"en", w) for w in (b"the", b"new")], np.uint64)
    hot = (np.sort(the), np.array([3, 5]))
    f = counters(rows, 3)
    for level in (1, 2, 3):
        stripes = pa.Table.from_batches([b for part in tasks for b in C._counted(level, None, hot if level == 2 else (hot[0][:0], hot[1][:0]))([batch(part)])])
        if level == 2:
            en = stripes.filter(pa.compute.and_(pa.compute.equal(stripes["lang"], "en"), pa.compute.equal(stripes["prefix"], b"the")))
            assert len(set(en["bucket"].to_pylist())) > 1
        stripes = stripes.sort_by([(c, "ascending") for c in ("lang", "prefix", "bucket")])
        merged = [r for b in C._merged(level, 1)(stripes.to_batches(max_chunksize=5)) for r in b.to_pylist()]
        got = {(r["lang"], *(r["prefix"].decode().split(" ") if level > 1 else []), r["next"].decode()): r["count"] for r in merged if r["next"] is not None}
        assert got == dict(f[level]) and len(got) == sum(r["next"] is not None for r in merged)
        if level == 1:
            total = Counter()
            for r in merged:
                total[r["lang"]] += r["count"] if r["next"] is None else 0
            assert total["en"] == sum(c for (lang, _), c in f[1].items() if lang == "en")
