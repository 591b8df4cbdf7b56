"""Letters, short texts' likeness, and token guards."""

import random

import edge
import pytest


def test_only_letters_make_a_language():
    from daycast.llm.langid import clean
    assert clean("½ ² Ⅷ ③ 12 _ !") == "" and clean("x²y") == " x y " and clean("ǅ ª ʰ 日") != ""
    r = random.Random(4)
    for _ in range(3000):
        t = "".join(chr(r.choice([r.randrange(32, 0x3000), r.randrange(0x1D400, 0x1F200)])) for _ in range(8)).lower()
        words = "".join(c if c.isalpha() else " " for c in t).split()
        assert clean(t) == (f" {' '.join(words)} " if words else "")


@pytest.mark.parametrize("n,least", [(10, 0.3), (20, 0.4), (40, 0.4), (70, 0.38), (100, 0.42), (390, 0.45), (500, 0.4), (4000, 0.35)])
def test_half_equal_texts_are_half_alike(n, least):
    from daycast.llm.fingerprints import describe, edited, likeness
    r = random.Random(n)
    word = lambda k: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(k))
    got = []
    for _ in range(30):
        a, b = word(n), word(n)
        x, y, z = describe(a), describe(edited(a, b)), describe(b)
        got.append(likeness(x[2], y[2]))
        assert likeness(x[2], z[2]) < 0.3 and likeness(x[2], x[2], True) == 1.0
    assert least < sum(got) / len(got) < 0.62


def test_texts_around_a_bound_compare():
    from daycast.llm.fingerprints import describe, likeness
    base = edge.prose(3, 200)
    for cut in (60, 400):
        a, b = describe(base[:cut - 3]), describe(base[:cut + 5])
        assert likeness(a[2], b[2]) > 0.85 and a[0] != b[0]
    assert likeness(describe(base[:40])[2], describe(base[:900])[2]) == 0.0


def test_rows_without_an_id_spread_and_keep_their_order(spark):
    from daycast.llm.fingerprints import with_next
    rows = [(None, edge.prose(i, 12), "en", "a") for i in range(60)] + [(i, edge.prose(100 + i, 12), "en", "a") for i in range(5)]
    one = with_next(edge.frame(spark, rows), 10**9).select("doc_id", "text", "next_text")
    many = with_next(edge.frame(spark, rows), 400).select("doc_id", "text", "next_text")
    assert edge.tuples(one, *one.columns) == edge.tuples(many, *many.columns)
    follow = {(r["doc_id"], r["text"]): r["next_text"] for r in many.collect()}
    at, seen = (0, rows[60][1]), set()
    texts = {t: d for d, t, *_ in rows}
    for _ in range(len(rows)):
        seen.add(at)
        at = (texts[follow[at]], follow[at])
    assert len(seen) == 65 and at == (0, rows[60][1])  # one ring through all


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_every_kind_of_space_gives_the_librarys_ids(name):
    import public_tokenizers
    from daycast.llm.tokens import OTHER_SPACE, ChunkIds
    own = ChunkIds(public_tokenizers.path(name))
    r = random.Random(8)
    parts = ["the", "a", "word.", "x,", "été", " ", " ", " ", "\n", "\n\n", "  ", "\t", *OTHER_SPACE, "\0", "日本"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(0, 9))) for _ in range(4000)]
    want = own.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [a.tolist() for a in own.batch(texts)] == [w.ids for w in want]


def test_coder_mixes_and_restores_every_block():
    import numpy as np
    from daycast.llm import token_codec as C
    r = np.random.default_rng(3)
    blocks = [np.tile(np.array([7, 300, 65_535, 0], np.uint32), 1500), np.zeros(5000, np.uint32), r.integers(0, C.MAX_ID, 700).astype(np.uint32),
              np.array([C.MAX_ID - 1], np.uint32), np.repeat(r.integers(0, 50, 900), r.integers(1, 6, 900)).astype(np.uint32)]
    packed = C.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(blocks, C.decode_blocks(packed, [len(b) for b in blocks])))
    # what orders 2 and 1 foresee costs little; ids without any order cost their 16 bits
    assert len(packed[0]) < 0.03 * len(blocks[0]) and len(packed[1]) < 0.03 * len(blocks[1]) and len(packed[2]) < 2.4 * len(blocks[2])
    # one block alone gives the same bytes: the blocks in step do not touch each other
    assert C.encode_blocks([blocks[4]])[0] == packed[4]
    with pytest.raises(ValueError):
        C.encode_blocks([np.array([C.MAX_ID], np.uint32)])
