"""SentencePiece tables against the library, asked for whole texts."""

import hashlib

import numpy as np
import pytest
import edge
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "▁", "é", "日本", "\U0001f600", "<s>", "</s>", "<unk>", "<0x0A>", ".",
         "\r", "\x00", "\xa0", "ﬁ", "̀", " the", "x" * 300, " " * 40]


def library():
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=6)), max_size=14))
def test_ids_and_text_are_the_librarys(parts):
    from daycast.llm.pieces import piece_tables
    text = "".join(parts).encode("utf-8", "ignore").decode()
    ids = piece_tables(PATH).encode([text])[0]
    want = library().encode(text, add_bos=True, add_eos=True)
    assert ids.tolist() == want
    assert piece_tables(PATH).decode([ids])[0] == library().decode(want)


def test_small_tables_give_the_same_ids(monkeypatch):
    from daycast.llm import pieces
    monkeypatch.setattr(pieces, "TABLE_ENTRIES", 5)
    monkeypatch.setattr(pieces, "LONGEST_KEY", 4)
    texts = [edge.prose(i, 40) + " \n x" for i in range(600)]
    got = pieces.PieceTables(PATH).encode(texts)
    assert [g.tolist() for g in got] == library().encode(texts, add_bos=True, add_eos=True)


def test_digests_of_edge_rows(spark):
    from daycast.llm.pieces import encode_pieces, piece_digests
    from pyspark.sql import functions as F
    lib = library()

    def digest(doc_id, text):
        ids = lib.encode(text or "", add_bos=True, add_eos=True)
        return (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(lib.decode(ids).encode()).hexdigest())

    docs = edge.frame(spark).repartition(3)
    got = edge.tuples(piece_digests(docs, PATH), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = sorted([digest(r[0], r[1]) for r in edge.ROWS], key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))
    assert got == want
    extra = encode_pieces(docs.withColumns({"ids": F.lit(1), "n_tokens": F.lit(2)}), PATH)
    assert "text" not in extra.columns and extra.columns.count("ids") == 1 and "source" in extra.columns
    assert extra.where("length(ids) <> 4 * n_tokens").count() == 0
    assert piece_digests(docs.limit(0), PATH).count() == 0
