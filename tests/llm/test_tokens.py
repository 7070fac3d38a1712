from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketry.llm import token_pieces
from basketry.llm.packing import Packer, pack
from basketry.llm.token_counts import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)

ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n\nb c", "x  y", "x  y",
       "it's 'll 12,5 <|endoftext|> x<|endoftext|>y", "日本 語 テキスト", "é" * 500, "ab" * 5000,
       "word " * 3000, "\t tab\x1c sep \x85 next", "👍🏽 ok 🇩🇪"]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def frame(spark, texts):
    rows = [(i, t, "x", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, `start` int")


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab,.'s1 \n\t  \x1cé日<|>")), max_size=60))
def test_pieces_give_the_ids_of_the_whole(text):
    got = token_pieces.encoder(PATH).encode([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == ids(text)


def test_pieces_table_is_bounded(monkeypatch):
    monkeypatch.setattr(token_pieces, "MAX_KEPT", 3)
    p = token_pieces.Pieces(PATH, len, sum)
    for t in ["a b c d e f", "g h", "", "i j k"]:
        assert p.encode([t, t]) == [len(ids(t))] * 2
    assert len(p.inner) <= 4


def test_counts_equal_the_library(spark):
    got = {r.doc_id: r for r in token_counts(frame(spark, ODD), PATH).collect()}
    assert len(got) == len(ODD)
    for i, t in enumerate(ODD):
        n = len(ids(t))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (
            n, len((t or "").encode()), n > 512)


def test_counts_of_nothing(spark):
    assert token_counts(frame(spark, ODD).limit(0), PATH).count() == 0


def check_pieces(rows, texts, max_tokens=2048, max_segments=256):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, t in enumerate(texts):
        whole = np.array(ids(t) + [1], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(whole)
            assert r.ids_crc32 == zlib.crc32(whole[at:at + r.length].tobytes())
            at += r.length
        assert at == len(whole)
    padding = 0
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= max_tokens and len(seq) <= max_segments
        padding += 0 if at & (at - 1) == 0 else max_tokens - at
    return padding


def test_pack(spark):
    texts = [*ODD, *["some words here " * (i % 40) for i in range(200)]]
    assert check_pieces(pack(frame(spark, texts), PATH).collect(), texts) == 0


def test_pack_with_a_small_pool(spark):
    texts = [*ODD, *["some words here " * (i % 40) for i in range(100)]]
    rows = pack(frame(spark, texts).coalesce(1), PATH, pool_tokens=500, max_tokens=64,
                max_segments=3).collect()
    assert check_pieces(rows, texts, 64, 3) == 0


def test_pack_of_nothing(spark):
    assert pack(frame(spark, ODD).limit(0), PATH).count() == 0


def test_pack_returns_ids(spark):
    for r in pack(frame(spark, ["a b c", None]), PATH, with_ids=True).collect():
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


@pytest.mark.parametrize("limits", [(64, 4, 64), (64, 64, 10), (128, 2, 30)])
def test_packer_keeps_all_three_limits(limits):
    rng = np.random.default_rng(1)
    items = [(k, int(rng.integers(1, 200)), int(rng.integers(0, 120))) for k in range(400)]
    p = Packer(*limits)
    for k, n, loss in items:
        p.add(k, n, loss)
        p.drain(2000)
    p.finish()
    rows = p.rows()
    assert sum(r[2] for r in rows) == sum(n for _, n, _ in items)
    loss_of = {k: min(n, loss) for k, n, loss in items}
    seqs = {}
    for k, start, length, s, _ in rows:
        t = seqs.setdefault(s, [0, 0, 0])
        t[0] += length
        t[1] += 1
        t[2] += max(0, start + length - max(start, loss_of[k]))
    assert all(a <= b for t in seqs.values() for a, b in zip(t, limits))
