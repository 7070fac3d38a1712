from __future__ import annotations

import base64
import collections
import hashlib

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm.alignment import Aligner, alignment, links, terminals

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
RANKS = {base64.b64decode(a): int(b) for a, b in map(
    bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
TIK = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ALIGNER = Aligner(A, B)
SPM = sentencepiece.SentencePieceProcessor(model_file=B)


def spans(text):
    """The two sides' (id, start, end), from other libraries and plain loops; None if they don't fit."""
    if not text:
        return None
    wanted = (" " + text).encode()
    sides = []
    for ids, spelt in ((TIK.encode_ordinary(" " + text), lambda i: TIK.decode_single_token_bytes(i)),
                       (SPM.encode(text), lambda i: bytes([int(SPM.id_to_piece(i)[3:5], 16)]) if SPM.is_byte(i)
                        else SPM.id_to_piece(i).replace("▁", " ").encode())):
        at, side = 0, []
        for i in ids:
            side.append((i, at, at + len(spelt(i))))
            at = side[-1][2]
        if b"".join(spelt(i) for i in ids) != wanted:
            return None
        sides.append(side)
    return sides


def brute(rows):
    found = []
    counts = collections.Counter()
    for doc_id, text in rows:
        both = spans(text)
        if both is None:
            found.append((doc_id, 0, 0, 0, [], ""))
            continue
        a, b = both
        # one merge over both sides: a link where the ranges overlap
        linked, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            linked.append((a[i][0], b[j][0]))
            ea, eb = a[i][2], b[j][2]
            i, j = i + (ea <= eb), j + (eb <= ea)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = []
        low = 0
        for cut in cuts:
            groups.append(",".join(str(t) for t, s, e in a if low <= s and e <= cut) + "|"
                          + ",".join(str(t) for t, s, e in b if low <= s and e <= cut))
            low = cut
        counts.update(linked)
        found.append((doc_id, len(a), len(b), len(cuts), linked,
                      hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = collections.Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return sorted(((i, na, nb, ng, len(ls), sum(counts[x] == top[x[1]] for x in ls), sum(counts[x] for x in ls), h)
                   for i, na, nb, ng, ls, h in found), key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, block int, `at` string")
    return sorted((tuple(r) for r in alignment(df.repartition(3), A, B, **kw).collect()), key=repr)


TEXTS = ["", None, "a", " ", "  two  spaces ", "Hello, world!", "naïve café — 東京タワー 😀", "ﬁ ligature ½",
         "<|endoftext|> <s> </s> <unk> <0x41>", "line\nbreak\r\n\ttab", "don't", "x" * 3000, "ab " * 2000,
         "▁under", "é́", "\x00nul", "1234567890 3.14159"]


def test_against_other_libraries(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, "Hello, world!")] * 3 + [(None, "Hello")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, block_bytes=1) == brute(rows)       # a block a document: counts still corpus-wide


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_documents_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, alignment(docs, A, B, block_bytes=100_000).collect()), key=repr) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(1, 5)), min_size=1, max_size=60))
def test_doubling_finds_the_common_ends(cuts):
    """Two random tilings of one length: groups end exactly where both sides end."""
    a = np.cumsum([n for side, n in cuts if side == 0] or [1])
    b = np.cumsum([n for side, n in cuts if side == 1] or [1])
    end = max(a[-1], b[-1])
    a, b = np.unique(np.r_[a, end]), np.unique(np.r_[b, end])
    label_a, label_b, rounds = terminals(a, b)
    common = np.intersect1d(a, b)
    group = lambda ends: np.searchsorted(common, ends)     # noqa: E731
    assert (np.unique(label_a, return_inverse=True)[1] == group(a)).all()
    assert (np.unique(label_b, return_inverse=True)[1] == group(b)).all()
    assert rounds <= np.ceil(np.log2(len(a) + len(b))) + 1
    i, j, upto = links(a, b)
    assert (upto == np.searchsorted(i, np.arange(len(a)), side="right")).all()
    low_a, low_b = np.r_[0, a[:-1]], np.r_[0, b[:-1]]
    assert set(zip(i.tolist(), j.tolist())) == {
        (x, y) for x in range(len(a)) for y in range(len(b)) if low_a[x] < b[y] and low_b[y] < a[x]}


def test_a_long_chain_takes_few_rounds():
    a = np.r_[np.arange(2, 200_001, 2), 200_001]
    b = np.r_[np.arange(1, 200_001, 2), 200_001]
    label_a, label_b, rounds = terminals(a, np.unique(b))
    assert len(np.unique(np.r_[label_a, label_b])) == 1 and rounds <= 19


LETTERS = ["a", "Be", "été", "ß", "x" * 70, "the", "日本", "5", "e\u0301", "'s", "don't", "ª"]
MARKS = [" ", " ", " ", "\n", "\n", "  ", "\t", "\r\n", "\u00a0", ".", ",", "!!", "***", ">", "-", "'", "\x1c", "\n\n"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(LETTERS + MARKS), max_size=25).map("".join), max_size=6))
def test_parts_give_the_ids_of_the_whole(texts):
    got = ALIGNER.encode(texts)
    for text, (a, b) in zip(texts, got):
        sides = spans(text)
        wanted = [[t for t, *_ in side] for side in sides] if sides else [[], []]
        assert [np.frombuffer(x, "<u4").tolist() for x in (a, b)] == wanted


def test_a_text_may_begin_like_a_later_line():
    """A line of one text and the begin of another are kept apart, whichever comes first."""
    texts = ["\na", "b\na", "\na", "\na c \na", "b\nc", "\nc\na"]
    for some in (texts, texts[::-1]):
        own = Aligner(A, B)
        for text in some:
            (a, b), = own.encode([text])
            wanted = [[t for t, *_ in side] for side in spans(text)]
            assert [np.frombuffer(x, "<u4").tolist() for x in (a, b)] == wanted


def test_tables_are_emptied(monkeypatch):
    """Few parts are remembered; the ids stay the same."""
    monkeypatch.setattr("basketry.llm.alignment.MAX_KEPT", 5)
    monkeypatch.setattr("basketry.llm.alignment.MAX_TAILS", 2)
    own = Aligner(A, B)
    for round_ in range(6):
        texts = [f"word{round_} one, two; three! {'y' * 100}.\nFour, five{round_} é?" for _ in range(3)] + ["one two; x."]
        for text, (a, b) in zip(texts, own.encode(texts)):
            wanted = [[t for t, *_ in side] for side in spans(text)]
            assert [np.frombuffer(x, "<u4").tolist() for x in (a, b)] == wanted
    assert len(own.kept) < 60 and not any(len(p) > 64 for p in own.kept)


def test_special_strings_are_plain_text():
    (n_a, n_b, *_), = Aligner(A, B).align(["<|endoftext|></s>"])
    assert n_a > 2 and n_b > 2
