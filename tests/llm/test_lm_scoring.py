from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import lm_scoring
from basketry.llm.common import crc_mod
from basketry.llm.lm_scoring import lm_scores

END = object()


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [END]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


class Brute:
    """The suffix tree over dictionaries of strings, straight from its definition."""

    def __init__(self, texts, depth=3, min_word=1e-5, min_string=1e-6, min_deviance=20.0, d=0.5):
        self.d, self.depth = d, depth
        docs = [tokens(t) for t in texts]
        self.c = Counter(w for t in docs for w in t)
        self.n, self.v = sum(self.c.values()), len(self.c)
        word_floor = max(2, math.ceil(min_word * self.n))
        floor = max(2, math.ceil(min_string * self.n))
        self.levels = [{(w,): n for w, n in self.c.items() if n >= word_floor}]
        for length in range(2, depth + 2):
            found = Counter(tuple(t[i:i + length]) for t in docs for i in range(len(t) - length + 1)
                            if tuple(t[i:i + length - 1]) in self.levels[-1] and (t[i + length - 1],) in self.levels[0])
            self.levels.append({s: n for s, n in found.items() if n >= floor})
        self.children = {}
        for level in self.levels[1:]:
            for s, n in level.items():
                self.children.setdefault(s[:-1], {})[s[-1]] = n
        self.states = set()
        for length in range(1, depth + 1):
            for s, kids in self.children.items():
                if len(s) != length:
                    continue
                of = self.levels[length - 1][s]
                for w, n in kids.items():
                    e = of * self.p(w, self.longest(s[1:]))
                    if 2 * (n * math.log(n / e) - (n - e)) >= min_deviance:
                        self.states.add(s)
                        break

    def base(self, w):
        return (self.c.get(w, 0) + 0.5) / (self.n + 0.5 * (self.v + 1))

    def longest(self, context):
        context = tuple(context[max(0, len(context) - self.depth):])
        while context and context not in self.states:
            context = context[1:]
        return context

    def p(self, w, state):
        if not state:
            return self.base(w)
        kids, of = self.children[state], self.levels[len(state) - 1][state]
        rest = 1 - sum(n - self.d for n in kids.values()) / of
        return (max(0, kids.get(w, 0) - self.d) / of if w in kids else 0) + rest * self.p(
            w, self.longest(state[1:]))

    def score(self, text):
        t = tokens(text)
        return sum(math.log10(self.p(w, self.longest(t[:i]))) for i, w in enumerate(t))


def corpus(seed, n=150):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    lines = [" ".join(rng.choice(vocabulary, 9)) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 25)))) + f" rare{i}"]
        if rng.random() < 0.7:
            parts.insert(0, lines[int(rng.integers(0, 6))])
        out.append((i, "\n".join(parts)))
    return out + [(900, None), (901, ""), (902, "W1 w1  É é"), (903, "w1 " * 3000)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                                 "doc_id bigint, text string, score string, block int")


def check(spark, rows, **options):
    got = sorted(lm_scores(frame(spark, rows), crc_mod("doc_id", 5) == 1, **options).collect(), key=str)
    assert len(got) == len(rows)
    model = Brute([t for i, t in rows if not held(i)], **options)
    text = dict(rows)
    for r in got:
        t = tokens(text[r.doc_id])
        assert r.held_out == held(r.doc_id) and r.n_tokens == len(t) and r.train_tokens == model.n
        assert r.n_known == sum(model.c[w] > 0 for w in t)
        assert r.base_score == pytest.approx(sum(math.log10(model.base(w)) for w in t), rel=1e-9)
        assert r.score == pytest.approx(model.score(text[r.doc_id]), rel=1e-9)
    return model


def test_equals_brute_force(spark, monkeypatch):
    rows = corpus(1)
    model = check(spark, rows)
    assert {len(s) for s in model.states} == {1, 2, 3}
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", 100)
    monkeypatch.setattr(lm_scoring, "STRINGS_HELD", 50)
    check(spark, rows)
    check(spark, rows, min_deviance=6.0, depth=2)


def test_states_are_distributions():
    model = Brute([t for _, t in corpus(2)])
    known = list(model.c)
    for state in [(), *list(model.states)[:25]]:
        unknown = model.p("never seen", state)
        assert sum(model.p(w, state) for w in known) + unknown == pytest.approx(1, rel=1e-9)


def test_held_out_text_is_predicted_better_than_by_words(spark):
    rows = corpus(3, 600)
    got = lm_scores(frame(spark, rows), crc_mod("doc_id", 5) == 1).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_nothing_to_learn_from(spark):
    assert lm_scores(frame(spark, []), crc_mod("doc_id", 5) == 1).count() == 0
    only = [i for i in range(50) if held(i)][:3]
    got = lm_scores(frame(spark, [(i, "a b") for i in only]), crc_mod("doc_id", 5) == 1).collect()
    assert [(r.n_known, r.train_tokens) for r in got] == [(0, 0)] * 3
    assert all(r.score == r.base_score == pytest.approx(0) for r in got)


def test_repeated_rows_and_null_ids(spark):
    rows = [(2, "a b c"), (2, "a b c"), (2, "other"), (None, "a b c")]
    got = lm_scores(frame(spark, rows), crc_mod("doc_id", 5) == 1).collect()
    assert sorted((r.doc_id is None, r.n_tokens) for r in got) == [(False, 2), (False, 4), (False, 4), (True, 4)]


def test_strings_take_part_whatever_the_size_of_the_corpus(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(vocabulary, 1000))) for i in range(400)]
    train = [i for i, _ in rows if not held(i)]
    for i in train[:2]:
        rows[i] = (i, rows[i][1] + " alpha beta gamma delta")
    rows.append((next(i for i in range(1000, 2000) if held(i)), "alpha beta gamma delta"))
    model = Brute([t for i, t in rows if not held(i)], min_word=0, min_string=0)
    assert 1e-5 * model.n > 2 and {("alpha",), ("gamma",)} <= model.states
    got = {r.doc_id: r for r in lm_scores(frame(spark, rows), crc_mod("doc_id", 5) == 1).collect()}
    for i, t in [*rows[:12], rows[-1]]:
        assert got[i].score == pytest.approx(model.score(t), rel=1e-9)
    assert got[rows[-1][0]].score > got[rows[-1][0]].base_score + 5


def test_questions_and_replies_are_short(spark):
    """A key and its count take eight bytes, not twelve, and a place and a total two or three, not thirteen."""
    rows = [(i, " ".join(f"w{i * 500 + j}" for j in range(1000))) for i in range(100)]
    docs = frame(spark, rows).coalesce(1).select("doc_id", "text", crc_mod("doc_id", 5).alias("m"))
    condensed = lm_scoring.blocks(docs.selectExpr("doc_id", "text", "m = 1 as held_out")).cache()
    asked = lm_scoring.ask_words(condensed, 4)
    size = asked.selectExpr("sum(length(keys) + length(n))").first()[0]
    assert size < 8.1 * len({w for _, t in rows for w in tokens(t)})
    told = lm_scoring.answers(asked.union(asked.selectExpr(
        "kind", "bucket", "block + 1", "lo", "keys", "n", "kids")), 1).where("block >= 0")
    sizes = told.selectExpr("sum(length(at) + length(value))", "count(distinct block)").first()
    assert sizes[0] < 2.5 * 2 * 50501 and sizes[1] == 2


def test_keys_and_numbers_are_kept_whole():
    rng = np.random.default_rng(5)
    for numbers in ([], [0], [255, 256], [2**64 - 1, 0, 1], rng.integers(0, 2**40, 1000)):
        numbers = np.array(numbers, np.uint64)
        assert (lm_scoring._unpacked(lm_scoring._packed(numbers)) == numbers).all()
        if len(numbers):
            keys = np.unique(numbers)
            assert (lm_scoring._unpacked_keys(lm_scoring._packed_keys(keys)) == keys).all()
    # keys that agree in all but the lowest bits, and keys that come again
    for keys in (rng.integers(0, 50, 3000), rng.integers(0, 2**63, 3000), rng.integers(0, 9, 3000) << 50, []):
        keys = np.array(keys, np.uint64)
        assert (lm_scoring._order(keys) == np.argsort(keys, kind="stable")).all()
        wanted = np.unique(keys, return_index=True, return_inverse=True)
        assert all((x == y).all() for x, y in zip(lm_scoring._distinct(keys), wanted))


def test_words_are_cut_at_ascii_white_space(spark):
    texts = [" a B\x0b\x0cb\r\na ", "\t\n", "", None, "\u00a0a\u2003 \x1c\x1d É", "\x00 \x7f  a"]
    found, count = lm_scoring._words(pa.array([t or "" for t in texts]))
    wanted = [tokens(t)[:-1] for t in texts]
    assert count.tolist() == [len(w) for w in wanted]
    assert found.to_pylist() == [w for t in wanted for w in t]
    check(spark, [(i, t) for i, t in enumerate(texts * 3)])
