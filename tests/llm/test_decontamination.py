from __future__ import annotations

import re

import numpy as np
import pytest

from basketry.llm import decontamination
from basketry.llm.decontamination import contamination

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[s:s + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(k) for k in wins}:
            for s in range(len(w) - n + 1):
                if (g := wins.get(tuple(w[s:s + n]))) is not None:
                    hit |= set(range(s, s + n))
                    found |= g
        found = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(found), found, bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs],
                              "doc_id bigint, text string, words string, `row` int")
    b = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id bigint, text string, len string")
    return sorted((tuple(r) for r in contamination(d, b, **options).collect()), key=str)


def corpus(seed, n_docs=120, vocabulary=60):
    rng = np.random.default_rng(seed)
    v = [f"w{i}" for i in range(vocabulary)] + ["É", "naïve", "日本", "x1"]

    def text(n):
        return " ".join(rng.choice(v, n))

    items = [(i, text(int(rng.integers(1, 40)))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "--- !!"), (53, items[3][1]), (54, "w1, W2; w3."), (None, text(15))]
    docs = []
    for i in range(n_docs):
        t = text(int(rng.integers(0, 120)))
        if i % 3 == 0:
            w = items[int(rng.integers(0, 30))][1].split()
            lo = int(rng.integers(0, len(w)))
            t = t + ". " + ", ".join(w[lo:lo + int(rng.integers(1, 30))]).upper() + "\n" + text(5)
        docs.append((i, t))
    docs += [(500, None), (501, ""), (502, "w1 " * 3000), (502, items[0][1]), (502, items[0][1])]
    return docs, items


@pytest.mark.parametrize("window", [10, 4])
def test_equals_brute_force(spark, window, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 3000)
    docs, items = corpus(window)
    assert run(spark, docs, items, window=window) == brute(docs, items, window)


def test_full_bitmap_only_costs_time(spark, monkeypatch):
    docs, items = corpus(7, 40)
    monkeypatch.setattr(decontamination, "_in_bitmap", lambda table, h: np.ones(len(h), bool))
    assert run(spark, docs, items) == brute(docs, items)


def test_very_common_passage_and_empty_tables(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, f"intro{i} {passage} end{i}") for i in range(300)] + [(999, "clean text here")]
    items = [(i, passage) for i in range(20)]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []
