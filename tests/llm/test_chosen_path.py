from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from basketry.llm import chosen_path
from basketry.llm.chosen_path import (
    MAX_DIFFER, TOKENS, candidates, chosen_path_dedup, confirmed, minwise, shingle_set, sketch, spanning, trees_for)


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words)} if len(words) == 1 else set(zip(words, words[1:]))


def brute(rows):
    """(doc_id, n, component, kept) by union of every pair of rows."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = low.get(find(i))
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 1, b"") for i, t in rows],
                               "doc_id bigint, text string, cls int, `key` binary").repartition(3)
    return sorted((tuple(r) for r in chosen_path_dedup(df, **kw).collect()), key=repr)


def corpus(seed, n=60):
    """Near copies at many similarities around the threshold, repeats and odd rows."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(3000)     # noqa: E731
    rows = []
    for i in range(n):
        base = [word() for _ in range(rng.randint(5, 80))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 6))):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), rng.choice([" ", "\n", "  "]).join(copy)))
    rows += [(5, rows[5][1])] * 3 + [(None, rows[7][1]), (None, "only null ids"), (None, "ONLY null IDS")]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "single"), (904, "SINGLE"), (905, "a b"), (906, "a  b"),
             (907, "É b"), (908, "é b"), (909, "a b a b a b"), (910, " ".join(str(i) for i in range(30_000))),
             (911, " ".join(str(i) for i in range(29_000)))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    want = brute(rows)
    assert run(spark, rows) == want
    # nodes of three classes: every level of the tree, and the tiles below it; groups in tiles
    assert run(spark, rows, small=3, group_rows=4, group_hashes=300) == want


def test_large_nodes_are_branched_and_dealt_as_tiles(spark, monkeypatch):
    """Boilerplate in every document: nodes are large and hold unlike documents."""
    rng = random.Random(9)
    head = ["h%d" % i for i in range(30)]
    rows = []
    for i in range(80):
        own = ["x%d_%d" % (i // 2, j) for j in range(60)]
        if i % 2:
            own[rng.randrange(60)] = "changed"
        rows.append((i, " ".join(head + own)))
    calls = []
    tiled = chosen_path._tiled
    monkeypatch.setattr(chosen_path, "_tiled", lambda *a: calls.append(1) or tiled(*a))
    want = brute(rows)
    assert run(spark, rows, small=4) == want and len({c for _, _, c, _ in want}) == 40
    calls.clear()
    monkeypatch.setattr(chosen_path, "_levels", lambda trees: 1)
    assert run(spark, rows, small=4) == want and calls


def test_a_chain_is_one_component(spark):
    """Each text is near the next only; the ends share little."""
    words = ["c%d" % i for i in range(400)]
    rows = [(100 - i, " ".join(words[i * 4:i * 4 + 50])) for i in range(80)]
    got = run(spark, rows)
    assert got == brute(rows) and len({c for _, _, c, _ in got}) == 1


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(3, None), (4, "")]) == [(3, 0, 3, True), (4, 0, 4, True)]


def test_tokens_agree_as_often_as_sets_do():
    rng = np.random.default_rng(5)
    agree, differ = [], []
    for _ in range(300):
        x = rng.integers(0, 2**63, 300, dtype=np.uint64)
        y = np.r_[x[:-33], rng.integers(0, 2**63, 33, dtype=np.uint64)]     # 267 of 333: 0.80
        tokens = minwise([np.unique(x), np.unique(y)])
        agree.append((tokens[0] == tokens[1]).mean())
        s0, s1 = sketch(tokens)
        z = [int(s[0] ^ s[1]) for s in (s0, s1)]
        differ.append(sum(((v | v >> 1) & 0x5555555555555555).bit_count() for v in z))
        assert differ[-1] == int(((tokens[0] ^ tokens[1]) & 3 != 0).sum())
    assert abs(np.mean(agree) - 267 / 333) < 0.01
    assert max(differ) <= MAX_DIFFER and 8 < np.mean(differ) < 11


def test_minwise_runs_hold_whole_sets(monkeypatch):
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 5, 300, 2, 1000, 7)]
    once = minwise(sets)
    monkeypatch.setattr(chosen_path, "HASHES_AT_ONCE", 8)
    assert (minwise(sets) == once).all() and once.shape == (6, TOKENS)


def test_trees_reach_the_recall():
    assert trees_for(80, 1 - 1e-6) == 5
    assert trees_for(80, 0.9) == 1
    assert trees_for(90, 1 - 1e-6) < 5 < trees_for(70, 1 - 1e-6)


def test_recall_of_pairs_at_the_threshold():
    """A pair of 0.8 meets in some node of the five trees, even where all nodes go to the bottom."""
    rng = np.random.default_rng(7)
    found = 0
    tokens = rng.random((20_000, TOKENS)) < 0.8         # which tokens a pair has in common
    path = lambda *k: xxhash.xxh64_intdigest(repr(k).encode())     # noqa: E731

    def meets(common, p, first):
        if first + 9 > TOKENS:
            return True
        a, step = p % 9, (p >> 20) % 8 + 1
        return any(common[first + c] and meets(common, path(p, c), first + 9) for c in (a, (a + step) % 9))

    for row in tokens:
        found += any(row[t] and meets(row, path(i, t), 10) for i, t in enumerate(range(10)))
    assert found >= 20_000 - 2


def test_candidates_are_all_pairs_of_a_node(monkeypatch):
    rng = np.random.default_rng(8)
    node = np.sort(rng.integers(0, 12, 200))
    cls = np.arange(200)
    label = rng.integers(0, 40, 200)
    n = rng.integers(50, 70, 200)
    s = [np.zeros(200, np.uint64), np.zeros(200, np.uint64)]
    want = {(i, j) for i in range(200) for j in range(i + 1, 200) if node[i] == node[j] and label[i] != label[j]
            and 100 * min(n[i], n[j]) >= 80 * max(n[i], n[j])}
    for at_once in (1, 17, 1 << 20):
        monkeypatch.setattr(chosen_path, "PAIRS_AT_ONCE", at_once)
        got = [(x, y) for i, j, _ in candidates(node, label, cls, n, *s, 80) for x, y in zip(i.tolist(), j.tolist())]
        assert len(got) == len(set(got)) and set(got) == want


def test_shingle_sets():
    assert len(shingle_set(None)) == len(shingle_set(" \t\x0b\x0c\r\n")) == 0
    assert (shingle_set("A b\x0bC") == shingle_set("a  B\nc")).all() and len(shingle_set("a b c")) == 2
    assert len(shingle_set("a b a b")) == 2 and len(shingle_set("a")) == 1
    assert shingle_set("a b")[0] != shingle_set("b a")[0] and shingle_set("a")[0] != shingle_set("a a")[0]
    assert len(shingle_set("a\x1cb")) == 1          # no white space here


def _components(n, links):
    root = list(range(n))
    for a, b in links:
        ra, rb = root[a], root[b]
        root = [min(ra, rb) if r in (ra, rb) else r for r in root]
    return root


def test_spanning_links():
    rng = np.random.default_rng(10)
    for m in (0, 1, 30, 90):
        u, v = rng.integers(0, 80, m), rng.integers(0, 80, m)
        nodes, low = spanning(u, v)
        want = _components(80, zip(u.tolist(), v.tolist()))
        got = np.arange(80)
        got[nodes] = low
        assert got.tolist() == want and len(nodes) == len(set(nodes.tolist()))
    chain = np.arange(5000)
    assert (spanning(chain[1:], chain[:-1])[1] == 0).all()


@pytest.mark.parametrize("at_once", [1, 40, 1 << 20])
def test_confirmed_links_span_what_all_pairs_do(monkeypatch, at_once):
    """Chains and stars around the threshold, groups side by side."""
    monkeypatch.setattr(chosen_path, "PAIRS_AT_ONCE", at_once)
    rng = np.random.default_rng(11)
    group, sets = [], []
    for g in range(6):
        base = rng.integers(0, 2**62, 60, dtype=np.uint64)
        for _ in range(int(rng.integers(2, 25))):
            x = base.copy()
            x[rng.integers(0, 60, int(rng.integers(0, 12)))] = rng.integers(0, 2**62, 1, dtype=np.uint64)
            group.append(g)
            sets.append(np.unique(x))
    s0, s1 = sketch(minwise(sets))
    u, v = confirmed(np.array(group), np.array([len(x) for x in sets]), s0, s1, sets, 80)
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if group[i] == group[j]
             and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    want = _components(len(sets), pairs)
    assert _components(len(sets), zip(u.tolist(), v.tolist())) == want and 6 < len(set(want)) < len(sets)
