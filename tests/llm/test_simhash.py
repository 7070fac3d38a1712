from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import simhash
from basketry.llm.common import Scratch, signed
from basketry.llm.components import components
from basketry.llm.simhash import fingerprint, gray_rank, link_groups, links, near_dedup


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(keys, near):
    """Component of each position: the smallest position reachable."""
    label = list(range(len(keys)))
    changed = True
    while changed:
        changed = False
        for i in range(len(keys)):
            for j in range(i):
                if label[i] != label[j] and near(keys[i], keys[j]):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def close(a, b):
    return (a ^ b).bit_count() <= 3


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from(list("aBÉé \t\n\x0b\xa0\x1c.")), max_size=40))
def test_fingerprint_equals_the_definition(text):
    assert fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    whole = fingerprint(text)
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 7)
    assert fingerprint(text) == whole == slow_fingerprint(text)


def test_gray_rank_inverts_the_gray_code():
    n = np.arange(1000, dtype=np.uint64)
    assert (gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def random_codes(rng, n):
    """Chains and balls of near codes, next to unrelated ones."""
    out = {int(x) for x in rng.integers(0, 2**63, max(1, n // 2))}
    while len(out) < n:
        c = int(rng.choice(np.array(sorted(out), dtype=np.uint64)))
        for _ in range(int(rng.integers(1, 5))):
            c ^= 1 << int(rng.integers(0, 64))
        out.add(c)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("n,groups", [(1, 1), (2, 1), (60, 1), (200, 3), (200, 150)])
def test_index_finds_the_components(n, groups):
    rng = np.random.default_rng(n + groups)
    codes = random_codes(rng, n)
    group = rng.integers(0, groups, n)
    _, group = np.unique(group, return_inverse=True)
    got_codes, roots = link_groups(group, codes)
    mine = {}
    for c, r in zip(got_codes.tolist(), roots.tolist()):
        mine.setdefault(r, set()).add(c)
    want = set()
    for g in set(group.tolist()):
        own = codes[group == g].tolist()
        label = classes(own, close)
        want |= {frozenset(c for c, x in zip(own, label) if x == l) for l in set(label)}
    assert {frozenset(s) for s in mine.values()} == want


def partition(pairs):
    out = {}
    for node, root in pairs:
        out.setdefault(root, {root}).add(node)
    return {frozenset(s) for s in out.values()}


@pytest.mark.parametrize("max_group", [20_000, 30, 4])
def test_routed_links_lose_nothing(spark, max_group):
    rng = np.random.default_rng(5)
    codes = random_codes(rng, 150)
    dense = np.array([int(codes[0]) ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i)], np.uint64)
    codes = np.unique(np.r_[codes, dense])
    df = spark.createDataFrame([(int(c),) for c in signed(codes)], "code bigint")
    scratch = Scratch(spark)
    got = partition((r.node, r.root) for r in components(
        links(df, max_group=max_group, scratch=scratch), scratch).collect())
    own = codes.tolist()
    label = classes(own, close)
    as_long = {c: int(s) for c, s in zip(own, signed(codes))}
    want = {frozenset(as_long[c] for c, x in zip(own, label) if x == l) for l in set(label)}
    assert got == {s for s in want if len(s) > 1}


def test_components_of_a_long_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [
        (5000, 5000), (None, 1), (7001, 7000), (7000, 7001)]
    df = spark.createDataFrame(pairs, "u bigint, v bigint")
    got = {r.node: r.root for r in components(df, Scratch(spark)).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 300)}, 7001: 7000}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "u bigint, v bigint"), Scratch(spark)).count() == 0


def test_near_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"word{i}" for i in range(300)]
    texts = [" ".join(rng.choice(vocabulary, int(rng.integers(60, 200)))) for _ in range(60)]
    for t in texts[:25]:
        words = t.split()
        words[int(rng.integers(0, len(words)))] = "changed"
        texts += [" ".join(words), t.upper()]
    texts += [None, "", "  \n", "one", "one two", "ONE two", "a " * 30_000]
    rows = [(1000 - i, t, f"c{i}", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, code string, component_id int")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_dedup(df).collect()}
    rows = sorted(rows)
    prints = [slow_fingerprint(t) for _, t, _, _ in rows]
    label = classes(prints, close)
    lowest = {l: min(r[0] for r, x in zip(rows, label) if x == l) for l in set(label)}
    assert got == {r[0]: (f"{p:016x}", lowest[l]) for r, p, l in zip(rows, prints, label)}


def test_near_dedup_of_nothing_and_of_repeated_rows(spark):
    df = spark.createDataFrame([(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (9, "x")],
                               "doc_id bigint, text string")
    assert near_dedup(df.limit(0)).count() == 0
    got = sorted((r.doc_id is None, r.doc_id, r.component_id) for r in near_dedup(df).collect()
                 if r.doc_id is not None)
    assert got == [(False, 3, 3), (False, 3, 3), (False, 9, 9)]
    assert [r.component_id for r in near_dedup(df).collect() if r.doc_id is None] == [3]
