from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import exact_dedup as exact_dedup_module
from basketry.llm.exact_dedup import build_filter, exact_dedup, probe

@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 100, 5000, 120_000])
def test_filter_has_no_false_negative(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**60, n, dtype=np.uint64))
    f = build_filter(keys)
    assert probe(keys, *f).all()
    other = rng.integers(2**60, 2**61, 100_000, dtype=np.uint64)
    assert probe(other, *f).mean() < 0.001
    if n >= 5000:
        assert len(f[3]) / 2 / n < 1.6   # slots a key


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(hashlib.sha256(
            bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())).hexdigest(), []).append(i)
    return sorted((i, max(g), len(g), i == max(g), d) for d, g in groups.items() for i in g)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in rows],
                               "doc_id bigint, text string, digest string, `keep_id` string")
    got = exact_dedup(df, F.col("doc_id") % 2 == 0, **kw).drop("in_snapshot").collect()
    return sorted(tuple(r) for r in got)


def test_groups(spark):
    rng = np.random.default_rng(3)
    rows = [(i, f"Text {int(rng.integers(0, 150))}") for i in range(400)]
    rows += [(400 + i, "HOT É" if i % 2 else "hot É") for i in range(200)]
    rows += [(600, None), (601, ""), (602, "hot é"), (603, "x" * 200_000), (605, "X" * 200_000)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, bucket_digests=20) == brute(rows)


def test_empty_parts(spark):
    assert run(spark, []) == []
    only_new = [(1, "a"), (3, "A"), (5, "b")]
    assert run(spark, only_new) == brute(only_new)
    only_old = [(2, "a"), (4, "A"), (6, "b")]
    assert run(spark, only_old) == brute(only_old)


def test_repeated_ids(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "b"), (2, "a")]
    assert run(spark, rows) == brute(rows)


def test_a_small_snapshot_does_not_gather_the_batch(spark, monkeypatch):
    """50 digests in the snapshot, 3000 incoming: no task probes more than a bucket's worth."""
    rows = [(2 * i, f"old {i}") for i in range(50)] + [(2 * i + 1, f"new {i}") for i in range(2950)]
    rows += [(2 * i + 101, f"OLD {i}") for i in range(50)]
    screen = exact_dedup_module.screen
    largest = []

    def watched(groups, filters, n_buckets):
        largest.append(exact_dedup_module._bucketed(groups, n_buckets).groupBy("bucket").count().agg(
            F.max("count")).first()[0])
        return screen(groups, filters, n_buckets)

    monkeypatch.setattr(exact_dedup_module, "screen", watched)
    assert run(spark, rows, bucket_digests=100) == brute(rows)
    assert 0 < largest[0] < 200


def test_null_ids(spark):
    rows = [(None, "a"), (None, "A"), (3, "a"), (None, "only"), (None, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(
        df, F.col("doc_id") % 2 == 0).collect()), key=repr)
    assert got == sorted([(None, 3, 3, False), (None, 3, 3, False), (3, 3, 3, True), (None, None, 1, True),
                          (None, 4, 2, False), (4, 4, 2, True)], key=repr)
