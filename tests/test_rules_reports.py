"""Association rules, report lines, report round trip (T9, T11, T17)."""

from __future__ import annotations

import random

import brute
import pytest
from conftest import tx_frame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators import (
    association_rules,
    frequent_itemsets,
    grown_rules,
    itemset_report_lines,
    proper_subsets,
    rule_report_lines,
)
from basketry.operators import rules
from basketry.sources import read_itemset_report, write_lines
from basketry.sources.streamed import write_itemset_report


def _sets(spark, rows):
    """rows: (items list, support)."""
    return spark.createDataFrame([(list(s), len(s), sup) for s, sup in rows],
                                 "items array<int>, k int, support bigint")


def _rule_dict(df):
    return {(tuple(r.antecedent), tuple(r.consequent)): r.confidence for r in df.collect()}


def test_confidence_is_float_division(spark):
    sets = _sets(spark, [([1], 5), ([2], 3), ([1, 2], 3)])
    lines = [r.line for r in rule_report_lines(association_rules(sets, 0.6)).collect()]
    assert lines == ["2\t1\t1.0", "1\t2\t0.6"]
    sets2 = _sets(spark, [([1], 3), ([2], 2), ([1, 2], 2)])
    lines2 = [r.line for r in rule_report_lines(association_rules(sets2, 0.6)).collect()]
    assert lines2 == ["2\t1\t1.0", "1\t2\t0.6666667"]


def test_bag_rules_above_one_and_missing_subsets(spark):
    # bag supports: {1}=3, {2}=2, {1,2}=3 -> confidence({2}->{1}) = 1.5
    sets = _sets(spark, [([1], 3), ([2], 2), ([1, 2], 3)])
    got = _rule_dict(association_rules(sets, None))
    assert got[((2,), (1,))] == 1.5 and got[((1,), (2,))] == 1.0
    # a subset missing from the table yields no rule
    partial = _sets(spark, [([1], 3), ([1, 2], 3)])
    assert list(_rule_dict(association_rules(partial, None))) == [((1,), (2,))]


def test_subset_count_and_bitmask_order(spark):
    sets = _sets(spark, [([3, 5, 9], 2)])
    subs = [tuple(r.subset) for r in proper_subsets(sets).orderBy("mask").collect()]
    assert subs == [(3,), (5,), (3, 5), (9,), (3, 9), (5, 9)]


def test_rules_match_brute_force(spark):
    rng = random.Random(5)
    rows = [(f"t{t}", i, 1) for t in range(30)
            for i in rng.sample(range(1, 9), rng.randint(2, 8))]
    res = frequent_itemsets(tx_frame(spark, rows), 0.25, 5)
    freq = {tuple(r["items"]): r["support"] for r in res.itemsets.collect()}
    want = brute.rules(freq, 0.6)
    got = _rule_dict(association_rules(res.itemsets, 0.6))
    assert got == want
    everything = association_rules(res.itemsets, None)
    per_set = everything.groupBy(
        F.array_sort(F.array_union("antecedent", "consequent")).alias("s")).count()
    assert all(r["count"] == 2 ** len(r.s) - 2 for r in per_set.collect())
    assert everything.where((F.col("confidence") <= 0) | (F.col("confidence") > 1)).count() == 0


def test_itemset_report_lines_order(spark):
    sets = _sets(spark, [([10], 4), ([9], 4), ([2, 100], 4), ([2, 9], 4), ([1], 7)])
    lines = [r.line for r in itemset_report_lines(sets).collect()]
    assert lines == ["7\t1", "4\t9\t10\t2;9\t2;100"]


def test_report_roundtrip_is_identity(spark, ws):
    rng = random.Random(3)
    rows = [(f"t{t}", i, 1) for t in range(25)
            for i in rng.sample(range(1, 12), rng.randint(2, 9))]
    res = frequent_itemsets(tx_frame(spark, rows), 0.2, 4)
    path = ws.location("report")
    write_lines(itemset_report_lines(res.itemsets), path)
    back = read_itemset_report(spark, path, item_type=T.IntegerType())
    key = lambda df: sorted((tuple(r["items"]), r["k"], r["support"]) for r in df.collect())
    assert key(back) == key(res.itemsets)


def test_single_file_sink_keeps_order(spark, ws):
    sets = _sets(spark, [([i], i) for i in range(1, 60)])
    path = ws.location("lines")
    write_lines(itemset_report_lines(sets.repartition(7)), path, single_file=True)
    files = [f for f in spark.read.text(path).inputFiles()]
    assert len(files) == 1
    supports = [int(r.value.split("\t")[0]) for r in spark.read.text(path).collect()]
    assert supports == sorted(supports, reverse=True)


def test_rules_shuffle_lookup_equals_broadcast(spark):
    rng = random.Random(8)
    rows = [(f"t{t}", i, 1) for t in range(30)
            for i in rng.sample(range(1, 9), rng.randint(2, 8))]
    sets = frequent_itemsets(tx_frame(spark, rows), 0.25, 5).itemsets
    a = _rule_dict(association_rules(sets, None))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = _rule_dict(association_rules(sets, None))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert a == b and len(a) > 0


def test_report_items_in_any_order_give_the_same_rules(spark, ws):
    lines = ["5\t1\t2\t3", "4\t2;1\t1;3", "3\t3;2\t3;1;2"]
    path = ws.location("report")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    got = {(frozenset(r.antecedent), frozenset(r.consequent)): r.confidence
           for r in association_rules(read_itemset_report(spark, path), None).collect()}
    sorted_sets = _sets(spark, [([1], 5), ([2], 5), ([3], 5), ([1, 2], 4), ([1, 3], 4),
                                ([2, 3], 3), ([1, 2, 3], 3)])
    want = {(frozenset(map(str, r.antecedent)), frozenset(map(str, r.consequent))): r.confidence
            for r in association_rules(sorted_sets, None).collect()}
    assert got == want and len(got) == 12


def test_text_ids_stay_distinct(spark, ws):
    # "01" and "1" are two items
    lines = ["5\t01\t1\tBRCA1", "4\t01;1\tBRCA1;1"]
    path = ws.location("report")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    got = {(tuple(r.antecedent), tuple(r.consequent))
           for r in association_rules(read_itemset_report(spark, path), None).collect()}
    assert got == {(("01",), ("1",)), (("1",), ("01",)), (("BRCA1",), ("1",)), (("1",), ("BRCA1",))}


def test_masks_of_large_sets(spark, monkeypatch):
    sets = _sets(spark, [(list(range(17)), 2), ([1, 2], 3)])
    subs = proper_subsets(sets)
    assert subs.count() == 2 ** 17 - 2 + 2 == subs.select("items", "subset").distinct().count()
    # many runs of bits: 31 items and more differ from this in the number of rows only
    monkeypatch.setattr(rules, "CHUNK_BITS", 2)
    subs = proper_subsets(_sets(spark, [(list(range(9)), 2), ([1, 2, 3], 3), ([7], 1)]))
    got = {(tuple(r["items"]), r.mask): tuple(r.subset) for r in subs.collect()}
    assert len(got) == subs.count() == 2 ** 9 - 2 + 6
    assert all(s == tuple(x for i, x in enumerate(items) if mask >> i & 1)
               for (items, mask), s in got.items())


def test_itemset_table_roundtrip(spark, ws):
    from basketry.sources import read_itemset_table, write_itemset_table
    sets = _sets(spark, [([1], 3), ([2], 2), ([1, 2], 2)])
    path = ws.location("table")
    write_itemset_table(sets, path)
    assert _rule_dict(association_rules(read_itemset_table(spark, path), None)) == \
        _rule_dict(association_rules(sets, None))


def test_confidence_rounds_large_supports_to_float(spark):
    import numpy as np

    from basketry.functions import float_ratio
    rows = [(16777217, 1), (33554435, 7), (123456789, 98765), (5, 3)]
    df = spark.createDataFrame(rows, "s bigint, r bigint")
    got = [r.c for r in df.select(float_ratio("s", "r").cast("double").alias("c")).collect()]
    assert got == [float(np.float32(s) / np.float32(r)) for s, r in rows]


def test_parallel_sink_part_files_hold_total_order(spark, ws):
    import glob
    import os
    sets = _sets(spark, [([i], (i * 37) % 101 + 1) for i in range(1, 200)])
    path = ws.location("lines")
    write_lines(itemset_report_lines(sets.repartition(9)), path, single_file=False)
    local = path.replace("file:", "")
    lines = []
    for f in sorted(glob.glob(os.path.join(local, "part-*"))):
        with open(f) as fh:
            lines.extend(fh.read().splitlines())
    supports = [int(x.split("\t")[0]) for x in lines]
    assert supports == sorted(supports, reverse=True) and len(supports) == len(set(supports))


def _report_key(df):
    return sorted((tuple(r["items"]), r["k"], r["support"]) for r in df.collect())


def _with_conf(spark, settings):
    before = {c: spark.conf.get(c, None) for c in settings}
    for c, v in settings.items():
        spark.conf.set(c, v)
    return before


def _restore(spark, before):
    for c, v in before.items():
        spark.conf.unset(c) if v is None else spark.conf.set(c, v)


def test_a_line_longer_than_many_splits(spark, ws):
    """The longest line is hundreds of splits; its support is carried into each."""
    rng = random.Random(6)
    sets = [([i], 900) for i in range(40)]
    sets += [([i, i + j], 17) for i in range(1500) for j in (1, 5, 9)] + [([i, i + 1, i + 2], 3) for i in range(700)]
    rng.shuffle(sets)
    table = _sets(spark, sets)
    path = ws.location("report")
    write_lines(itemset_report_lines(table), path)
    longest = max(len(r.line) for r in itemset_report_lines(table).collect())
    before = _with_conf(spark, {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "0"})
    try:
        back = read_itemset_report(spark, path, item_type=T.IntegerType())
        splits = spark.read.option("lineSep", "\t").text(path).rdd.getNumPartitions()
        got = _report_key(back)
    finally:
        _restore(spark, before)
    assert longest > 100 * 200 and splits > 150
    assert got == _report_key(table)


def test_report_layouts(spark, ws):
    """Line ends, a line without sets, no line end at the end, several files."""
    import os

    folder = ws.location("layouts").replace("file:", "")
    os.makedirs(folder)
    texts = {"a": "5\t1\t2;3\r\n4\n3\t7;8\t9\n", "b": "2\t4", "c": "8\n", "d": "", "e": "6\t1;2\n5\t3\n1\t2"}
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w", newline="") as f:
            f.write(text)
    want = [((1,), 1, 5), ((1, 2), 2, 6), ((2,), 1, 1), ((2, 3), 2, 5), ((3,), 1, 5), ((4,), 1, 2),
            ((7, 8), 2, 3), ((9,), 1, 3)]
    for size in ("1", "3", "134217728"):
        before = _with_conf(spark, {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "0"})
        try:
            assert _report_key(read_itemset_report(spark, folder, item_type=T.IntegerType())) == want
        finally:
            _restore(spark, before)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", ["4x\t1\t2\n", "4\t1\n\t2\n", "4\t1\n5y\n3\t2\n", "4\t1;z\n"])
def test_a_malformed_report_raises(spark, ws, ansi, text):
    path = ws.location("malformed")
    import os
    os.makedirs(path.replace("file:", ""))
    with open(path.replace("file:", "") + "/part", "w") as f:
        f.write(text)
    before = _with_conf(spark, {"spark.sql.ansi.enabled": ansi})
    try:
        with pytest.raises(Exception, match="malformed"):
            association_rules(read_itemset_report(spark, path, item_type=T.IntegerType()), None).collect()
    finally:
        _restore(spark, before)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("confidence", [0.0, 0.5, 0.8, 1.0])
def test_grown_rules_are_the_confident_rules(spark, seed, confidence):
    rng = random.Random(seed)
    rows = [(f"t{t}", i, 1) for t in range(30)
            for i in rng.sample(range(1, 9), rng.randint(2, 8))]
    sets = frequent_itemsets(tx_frame(spark, rows), 0.2, 6).itemsets
    rows = lambda df: sorted((tuple(r.antecedent), tuple(r.consequent), r.support, r.antecedent_support,
                              r.confidence) for r in df.collect())
    assert rows(grown_rules(sets, confidence)) == rows(association_rules(sets, confidence))


def test_grown_rules_of_a_large_set_try_few_subsets(spark, ws):
    """A set of 20 items has 1,048,574 subsets; its confident rules need 22 of them."""
    full = list(range(20))
    without = lambda *gone: [i for i in full if i not in gone]      # noqa: E731
    rows = [(full, 6)] + [(without(i), 8 if i in (3, 7) else 100) for i in full]
    rows += [(without(3, 7), 9)]
    sets = _sets(spark, rows)
    got = _rule_dict(grown_rules(sets.where("k = 20 or support > 0"), 0.6, workspace=ws))
    large = {k: v for k, v in got.items() if len(k[0]) + len(k[1]) == 20}
    assert large == {(tuple(without(3)), (3,)): 0.75, (tuple(without(7)), (7,)): 0.75,
                     (tuple(without(3, 7)), (3, 7)): pytest.approx(6 / 9)}
    written = sum(spark.read.parquet(ws.location(f"rules-{i}")).count() for i in (1, 2, 3))
    assert written == len(got) < 30


def test_grown_rules_without_sets(spark):
    assert grown_rules(_sets(spark, []), 0.6).collect() == []
    assert grown_rules(_sets(spark, [([1], 3)]), 0.6).collect() == []


def _bytes_of(folder):
    import glob

    return b"".join(open(f, "rb").read() for f in sorted(glob.glob(folder.replace("file:", "") + "/part-*")))


def test_streamed_report_is_byte_equal(spark, ws):
    rng = random.Random(12)
    sets = [([i], 900 - i % 7) for i in range(60)] + [([i, i + j], 17 + i % 3) for i in range(300) for j in (1, 5)]
    sets += [([100, 9, 2], 4), ([2, 9, 100], 4), ([10], 4)]
    rng.shuffle(sets)
    table = _sets(spark, sets).repartition(5)
    plain, streamed = ws.location("plain"), ws.location("streamed")
    write_lines(itemset_report_lines(table), plain)
    write_itemset_report(table, streamed)
    assert _bytes_of(streamed) == _bytes_of(plain) != b""
    import os
    assert sorted(n for n in os.listdir(streamed.replace("file:", "")) if not n.startswith("part-")) == ["_SUCCESS"]
    assert _report_key(read_itemset_report(spark, streamed, item_type=T.IntegerType())) == _report_key(table)
    with pytest.raises(FileExistsError):
        write_itemset_report(table, streamed)
    empty = ws.location("empty")
    write_itemset_report(_sets(spark, []), empty)
    assert _bytes_of(empty) == b""


def test_streamed_line_is_never_whole(tmp_path):
    """A line of 40 MB goes through in pieces of one Arrow batch."""
    import tracemalloc
    from types import SimpleNamespace
    from unittest import mock

    import pyarrow as pa

    from basketry.sources import streamed

    def batches():
        for i in range(400):
            yield pa.RecordBatch.from_arrays([pa.array([7] * 1000), pa.array([f"{i};{j:095d}" for j in range(1000)])],
                                             ["support", "text"])

    task = SimpleNamespace(partitionId=lambda: 3, taskAttemptId=lambda: 9)
    with mock.patch.object(streamed.TaskContext, "get", lambda: task):
        writer = streamed.ReportWriter(str(tmp_path / "report"))
        tracemalloc.start()
        part = writer.write(batches())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        writer.commit([part, None])
    size = (tmp_path / "report" / "part-00003.txt").stat().st_size
    assert size > 38_000_000 and peak < 5_000_000
    text = (tmp_path / "report" / "part-00003.txt").read_text()
    assert text.count("\n") == 1 and text.count("\t") == 400_000


def test_a_failed_attempt_leaves_nothing(tmp_path):
    from types import SimpleNamespace
    from unittest import mock

    import pyarrow as pa

    from basketry.sources import streamed

    def fails():
        yield pa.RecordBatch.from_arrays([pa.array([7]), pa.array(["1"])], ["support", "text"])
        raise OSError("lost")

    task = SimpleNamespace(partitionId=lambda: 0, taskAttemptId=lambda: 1)
    with mock.patch.object(streamed.TaskContext, "get", lambda: task):
        writer = streamed.ReportWriter(str(tmp_path / "report"))
        with pytest.raises(OSError):
            writer.write(fails())
        writer.abort([None])
    assert not list((tmp_path / "report").iterdir())
