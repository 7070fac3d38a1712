"""Frequent-itemset mining: thresholds, bag counting, order, brute force."""

from __future__ import annotations

import random

import brute
import pytest
from conftest import tx_frame
from pyspark.sql import functions as F

from basketry.functions import support_threshold
from basketry.operators import frequent_itemsets, order_itemsets, transactions
from basketry.operators import mining
from basketry.operators.mining import _keep_frequent, _split, _steps, next_bound
from basketry.session import Workspace


def _as_dict(result):
    return {tuple(r["items"]): r["support"] for r in result.itemsets.collect()}


def _tx_from_pairs(spark, pairs, distinct):
    counts = {}
    for tid, item in pairs:
        counts[(tid, item)] = counts.get((tid, item), 0) + 1
    rows = [(t, i, 1 if distinct else c) for (t, i), c in counts.items()]
    return tx_frame(spark, rows)


def test_threshold_is_truncated_double_product():
    assert support_threshold(100, 0.29) == 28
    assert support_threshold(610, 0.2) == 122
    assert support_threshold(3, 0.3) == 0
    assert support_threshold(10, 1.5) == 15
    for bad in (-0.1, float("nan")):
        with pytest.raises(ValueError):
            support_threshold(10, bad)


def test_zero_threshold_keeps_cooccurring_pairs_only(spark):
    # N=3, support 0.3 -> threshold 0; {1,3} never co-occur -> absent
    pairs = [("a", 1), ("a", 2), ("b", 2), ("b", 3), ("c", 4)]
    res = frequent_itemsets(_tx_from_pairs(spark, pairs, True), 0.3, 5)
    got = _as_dict(res)
    assert res.threshold == 0
    assert got == {(1,): 1, (2,): 2, (3,): 1, (4,): 1, (1, 2): 1, (2, 3): 1}


def test_k_clamped_and_k1(spark):
    pairs = [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    tx = _tx_from_pairs(spark, pairs, True)
    res = frequent_itemsets(tx, 0.5, 5)
    assert res.max_basket == 2 and max(len(s) for s in _as_dict(res)) == 2
    assert set(_as_dict(frequent_itemsets(tx, 0.5, 1))) == {(1,), (2,)}
    with pytest.raises(ValueError):
        frequent_itemsets(tx, 0.5, 0)


def test_bag_weights_follow_first_item(spark):
    # (p1,1) twice, (p1,2), (p2,1), (p2,2); N=2
    pairs = [("p1", 1), ("p1", 1), ("p1", 2), ("p2", 1), ("p2", 2)]
    bag = _as_dict(frequent_itemsets(_tx_from_pairs(spark, pairs, False), 1.0, 5))
    assert bag == {(1,): 3, (2,): 2, (1, 2): 3}
    dist = _as_dict(frequent_itemsets(_tx_from_pairs(spark, pairs, True), 1.0, 5))
    assert dist == {(1,): 2, (2,): 2, (1, 2): 2}


def test_numeric_item_order(spark):
    pairs = [(t, i) for t in ("a", "b") for i in (9, 10, 100)]
    res = frequent_itemsets(_tx_from_pairs(spark, pairs, True), 1.0, 2)
    order = [tuple(r["items"]) for r in order_itemsets(res.itemsets).collect()]
    assert order == [(9,), (10,), (100,), (9, 10), (9, 100), (10, 100)]


def test_empty_transactions(spark):
    res = frequent_itemsets(tx_frame(spark, []), 0.3, 5)
    assert res.n_transactions == 0 and res.itemsets.count() == 0
    assert res.itemsets.columns == ["items", "k", "support"]


def _random_pairs(seed, n_tid=18, n_items=7, dup_rate=0.3):
    rng = random.Random(seed)
    pairs = []
    for t in range(n_tid):
        for i in rng.sample(range(1, n_items + 1), rng.randint(1, n_items)):
            pairs.append((f"t{t}", i))
            while rng.random() < dup_rate:
                pairs.append((f"t{t}", i))
    rng.shuffle(pairs)
    return pairs


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("distinct", [True, False])
def test_matches_idlist_simulation(spark, seed, distinct):
    pairs = _random_pairs(seed)
    sim_pairs = sorted(set(pairs)) if distinct else pairs
    want, n, th = brute.mine_idlists(sim_pairs, 0.35, 4)
    res = frequent_itemsets(_tx_from_pairs(spark, pairs, distinct), 0.35, 4)
    assert (res.n_transactions, res.threshold) == (n, th)
    assert _as_dict(res) == want


@pytest.mark.parametrize("distinct", [True, False])
def test_pruning_and_partitioning_do_not_change_result(spark, distinct):
    pairs = _random_pairs(7, n_tid=25, n_items=8)
    tx = _tx_from_pairs(spark, pairs, distinct)
    base = _as_dict(frequent_itemsets(tx, 0.3, 5))
    assert _as_dict(frequent_itemsets(tx, 0.3, 5, prune=True)) == base
    assert _as_dict(frequent_itemsets(tx, 0.3, 5, prune=None)) == base
    assert _as_dict(frequent_itemsets(tx.repartition(5), 0.3, 5, rows_per_task=1)) == base


def test_distinct_support_is_anti_monotone(spark):
    pairs = _random_pairs(11, n_tid=30, n_items=8, dup_rate=0.0)
    got = _as_dict(frequent_itemsets(_tx_from_pairs(spark, pairs, True), 0.2, 5))
    for s, sup in got.items():
        for j in range(len(s)):
            sub = s[:j] + s[j + 1:]
            if sub:
                assert got[sub] >= sup


def test_transactions_multiplicity(spark):
    m = spark.createDataFrame(
        [("p1", 1, 2e6), ("p1", 1, 3e6), ("p1", 2, 2e6), ("p2", 1, 1.0), ("p3", 1, 2e6)],
        "tid string, item int, value double")
    e = spark.createDataFrame(
        [("p1", ["leukemia"]), ("p1", ["lymphoma"]), ("p2", ["leukemia"]), ("p3", ["flu"])],
        "tid string, categories array<string>")
    bag = sorted(tuple(r) for r in transactions(m, e, distinct=False).collect())
    assert bag == [("p1", 1, 4), ("p1", 2, 2)]
    dist = sorted(tuple(r) for r in transactions(m, e, distinct=True).collect())
    assert dist == [("p1", 1, 1), ("p1", 2, 1)]


@pytest.mark.parametrize("distinct", [True, False])
def test_transactions_shuffle_path_equals_broadcast_path(spark, distinct):
    from conftest import SF0001

    from basketry.plans import tables as fx
    m, e = fx.fb_measurements(spark, SF0001), fx.fb_entities(spark, SF0001)
    kw = dict(cutoff=fx.FB_CUTOFF, categories=fx.FB_CATEGORIES, distinct=distinct)
    a = sorted(tuple(r) for r in transactions(m, e, **kw).collect())
    b = sorted(tuple(r) for r in transactions(m, e, broadcast_rows=0, **kw).collect())
    assert a == b and len(a) > 0


@pytest.mark.parametrize("distinct", [True, False])
def test_splitting_hot_transactions_keeps_result(spark, distinct):
    # one transaction holds most rows; split whatever yields more than 3 candidates
    pairs = _random_pairs(13, n_tid=12, n_items=9)
    pairs += [("hot", i) for i in range(1, 10) for _ in range(2)]
    tx = _tx_from_pairs(spark, pairs, distinct)
    base = _as_dict(frequent_itemsets(tx, 0.3, 5))
    assert _as_dict(frequent_itemsets(tx, 0.3, 5, rows_per_task=3)) == base


def test_work_of_a_huge_transaction_is_split_by_its_output(spark):
    # one transaction of 120 items, alone: all its candidates come from one tid
    tx = tx_frame(spark, [("hot", i, 1) for i in range(120)])
    target = 500
    classes = (tx.groupBy("tid").agg(F.array_sort(F.collect_list("item")).alias("tail"),
                                     F.collect_list("m").alias("weights")))
    for k in (2, 3, 4):
        dealt = _split(classes, k, target)
        sized = (dealt.withColumn("task", F.spark_partition_id())
                 .withColumn("at", F.explode(F.sequence(F.col("part"), F.size("tail") - 2, F.col("parts"))))
                 .groupBy("task", *[f"i{j}" for j in range(1, k - 1)], "part")
                 .agg(F.sum(F.size("tail") - F.col("at") - 1).alias("n")).collect())
        by_task = {}
        for r in sized:
            by_task[r.task] = by_task.get(r.task, 0) + r.n
        assert sum(by_task.values()) == [0, 0, 7140, 280840, 8214570][k]
        assert max(r.n for r in sized) <= 1.2 * target
        assert len(by_task) >= 6 and max(by_task.values()) <= 3 * sum(by_task.values()) / 8
        classes = _steps(dealt, k)


def test_workspace_drop(spark):
    import os

    res = frequent_itemsets(_tx_from_pairs(spark, [("a", 1), ("b", 1)], True), 0.5, 2)
    assert res.itemsets.count() == 1
    local = res.workspace.path.replace("file:", "")
    assert os.path.isdir(local)
    res.workspace.drop()
    assert not os.path.exists(local)


def test_duplicate_and_null_keyed_input_rows(spark):
    rows = [("a", 1, 1), ("a", 1, 1), ("a", 2, 1), ("b", 1, 1), ("b", 2, 1),
            (None, 1, 1), ("c", None, 1)]
    res = frequent_itemsets(tx_frame(spark, rows), 0.5, 3)
    # duplicate (a, 1) rows add up like a bag weight of 2; null keys are ignored
    assert res.n_transactions == 2
    assert _as_dict(res) == {(1,): 3, (2,): 2, (1, 2): 3}


def test_release_frees_levels_and_folder(spark):
    import os

    res = frequent_itemsets(_tx_from_pairs(spark, [("a", 1), ("a", 2), ("b", 1)], True), 0.5, 2)
    assert res.itemsets.count() == 3 and res.cached  # {1}, {2}, {1,2} at threshold 1
    local = res.workspace.path.replace("file:", "")
    res.release()
    assert not res.cached and not os.path.exists(local)


@pytest.mark.parametrize("distinct", [True, False])
def test_lost_cached_levels_recompute_from_written_tables(spark, distinct):
    # dropping every cached block stands in for lost executors: the levels
    # must come back from the written occurrences and transactions
    pairs = _random_pairs(21, n_tid=20, n_items=7)
    res = frequent_itemsets(_tx_from_pairs(spark, pairs, distinct), 0.3, 5)
    before = _as_dict(res)
    for df in res.cached:
        df.unpersist(blocking=True)
    assert _as_dict(res) == before


@pytest.mark.parametrize("distinct", [True, False])
def test_combined_passes_count_what_single_levels_do(spark, distinct):
    tx = _tx_from_pairs(spark, _random_pairs(31, n_tid=25, n_items=8), distinct)
    single = frequent_itemsets(tx, 0.25, 6, combine=False)
    combined = frequent_itemsets(tx, 0.25, 6)
    assert _as_dict(single) == _as_dict(combined)
    assert single.level_counts == combined.level_counts
    assert combined.level_counts[2] > 0


def test_combining_stops_at_its_bounds():
    work = {f"{c}{j}": 10.0 ** j for c in ("sum", "max") for j in range(2, 6)}
    assert mining._last_level(2, 5, 25, work, tasks=1) == 5
    assert mining._last_level(2, 3, 25, work, tasks=1) == 3
    assert mining._last_level(2, 9, 25, work, tasks=1) == 5          # levels a pass counts at most
    assert mining._last_level(2, 5, 3000, work, tasks=1) == 2        # too many candidates
    assert mining._last_level(2, 5, 25, {**work, "sum4": 1e9}, tasks=1) == 3
    assert mining._last_level(2, 5, 25, {**work, "max3": 1e9}, tasks=100) == 2


def test_next_bound_holds_and_is_tight():
    import itertools
    import math

    for m in range(2, 9):
        for k in range(1, m + 1):
            assert next_bound(math.comb(m, k), k) == math.comb(m, k + 1)
    rng = random.Random(4)
    for _ in range(200):
        k = rng.randint(1, 3)
        universe = list(itertools.combinations(range(7), k))
        family = set(rng.sample(universe, rng.randint(0, len(universe))))
        above = [c for c in itertools.combinations(range(7), k + 1)
                 if all(c[:i] + c[i + 1:] in family for i in range(k + 1))]
        assert len(above) <= next_bound(len(family), k)


@pytest.mark.parametrize("small", [True, False])
def test_tails_are_cut_before_they_move(spark, small):
    # 60 transactions of 100 items; 50 pairs are frequent
    tx = tx_frame(spark, [(f"t{t}", i, 1) for t in range(60) for i in range(100)])
    classes = (tx.groupBy("tid").agg(F.array_sort(F.collect_list("item")).alias("tail"),
                                     F.collect_list("m").alias("weights")))
    steps = _steps(_split(classes, 2, 10_000), 2)
    level = spark.range(50).select(F.col("id").cast("int").alias("i1"), (F.col("id") + 50).cast("int").alias("i2"),
                                   F.lit(60).cast("bigint").alias("support"))
    kept = _keep_frequent(steps, level, 2, small)
    uncut = steps.agg(F.sum(F.size("tail"))).first()[0]
    moved = kept.agg(F.sum(F.size("tail"))).first()[0]
    assert uncut == 60 * 4950
    assert moved == 60 * 50 if small else 60 * 50 <= moved < 1.05 * 60 * 50
    wanted = {(f"t{t}", i, i + 50) for t in range(60) for i in range(50)}
    found = {(r.tid, r.i1, x) for r in kept.collect() for x in r.tail}
    assert wanted <= found
    # the join is made where the steps are: their only exchange is that of the dealing
    plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("REPARTITION_BY_NUM") == 1


@pytest.mark.parametrize("distinct", [True, False])
def test_bitmap_cut_gives_the_same_sets(spark, distinct, monkeypatch):
    tx = _tx_from_pairs(spark, _random_pairs(41, n_tid=25, n_items=8), distinct)
    base = _as_dict(frequent_itemsets(tx, 0.25, 6))
    monkeypatch.setattr(mining, "DEFAULT_BROADCAST_ROWS", 0)
    monkeypatch.setattr(mining, "BLOCKS_LOG2", 1)
    monkeypatch.setattr(mining, "BLOCK_BITS", 64)        # so small that it keeps infrequent items
    assert _as_dict(frequent_itemsets(tx, 0.25, 6, combine=False)) == base
    assert _as_dict(frequent_itemsets(tx, 0.25, 6, combine=False, rows_per_task=3)) == base


def test_mining_takes_few_jobs(spark):
    from conftest import SF001

    from basketry.plans import queries as Q
    sc = spark.sparkContext
    sc.setJobGroup("mining-jobs", "count the jobs of a mining run")
    try:
        mined = Q._mine(spark, SF001, 5, True)
        assert mined.level_counts == [25, 300, 648, 0]
        jobs = len(sc.statusTracker().getJobIdsForGroup("mining-jobs"))
    finally:
        sc.setJobGroup("other", "")
    assert 0 < jobs < 25


class _Killed(Exception):
    pass


@pytest.mark.parametrize("killed_at", [1, 2, 3, 4])
@pytest.mark.parametrize("distinct", [True, False])
def test_a_killed_run_goes_on_where_it_was(spark, distinct, killed_at, monkeypatch):
    pairs = _random_pairs(51, n_tid=25, n_items=8)
    tx = _tx_from_pairs(spark, pairs, distinct)
    base = frequent_itemsets(tx, 0.25, 5)
    ws = Workspace(spark)
    count = mining._Run.count

    def dies(self, found, first, last):
        if first == killed_at:
            # half of the table is there, the note is not
            found.limit(1).write.mode("overwrite").parquet(self.ws.location(f"sets-{first}-{last}"))
            raise _Killed
        count(self, found, first, last)

    with monkeypatch.context() as m:
        m.setattr(mining._Run, "count", dies)
        with pytest.raises(_Killed):
            frequent_itemsets(tx, 0.25, 5, combine=False, workspace=ws)
    again = Workspace(spark, path=ws.path)
    with pytest.raises(ValueError, match="asked for"):
        frequent_itemsets(None, 0.5, 5, combine=False, workspace=again, resume=True)
    res = frequent_itemsets(None, 0.25, 5, combine=False, workspace=again, resume=True)   # no transactions
    assert _as_dict(res) == _as_dict(base)
    assert (res.n_transactions, res.threshold, res.weighted) == (base.n_transactions, base.threshold, base.weighted)


def test_resuming_a_finished_run_reads_its_tables(spark):
    tx = _tx_from_pairs(spark, _random_pairs(52), True)
    res = frequent_itemsets(tx, 0.3, 4)
    again = frequent_itemsets(None, 0.3, 4, workspace=Workspace(spark, path=res.workspace.path), resume=True)
    assert _as_dict(again) == _as_dict(res)
    with pytest.raises(ValueError, match="workspace"):
        frequent_itemsets(tx, 0.3, 4, resume=True)


def test_resume_without_anything_written_starts_anew(spark):
    tx = _tx_from_pairs(spark, _random_pairs(53), True)
    ws = Workspace(spark)
    assert _as_dict(frequent_itemsets(tx, 0.3, 4, workspace=ws, resume=True)) == _as_dict(
        frequent_itemsets(tx, 0.3, 4))


@pytest.mark.parametrize("seed", [61, 62])
@pytest.mark.parametrize("combine", [True, False])
def test_vertical_layout_gives_the_same_sets(spark, seed, combine, monkeypatch):
    pairs = _random_pairs(seed, n_tid=300, n_items=9, dup_rate=0.0)
    tx = _tx_from_pairs(spark, pairs, True)
    base = frequent_itemsets(tx, 0.2, 6, layout="horizontal")
    monkeypatch.setattr(mining.vertical, "RANGE", 64)       # several ranges a task
    got = frequent_itemsets(tx, 0.2, 6, layout="vertical", combine=combine, rows_per_task=5)
    assert _as_dict(got) == _as_dict(base) and got.level_counts == base.level_counts
    assert len(base.level_counts) > 3
    monkeypatch.setattr(mining, "DEFAULT_BROADCAST_ROWS", 0)    # tails are not cut then
    assert _as_dict(frequent_itemsets(tx, 0.2, 6, layout="vertical", combine=False)) == _as_dict(base)


def test_vertical_layout_of_text_items(spark):
    rows = [(f"t{t}", f"item {i}", 1) for t in range(40) for i in range(12) if (t * 7 + i * 3) % 5]
    tx = spark.createDataFrame(rows, "tid string, item string, m bigint")
    assert _as_dict(frequent_itemsets(tx, 0.3, 4, layout="vertical")) == _as_dict(
        frequent_itemsets(tx, 0.3, 4, layout="horizontal"))


def test_layout_follows_the_density(spark, monkeypatch):
    used = []
    first = mining.vertical.first_classes
    monkeypatch.setattr(mining.vertical, "first_classes", lambda *a: used.append(1) or first(*a))
    dense = tx_frame(spark, [(f"t{t}", i, 1) for t in range(50) for i in range(6) if (t + i) % 3])
    frequent_itemsets(dense, 0.1, 3)
    assert used
    used.clear()
    sparse = tx_frame(spark, [(f"t{t}", 2 * t + i, 1) for t in range(100) for i in range(3)])
    res = frequent_itemsets(sparse, 0.01, 3)
    assert not used and res.level_counts[0] > 100
    bag = tx_frame(spark, [(f"t{t}", i, 2) for t in range(50) for i in range(6)])
    frequent_itemsets(bag, 0.1, 3)
    assert not used
    with pytest.raises(ValueError, match="bag"):
        frequent_itemsets(bag, 0.1, 3, layout="vertical")
    with pytest.raises(ValueError, match="layout"):
        frequent_itemsets(bag, 0.1, 3, layout="diagonal")


def test_vertical_run_is_resumed(spark, monkeypatch):
    tx = _tx_from_pairs(spark, _random_pairs(63, n_tid=100, n_items=8, dup_rate=0.0), True)
    base = _as_dict(frequent_itemsets(tx, 0.2, 5))
    ws = Workspace(spark)
    count = mining._Run.count

    def dies(self, found, first, last):
        if first == 3:
            raise _Killed
        count(self, found, first, last)

    with monkeypatch.context() as m:
        m.setattr(mining._Run, "count", dies)
        with pytest.raises(_Killed):
            frequent_itemsets(tx, 0.2, 5, combine=False, workspace=ws)
    again = Workspace(spark, path=ws.path)
    assert _as_dict(frequent_itemsets(None, 0.2, 5, combine=False, workspace=again, resume=True)) == base
