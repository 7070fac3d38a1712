"""Property tests (hypothesis) of mining against the id-list model."""

from __future__ import annotations

import brute
import pytest
from conftest import tx_frame
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketry.operators import association_rules, frequent_itemsets

pairs_strategy = st.lists(
    st.tuples(st.sampled_from([f"t{i}" for i in range(10)]), st.integers(1, 6)),
    min_size=1, max_size=40)


def _tx(spark, pairs, distinct):
    counts = {}
    for tid, item in pairs:
        counts[(tid, item)] = counts.get((tid, item), 0) + 1
    return tx_frame(spark, [(t, i, 1 if distinct else c) for (t, i), c in counts.items()])


@pytest.mark.parametrize("distinct", [True, False])
@settings(max_examples=6, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=pairs_strategy, support=st.sampled_from([0.0, 0.2, 0.35, 0.6]),
       max_size=st.integers(1, 4))
def test_mining_and_rules_match_model(spark, distinct, pairs, support, max_size):
    model_pairs = sorted(set(pairs)) if distinct else pairs
    want, n, th = brute.mine_idlists(model_pairs, support, max_size)
    res = frequent_itemsets(_tx(spark, pairs, distinct), support, max_size)
    got = {tuple(r["items"]): r["support"] for r in res.itemsets.collect()}
    assert (res.n_transactions, res.threshold) == (n, th)
    assert got == want
    rules = {(tuple(r.antecedent), tuple(r.consequent)): r.confidence
             for r in association_rules(res.itemsets, 0.5).collect()}
    assert rules == brute.rules(want, 0.5)
