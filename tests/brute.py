"""Plain-Python models of the three jobs, for tests only.

``mine_idlists`` counts by definition: a set is a result if every one of its
items is frequent alone and its support, the sum over the transactions that
hold all of it of the multiplicity of its smallest item, reaches the
threshold; a set of two or more items also needs a transaction that holds it.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import combinations

import numpy as np


def mine_idlists(pairs, min_support, max_size):
    """pairs: bag of (tid, item) after the join. -> {tuple(items): support}."""
    baskets = defaultdict(Counter)
    for tid, item in pairs:
        baskets[tid][item] += 1
    n = len(baskets)
    threshold = int(float(n) * float(min_support))
    alone = Counter(item for _, item in pairs)
    items = sorted(i for i, c in alone.items() if c >= threshold)
    largest = max((sum(b.values()) for b in baskets.values()), default=0)
    out = {}
    for size in range(1, min(max_size, largest) + 1):
        for s in combinations(items, size):
            # a set counts only if those it is built from do
            if size > 1 and not (s[:-1] in out and s[:-2] + s[-1:] in out):
                continue
            held = [b[s[0]] for b in baskets.values() if all(i in b for i in s)]
            if held and sum(held) >= threshold:
                out[s] = sum(held)
    return out, n, threshold


def rules(freq, min_conf=None):
    """freq: {tuple: support} -> {(antecedent, consequent): float32 confidence}."""
    out = {}
    for s, sup in freq.items():
        k = len(s)
        if k < 2:
            continue
        for mask in range(1, 2 ** k - 1):
            r = tuple(s[i] for i in range(k) if (mask >> i) & 1)
            if r not in freq:
                continue
            conf = np.float32(sup) / np.float32(freq[r])
            if min_conf is not None and not conf >= np.float32(min_conf):
                continue
            rest = tuple(x for x in s if x not in r)
            out[(r, rest)] = float(conf)
    return out


def category_counts(measure_rows, entity_rows, cutoff, substring, names):
    """Reference job 1 on raw rows: (tid, value) and (tid, attr text)."""
    lowered = {n.lower() for n in names}
    strong = [(t, v) for t, v in measure_rows
              if np.float32(v) > np.float32(cutoff) and not np.isnan(np.float32(v))]
    counts = Counter()
    by_tid = defaultdict(list)
    for t, attr in entity_rows:
        by_tid[t].append(attr)
    for t, _ in strong:
        for attr in by_tid.get(t, []):
            for tok in attr.split(" "):
                if substring in tok or tok.lower() in lowered:
                    counts[tok] += 1
    return dict(counts)
