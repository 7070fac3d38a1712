"""Benchmark the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full with a ``noop`` write (no collect to the
driver); mining queries also run their per-level jobs while being built.
One untimed warm-up pass over the same queries at sf0.01 runs first, so
the timings are steady state (JIT-compiled), not JVM start-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.plans import queries as Q  # noqa: E402
from basketry.session import local_session  # noqa: E402

HEADLINE = [
    "category_counts",
    "transactions_bag",
    "frequent_itemsets",
    "frequent_itemsets_bag",
    "rules_confident",
    "rules_bag",
    "itemset_report_lines",
    "rule_report_lines",
]


def _run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = Q.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) * 2 if cpus.isdigit() else 16, "basketry-bench")
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(warm):
        for name in HEADLINE:
            _run(spark, name, warm)
    times = {name: round(_run(spark, name, sf_dir), 3) for name in HEADLINE}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
