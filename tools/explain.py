"""Print the physical plans of the headline operators.

    python tools/explain.py [sf_dir] [--full]

Without ``--full`` only the lines that matter for scale are shown:
operators, pushed filters, read schemas and join strategies.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from basketry.operators import association_rules, category_counts  # noqa: E402
from basketry.operators.mining import _candidates, _count_level, _split, _steps  # noqa: E402
from basketry.plans import queries as Q  # noqa: E402
from basketry.plans import tables as fx  # noqa: E402
from basketry.session import Workspace, local_session  # noqa: E402

KEEP = re.compile(r"^\s*[:+\- ]*\(?\d*\)?\s*(Scan|Filter|Project|HashAggregate|Exchange|"
                  r"BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastExchange|"
                  r"Generate|Sort|WholeStageCodegen|AdaptiveSparkPlan)|PushedFilters|"
                  r"ReadSchema|Join type|Join condition|Keys")


def show(title: str, df, full: bool) -> None:
    print(f"\n==== {title} ====")
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    for line in text.splitlines():
        if full or KEEP.search(line):
            print(line)


def main(argv: list[str]) -> None:
    full = "--full" in argv
    args = [a for a in argv if a != "--full"]
    sf = args[0] if args else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    spark.sparkContext.setLogLevel("ERROR")
    show("category counts (F-A)",
         category_counts(fx.fa_measurements(spark, sf), fx.fa_entities(spark, sf),
                         cutoff=fx.FA_CUTOFF, substring=fx.FA_SUBSTRING, names=fx.FA_NAMES),
         full)
    show("category counts, shuffle path",
         category_counts(fx.fa_measurements(spark, sf), fx.fa_entities(spark, sf),
                         cutoff=fx.FA_CUTOFF, substring=fx.FA_SUBSTRING, names=fx.FA_NAMES,
                         broadcast_rows=0), full)
    show("transactions (F-B, bag)", Q._fb_tx(spark, sf, False), full)
    ws = Workspace(spark)
    tx = ws.materialize(Q._fb_tx(spark, sf, True), "tx")
    pairs = F.array_sort(F.collect_list(F.struct("item", "m")))
    classes = tx.groupBy("tid").agg(pairs.alias("p")).select(
        "tid", F.col("p")["item"].alias("tail"), F.col("p")["m"].alias("weights"))
    dealt = ws.materialize(_split(classes, 2, 1_000_000), "classes")
    show("mining level 2: candidates of the dealt classes + partial aggregate",
         _count_level(_candidates(_steps(dealt, 2), 2), 2, 1), full)
    mined = Q._mine(spark, sf, fx.FB_MAX_SIZE, True)
    show("rules", association_rules(mined.itemsets, fx.FB_MIN_CONFIDENCE), full)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
