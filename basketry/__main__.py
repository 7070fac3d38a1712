"""Command line for the three jobs (``spark-submit`` or ``python -m basketry``).

    python -m basketry category-count MEASUREMENTS ENTITIES OUT [--cutoff ...]
    python -m basketry itemsets MEASUREMENTS ENTITIES OUT [--min-support 0.3 --max-size 5]
    python -m basketry rules REPORT OUT [--min-confidence 0.6]

Paths may be any URI Spark can read. A missing or malformed argument stops
with a usage error; nothing falls back to defaults silently.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from basketry.functions.predicates import (
    DEFAULT_CATEGORY_LIST,
    DEFAULT_CATEGORY_NAMES,
    DEFAULT_CATEGORY_SUBSTRING,
    DEFAULT_CUTOFF,
)
from basketry.operators.mining import DEFAULT_MAX_SIZE, DEFAULT_MIN_SUPPORT
from basketry.operators.rules import DEFAULT_MIN_CONFIDENCE
from basketry.plans.jobs import category_count_job, itemset_job, rule_job
from basketry.session import Workspace, drop_since


_ITEM_TYPES = {"int": T.IntegerType(), "string": T.StringType()}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="basketry")
    sub = p.add_subparsers(dest="job", required=True)

    c = sub.add_parser("category-count", help="strong measurements per category token")
    c.add_argument("measurements")
    c.add_argument("entities")
    c.add_argument("output")
    c.add_argument("--cutoff", type=float, default=DEFAULT_CUTOFF)
    c.add_argument("--substring", default=DEFAULT_CATEGORY_SUBSTRING)
    c.add_argument("--names", nargs="*", default=list(DEFAULT_CATEGORY_NAMES))

    i = sub.add_parser("itemsets", help="frequent itemsets report")
    i.add_argument("measurements")
    i.add_argument("entities")
    i.add_argument("output")
    i.add_argument("--min-support", type=float, default=DEFAULT_MIN_SUPPORT)
    i.add_argument("--max-size", type=int, default=DEFAULT_MAX_SIZE)
    i.add_argument("--cutoff", type=float, default=DEFAULT_CUTOFF)
    i.add_argument("--categories", nargs="*", default=list(DEFAULT_CATEGORY_LIST))
    i.add_argument("--distinct", action="store_true",
                   help="count each (entity, item) once instead of the bag counting")

    i.add_argument("--item-type", choices=["int", "string"], default="int",
                   help="how item ids are read and ordered")
    i.add_argument("--table", help="also write the sets as a table, for rules --from-table")

    r = sub.add_parser("rules", help="association rules from an itemsets report")
    r.add_argument("report")
    r.add_argument("output")
    r.add_argument("--min-confidence", type=float, default=DEFAULT_MIN_CONFIDENCE)

    r.add_argument("--item-type", choices=["int", "string"], default="string",
                   help="how item ids are read from a report")
    r.add_argument("--from-table", action="store_true",
                   help="REPORT is a table written by itemsets --table")

    for s in (c, i, r):
        s.add_argument("--single-file", action="store_true",
                       help="write the report as one part file")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    session = spark or SparkSession.builder.appName(f"basketry-{args.job}").getOrCreate()
    before = len(Workspace.made)
    if args.job == "category-count":
        category_count_job(session, args.measurements, args.entities, args.output,
                           cutoff=args.cutoff, substring=args.substring,
                           names=tuple(args.names), single_file=args.single_file)
    elif args.job == "itemsets":
        res = itemset_job(session, args.measurements, args.entities, args.output,
                          min_support=args.min_support, max_size=args.max_size,
                          cutoff=args.cutoff, categories=tuple(args.categories),
                          distinct=args.distinct, single_file=args.single_file,
                          item_type=_ITEM_TYPES[args.item_type], table_path=args.table)
        m = res.mining
        print(f"transactions={m.n_transactions} threshold={m.threshold} "
              f"levels={m.level_counts}")
    else:
        rule_job(session, args.report, args.output, min_confidence=args.min_confidence,
                 single_file=args.single_file, item_type=_ITEM_TYPES[args.item_type],
                 from_table=args.from_table)
    drop_since(session, before)   # outputs are written; intermediate tables go
    return 0


if __name__ == "__main__":
    sys.exit(main())
