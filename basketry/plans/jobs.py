"""The three end-to-end jobs: text inputs in, text reports out.

Each job takes explicit paths and keyword parameters (defaults are the
reference's), validates them, and writes its report in the reference's
line format. Reports are written as globally sorted part files in
parallel; read in name order they hold the report's total order.
``single_file=True`` funnels the sorted rows into one part file, as the
reference does, at the price of one writing task. Only scalars reach the
driver.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from basketry.functions.predicates import (
    DEFAULT_CATEGORY_LIST,
    DEFAULT_CATEGORY_NAMES,
    DEFAULT_CATEGORY_SUBSTRING,
    DEFAULT_CUTOFF,
)
from basketry.operators.baskets import transactions
from basketry.operators.categories import category_counts, category_report_lines
from basketry.operators.mining import (
    DEFAULT_MAX_SIZE,
    DEFAULT_MIN_SUPPORT,
    FrequentItemsets,
    frequent_itemsets,
)
from basketry.operators.reports import itemset_report_lines
from basketry.operators.rules import (
    DEFAULT_MIN_CONFIDENCE,
    association_rules,
    rule_report_lines,
)
from basketry.sources.reports import (
    read_itemset_report,
    read_itemset_table,
    write_itemset_table,
    write_lines,
)
from basketry.sources.streamed import write_itemset_report
from basketry.sources.text import read_entities_text, read_measurements_text


def category_count_job(spark: SparkSession, measurements_path: str, entities_path: str,
                       output_path: str, *, cutoff: float = DEFAULT_CUTOFF,
                       substring: str = DEFAULT_CATEGORY_SUBSTRING,
                       names: Iterable[str] = DEFAULT_CATEGORY_NAMES,
                       single_file: bool = False) -> DataFrame:
    """Job 1: strong measurements (``> cutoff``) per category token."""
    m = read_measurements_text(spark, measurements_path)
    e = read_entities_text(spark, entities_path)
    counts = category_counts(m, e, cutoff=cutoff, inclusive=False,
                             substring=substring, names=tuple(names))
    write_lines(category_report_lines(counts), output_path, single_file=single_file)
    return counts


@dataclass
class ItemsetJobResult:
    """What job 2 found. ``mining.release()`` deletes its intermediate tables,
    after which ``mining.itemsets`` cannot be read; the written outputs stay."""

    mining: FrequentItemsets
    report_path: str
    table_path: str | None = None


def itemset_job(spark: SparkSession, measurements_path: str, entities_path: str,
                output_path: str, *, min_support: float = DEFAULT_MIN_SUPPORT,
                max_size: int = DEFAULT_MAX_SIZE, cutoff: float = DEFAULT_CUTOFF,
                categories: Iterable[str] = DEFAULT_CATEGORY_LIST,
                distinct: bool = False, single_file: bool = False,
                item_type: T.DataType = T.IntegerType(),
                table_path: str | None = None, streamed: bool = False) -> ItemsetJobResult:
    """Job 2: frequent sets of strong items (``>= cutoff``) of qualifying entities.

    ``distinct=False`` counts duplicates like the reference; ``True`` treats
    every basket as a set. Items are integers unless ``item_type`` says
    otherwise. ``table_path`` also writes the sets as a table, one row each,
    for :func:`rule_job`: a report line holds all sets of one support, which at
    scale is more than one task should build. ``streamed`` writes the report set
    by set, so that no task holds a line (see :mod:`basketry.sources.streamed`).
    """
    if streamed and single_file:
        raise ValueError("a streamed report is written in parts")
    m = read_measurements_text(spark, measurements_path, item_type=item_type)
    e = read_entities_text(spark, entities_path)
    tx = transactions(m, e, cutoff=cutoff, inclusive=True,
                      categories=tuple(categories), distinct=distinct)
    mined = frequent_itemsets(tx, min_support, max_size)
    if table_path:
        write_itemset_table(mined.itemsets, table_path)
    if streamed:
        write_itemset_report(mined.itemsets, output_path)
    else:
        write_lines(itemset_report_lines(mined.itemsets), output_path, single_file=single_file)
    return ItemsetJobResult(mined, output_path, table_path)


def rule_job(spark: SparkSession, report_path: str, output_path: str, *,
             min_confidence: float = DEFAULT_MIN_CONFIDENCE,
             single_file: bool = False, item_type: T.DataType = T.StringType(),
             from_table: bool = False) -> DataFrame:
    """Job 3: rules with confidence >= ``min_confidence`` from a job-2 report.

    Item ids stay text unless ``item_type`` says otherwise. With
    ``from_table`` the path is a table written by job 2 instead.
    """
    itemsets = (read_itemset_table(spark, report_path) if from_table
                else read_itemset_report(spark, report_path, item_type=item_type))
    rules = association_rules(itemsets, min_confidence)
    write_lines(rule_report_lines(rules), output_path, single_file=single_file)
    return rules
