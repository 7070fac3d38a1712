"""Itemset report lines (job 2 output).

One line per distinct support value, lines by support descending; a line
lists every set with that support in report order (size, then items
element-wise numerically): ``support \\t 1 \\t 2;7 \\t 2;9``.

The format puts all sets sharing a support value on one line, so that
line is necessarily built in one task. It is a rendering of the (already
aggregated) frequent-set table, which stays the scalable output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.arrays import ITEM_SEPARATOR, SET_SEPARATOR


def itemset_report_lines(itemsets: DataFrame) -> DataFrame:
    """``(support, n_sets, line)`` ordered by support descending."""
    grouped = itemsets.groupBy("support").agg(
        F.array_sort(F.collect_list(F.struct("k", "items"))).alias("sets"))
    set_texts = F.transform(
        "sets",
        lambda s: F.array_join(s["items"].cast(T.ArrayType(T.StringType())), ITEM_SEPARATOR))
    line = F.concat_ws(SET_SEPARATOR, F.col("support").cast(T.StringType()),
                       F.array_join(set_texts, SET_SEPARATOR))
    return (grouped.select("support", F.size("sets").cast(T.LongType()).alias("n_sets"),
                           line.alias("line"))
            .orderBy(F.col("support").desc()))
