"""basketry: itemset, association-rule and category-count analytics on Spark.

Inputs are two tables: measurements ``(tid, item, value)`` and entities
``(tid, categories ARRAY<STRING>)``. Everything is DataFrame operations
(joins, aggregations, higher-order array functions): no Python UDF, and
only scalars reach the driver.
"""

from basketry.operators import (
    FrequentItemsets,
    association_rules,
    basket_sizes,
    category_counts,
    frequent_itemsets,
    itemset_report_lines,
    rule_report_lines,
    support_stats,
    transactions,
)
from basketry.session import Workspace, checkpoint_root, local_session

__all__ = [
    "FrequentItemsets", "Workspace", "association_rules", "basket_sizes",
    "category_counts", "checkpoint_root", "frequent_itemsets", "itemset_report_lines",
    "local_session", "rule_report_lines", "support_stats", "transactions",
]
