"""Relational operators of the three jobs, as DataFrame transformations."""

from basketry.operators.baskets import (
    basket_sizes,
    baskets,
    qualifying_entities,
    support_stats,
    transactions,
)
from basketry.operators.categories import (
    category_counts,
    category_report_lines,
    category_tokens,
    order_category_counts,
    strong_entity_pairs,
    strong_measurements,
)
from basketry.operators.mining import FrequentItemsets, frequent_itemsets, order_itemsets
from basketry.operators.reports import itemset_report_lines
from basketry.operators.rules import (
    association_rules,
    grown_rules,
    order_rules,
    proper_subsets,
    rule_report_lines,
)

__all__ = [
    "FrequentItemsets", "association_rules", "basket_sizes", "baskets", "category_counts",
    "category_report_lines", "category_tokens", "frequent_itemsets",
    "grown_rules",
    "itemset_report_lines", "order_category_counts", "order_itemsets", "order_rules",
    "proper_subsets", "qualifying_entities", "rule_report_lines",
    "strong_entity_pairs", "strong_measurements", "support_stats", "transactions",
]
