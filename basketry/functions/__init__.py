"""Column-level building blocks (predicates, itemset arrays, float maths)."""

from basketry.functions.arrays import (
    ITEM_SEPARATOR,
    RULE_ITEM_SEPARATOR,
    SET_SEPARATOR,
    float_at_least,
    float_ratio,
    items_text,
    parse_items,
    subset_by_mask,
    support_threshold,
)
from basketry.functions.predicates import (
    DEFAULT_CATEGORY_LIST,
    DEFAULT_CATEGORY_NAMES,
    DEFAULT_CATEGORY_SUBSTRING,
    DEFAULT_CUTOFF,
    category_token,
    has_any_token,
    scan_bound,
    strong,
    strong_filter,
)

__all__ = [
    "DEFAULT_CATEGORY_LIST", "DEFAULT_CATEGORY_NAMES", "DEFAULT_CATEGORY_SUBSTRING",
    "DEFAULT_CUTOFF", "ITEM_SEPARATOR", "RULE_ITEM_SEPARATOR", "SET_SEPARATOR",
    "category_token", "float_at_least", "float_ratio",
    "has_any_token", "items_text", "parse_items",
    "scan_bound", "strong", "strong_filter", "subset_by_mask", "support_threshold",
]
