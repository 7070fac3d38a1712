"""Whole plans: the three end-to-end jobs, the registered queries over the
test tables, and their DuckDB oracles."""

from basketry.plans.jobs import category_count_job, itemset_job, rule_job

__all__ = ["category_count_job", "itemset_job", "rule_job"]
