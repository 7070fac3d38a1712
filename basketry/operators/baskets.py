"""Transactions and basket statistics (job 2, before mining).

``transactions`` returns ``(tid, item, m)`` with one row per distinct
(tid, item): ``m`` is the multiplicity the reference's bag semantics give
the pair (strong measurement rows x matching entity rows), or 1 in
distinct mode.

Qualifying entities are reduced to ``(tid, n_ent)`` and written once. Within
the broadcast bounds they are joined map-side, so measurements of other
entities are dropped during the scan and the only shuffle is the (tid, item)
aggregate. Beyond them, strong measurements first meet a bitmap of the
qualifying tids' hashes (``FILTER_BITS`` bits whatever the number of entities,
so always small enough to broadcast), which drops most rows of other entities
before any shuffle. What passes is aggregated per (tid, item), a shuffle keyed
by both columns that spreads even an entity holding a third of all rows, and
then joined on ``tid``, where each entity has at most one row per item.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.arrays import support_threshold
from basketry.functions.membership import maybe_in
from basketry.functions.predicates import (
    DEFAULT_CATEGORY_LIST,
    DEFAULT_CUTOFF,
    has_any_token,
    strong_filter,
)
from basketry.session import DEFAULT_BROADCAST_ROWS, small_side


def qualifying_entities(entities: DataFrame,
                        categories: Iterable[str] = DEFAULT_CATEGORY_LIST) -> DataFrame:
    """Entity rows with at least one listed category token."""
    return entities.where(has_any_token("categories", categories))


def transactions(measurements: DataFrame, entities: DataFrame, *,
                 cutoff: float = DEFAULT_CUTOFF, inclusive: bool = True,
                 categories: Iterable[str] = DEFAULT_CATEGORY_LIST,
                 distinct: bool = True,
                 broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``(tid, item, m)`` for strong measurements of qualifying entities."""
    strong = strong_filter(measurements.select("tid", "item", "value"),
                           "value", cutoff, inclusive)
    ents = (qualifying_entities(entities, tuple(categories))
            .groupBy("tid").agg(F.count(F.lit(1)).alias("n_ent")))
    ents, fits = small_side(ents, "entities", broadcast_rows)
    if fits:
        joined = strong.join(F.broadcast(ents), "tid", "inner")
        m = F.lit(1) if distinct else F.sum("n_ent")
        return joined.groupBy("tid", "item").agg(m.cast("bigint").alias("m"))
    pairs = maybe_in(strong, ents, "tid").groupBy("tid", "item").agg(F.count(F.lit(1)).alias("n_meas"))
    joined = pairs.join(ents, "tid", "inner")
    if distinct:
        m = F.lit(1).cast("bigint")
    else:
        m = (F.col("n_meas") * F.col("n_ent")).cast("bigint")
    return joined.select("tid", "item", m.alias("m"))


def baskets(tx: DataFrame) -> DataFrame:
    """``(tid, items)``: each transaction's distinct items, ascending.

    A per-transaction list for users; the miner itself never builds one.
    Its length is bounded by the item universe, not by the data size,
    because ``tx`` already holds one row per (tid, item).
    """
    return tx.groupBy("tid").agg(F.array_sort(F.collect_list("item")).alias("items"))


def basket_sizes(tx: DataFrame) -> DataFrame:
    """``(tid, n_items, basket_size)``: distinct items and bag length."""
    return tx.groupBy("tid").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_items"),
        F.sum("m").cast("bigint").alias("basket_size"))


def support_stats(tx: DataFrame, min_support: float, max_size: int | None = None) -> DataFrame:
    """One row: ``n_transactions, threshold, max_basket, max_weight[, k_effective]``.

    ``threshold`` is the truncated double product ``n * min_support``
    computed in Spark exactly as :func:`support_threshold` does in Python.
    ``max_basket`` counts duplicates (bag length), which bounds the
    largest set size the miner needs to try.
    """
    support_threshold(0, min_support)  # validates the parameter
    per_tid = tx.groupBy("tid").agg(F.sum("m").alias("size"), F.max("m").alias("w"))
    stats = per_tid.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_transactions"),
        F.coalesce(F.max("size"), F.lit(0)).cast("bigint").alias("max_basket"),
        F.coalesce(F.max("w"), F.lit(0)).cast("bigint").alias("max_weight"))
    stats = stats.withColumn(
        "threshold",
        F.floor(F.col("n_transactions").cast("double")
                * F.lit(float(min_support)).cast("double")).cast("bigint"))
    cols = ["n_transactions", "threshold", "max_basket", "max_weight"]
    if max_size is not None:
        stats = stats.withColumn(
            "k_effective", F.least(F.lit(int(max_size)).cast("bigint"), F.col("max_basket")))
        cols.append("k_effective")
    return stats.select(*cols)
