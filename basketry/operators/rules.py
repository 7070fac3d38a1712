"""Association rules (job 3) from a frequent-itemset table.

For every frequent set S with two or more items and every non-empty proper
subset R of S that is itself in the table, emit R -> S\\R with
confidence = float(support(S)) / float(support(R)) as a 32-bit float. The
subsets come from bitmasks 1 .. 2^k-2 per set, exploded ``CHUNK_BITS`` bits at a
time so that no array grows with 2^k. The lookup is one equi-join on the sorted
subset, since sets are equal in any order: a report may list the items of its
sets as it likes, and rules print them in the order of S. Spark picks the
join's strategy from the table's measured size. A subset missing from the
table yields no rule (possible only with bag counting).

:func:`grown_rules` gives the same rules of distinct supports without making all
subsets: there confidence cannot rise as the consequent grows (its antecedent
loses items, so its support cannot fall), so consequents of h + 1 items are only
joined from confident ones of h items of the same set (Agrawal & Srikant 1994).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.arrays import (
    RULE_ITEM_SEPARATOR,
    float_at_least,
    float_ratio,
    items_text,
    subset_by_mask,
)
from basketry.session import Workspace

DEFAULT_MIN_CONFIDENCE = 0.6   # fixed: reference default minimum confidence
MAX_ENUMERABLE_SIZE = 62       # bitmasks are 64-bit longs
CHUNK_BITS = 15


def _with_bits(sets: DataFrame, low: int) -> DataFrame:
    """Each row once per value of the ``CHUNK_BITS`` mask bits from ``low`` on."""
    bits = F.least(F.greatest(F.col("k") - low, F.lit(0)), F.lit(CHUNK_BITS))
    one = F.lit(1).cast("bigint")
    values = F.sequence(F.lit(0).cast("bigint"), F.call_function("shiftleft", one, bits) - 1)
    return (sets.withColumn("chunk", F.explode(values))
            .withColumn("mask", F.col("mask").bitwiseOR(F.shiftleft("chunk", low))).drop("chunk"))


def proper_subsets(itemsets: DataFrame) -> DataFrame:
    """``(items, support, mask, subset)``: every non-empty proper subset.

    Bit i of ``mask`` selects item i. Sets beyond ``CHUNK_BITS`` items are dealt
    out again after each run of bits, so no task holds all masks of one.
    """
    sets = itemsets.where(F.col("k") >= 2)
    too_big = F.col("k") > F.lit(MAX_ENUMERABLE_SIZE)
    k = F.when(too_big, F.raise_error(F.lit("itemset too large to enumerate subsets"))).otherwise(F.col("k"))
    sets = sets.select("items", "support", k.cast("int").alias("k"), F.lit(0).cast("bigint").alias("mask"))
    small = _with_bits(sets.where(F.col("k") <= CHUNK_BITS), 0)
    large = sets.where(F.col("k") > CHUNK_BITS)
    width = int(itemsets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for low in reversed(range(0, MAX_ENUMERABLE_SIZE, CHUNK_BITS)):
        large = _with_bits(large, low)
        if low:
            large = large.repartition(width, "items", "mask")
    full = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("k")) - 1
    return (small.unionByName(large).where((F.col("mask") > 0) & (F.col("mask") < full))
            .select("items", "support", "mask", subset_by_mask("items", "mask").alias("subset")))


def association_rules(itemsets: DataFrame,
                      min_confidence: float | None = DEFAULT_MIN_CONFIDENCE) -> DataFrame:
    """``(antecedent, consequent, support, antecedent_support, confidence)``.

    ``min_confidence=None`` keeps every rule; otherwise ``confidence >=
    float(min_confidence)`` with both sides 32-bit floats.
    """
    subsets = proper_subsets(itemsets).select(
        F.col("items").alias("full"), "support", F.col("subset").alias("antecedent"),
        F.array_sort("subset").alias("key"))
    lookup = itemsets.select(F.array_sort("items").alias("key"),
                             F.col("support").alias("antecedent_support"))
    rules = subsets.join(lookup, "key", "inner").select(
        "antecedent",
        F.array_except("full", "antecedent").alias("consequent"),
        "support",
        "antecedent_support",
        float_ratio("support", "antecedent_support").alias("confidence"),
    )
    if min_confidence is not None:
        rules = rules.where(float_at_least("confidence", min_confidence))
    return rules


def grown_rules(itemsets: DataFrame, min_confidence: float = DEFAULT_MIN_CONFIDENCE, *,
                workspace: Workspace | None = None) -> DataFrame:
    """:func:`association_rules` of sets counted in distinct mode, from growing consequents.

    A consequent is carried as the places of its items in the set. Two confident
    consequents of a set that differ in their last place make a candidate, as
    the prefix classes of the miner do; a class is as long as the set at most.
    Every round is one join of the candidates' antecedents, and is written.
    """
    ws = workspace or Workspace(itemsets.sparkSession)
    lookup = itemsets.select(F.array_sort("items").alias("key"),
                             F.col("support").alias("antecedent_support"))
    grown = (itemsets.where(F.col("k") >= 2)
             .select("items", "support", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("last"))
             .select("items", "support", F.array("last").alias("places")))
    rounds, size = [], 1
    while True:
        picked = F.filter("items", lambda _x, i: F.array_contains("places", i))
        rest = F.filter("items", lambda _x, i: ~F.array_contains("places", i))
        tried = grown.select("items", "support", "places", picked.alias("consequent"), rest.alias("antecedent"))
        confidence = float_ratio("support", "antecedent_support").alias("confidence")
        rules = (tried.withColumn("key", F.array_sort("antecedent")).join(lookup, "key")
                 .select("items", "places", "antecedent", "consequent", "support", "antecedent_support", confidence)
                 .where(float_at_least("confidence", min_confidence)))
        rules, seen = ws.measured(rules, f"rules-{size}", n=F.count(F.lit(1)))
        rounds.append(rules)
        if not seen["n"]:
            break
        # classes of one set and all places but the last; the antecedent keeps an item
        classes = (rules.where(F.size("items") > size + 1)
                   .groupBy("items", "support", F.slice("places", 1, size - 1).alias("stem"))
                   .agg(F.array_sort(F.collect_list(F.element_at("places", -1))).alias("tail"))
                   .where(F.size("tail") > 1))
        first = F.explode(F.sequence(F.lit(0), F.size("tail") - 2)).alias("at")
        pairs = classes.select("*", first).select(
            "items", "support", "stem", F.get("tail", F.col("at")).alias("y"),
            F.explode(F.slice("tail", F.col("at") + 2, F.size("tail"))).alias("x"))
        grown = pairs.select("items", "support", F.concat("stem", F.array("y", "x")).alias("places"))
        size += 1
    out = rounds[0]
    for rules in rounds[1:]:
        out = out.unionByName(rules)
    return out.select("antecedent", "consequent", "support", "antecedent_support", "confidence")


def order_rules(rules: DataFrame) -> DataFrame:
    """Confidence descending; ties (unordered in the reference) by sets."""
    return rules.orderBy(F.col("confidence").desc(), "antecedent", "consequent")


def rule_report_lines(rules: DataFrame) -> DataFrame:
    """``a b \\t c \\t 0.6666667`` lines in report order, column ``line``."""
    return order_rules(rules).select(
        F.concat_ws("\t",
                    items_text("antecedent", RULE_ITEM_SEPARATOR),
                    items_text("consequent", RULE_ITEM_SEPARATOR),
                    F.col("confidence").cast(T.StringType())).alias("line"),
        "confidence", "antecedent", "consequent")
