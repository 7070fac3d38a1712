"""Registered queries over the test tables (see ``basketry.plans.tables``).

Every query reads whole tables; each callable takes ``(spark, sf_dir)``
and returns a DataFrame whose column names match the oracle SQL in
``basketry.plans.oracle``. Itemsets are rendered as ``'1;5;9'`` text,
counts as BIGINT, confidence as the DOUBLE widening of the FLOAT value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.arrays import items_text
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
from basketry.plans import tables as fx
from basketry.plans.jobs import category_count_job, itemset_job, rule_job
from basketry.session import Workspace
from basketry.sources.reports import (
    read_itemset_report,
    read_itemset_table,
    write_itemset_table,
    write_lines,
)
from basketry.sources.streamed import write_itemset_report
from basketry.sources.text import (
    read_entities_text,
    read_measurements_text,
    write_entities_text,
    write_measurements_text,
)

Query = Callable[[SparkSession, str], DataFrame]


# ---- F-A: filters, tokens, category counts ---------------------------------

def strong_filter_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strong_measurements(fx.fa_measurements(spark, sf_dir),
                               cutoff=fx.FA_CUTOFF, inclusive=False)


def strong_filter_ge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strong_measurements(fx.fa_measurements(spark, sf_dir),
                               cutoff=fx.FA_CUTOFF, inclusive=True)


def category_tokens_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_tokens(fx.fa_entities(spark, sf_dir),
                           substring=fx.FA_SUBSTRING, names=fx.FA_NAMES)


def strong_join_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = strong_entity_pairs(fx.fa_measurements(spark, sf_dir),
                                fx.fa_entities(spark, sf_dir), cutoff=fx.FA_CUTOFF)
    return pairs.select("tid", "value", F.array_join("categories", " ").alias("name"))


def _fa_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_counts(fx.fa_measurements(spark, sf_dir), fx.fa_entities(spark, sf_dir),
                           cutoff=fx.FA_CUTOFF, inclusive=False,
                           substring=fx.FA_SUBSTRING, names=fx.FA_NAMES)


def category_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_category_counts(_fa_counts(spark, sf_dir))


def category_report_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_report_lines(_fa_counts(spark, sf_dir)).select("line")


# ---- F-B: text scan, entities, transactions ---------------------------------

def text_scan_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the F-B measurements as headed text (plus a re-cased header
    copy at the end) into the workspace and scan it back."""
    ws = Workspace(spark)
    m = fx.fb_measurements(spark, sf_dir)
    header = "customer_id,brand_no,extended_price"
    copy = spark.createDataFrame([(header.upper(),)], "value string")
    body = m.select(F.concat_ws(",", F.col("tid").cast("string"), F.col("item").cast("string"),
                                F.col("value").cast("string")).alias("value"))
    head = spark.createDataFrame([(header,)], "value string")
    path = ws.location("measurements-text")
    head.unionByName(body).unionByName(copy).write.text(path)
    back = read_measurements_text(spark, path)
    return back.select("tid", "item", F.col("value").cast(T.DoubleType()).alias("value"))


def text_roundtrip_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same check through the library writer ``write_measurements_text``."""
    ws = Workspace(spark)
    path = ws.location("measurements-text")
    write_measurements_text(fx.fb_measurements(spark, sf_dir), path)
    back = read_measurements_text(spark, path)
    return back.select("tid", "item", F.col("value").cast(T.DoubleType()).alias("value"))


def entity_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-B entities written as 5-field text (attribute in field 4), scanned back."""
    path = Workspace(spark).location("entities-text")
    write_entities_text(fx.fb_entities(spark, sf_dir), path)
    back = read_entities_text(spark, path)
    return back.select("tid", F.array_join("categories", " ").alias("segment"))


def _text_inputs(spark: SparkSession, measurements: DataFrame,
                 entities: DataFrame) -> tuple[Workspace, str, str]:
    ws = Workspace(spark)
    geo, meta = ws.location("measurements-text"), ws.location("entities-text")
    write_measurements_text(measurements, geo)
    write_entities_text(entities, meta)
    return ws, geo, meta


def category_job_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job 1 end to end over text inputs derived from F-A; the report read back."""
    m = fx.fa_measurements(spark, sf_dir).select(
        "tid", F.lit(0).alias("item"), "value")
    ws, geo, meta = _text_inputs(spark, m, fx.fa_entities(spark, sf_dir))
    out = ws.location("category-report")
    category_count_job(spark, geo, meta, out, cutoff=fx.FA_CUTOFF,
                       substring=fx.FA_SUBSTRING, names=fx.FA_NAMES)
    return spark.read.text(out).select(F.col("value").alias("line"))


def _itemset_job_text(spark: SparkSession, sf_dir: str) -> tuple[Workspace, str]:
    ws, geo, meta = _text_inputs(spark, fx.fb_measurements(spark, sf_dir),
                                 fx.fb_entities(spark, sf_dir))
    out = ws.location("itemset-report")
    itemset_job(spark, geo, meta, out, min_support=fx.FB_MIN_SUPPORT,
                max_size=fx.FB_MAX_SIZE, cutoff=fx.FB_CUTOFF,
                categories=fx.FB_CATEGORIES, distinct=False)
    return ws, out


def itemset_job_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job 2 end to end (bag counting, as the reference) over derived text."""
    _, out = _itemset_job_text(spark, sf_dir)
    return spark.read.text(out).select(F.col("value").alias("line"))


def rule_job_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job 3 end to end: rules from the job-2 report file."""
    ws, report = _itemset_job_text(spark, sf_dir)
    out = ws.location("rule-report")
    rule_job(spark, report, out, min_confidence=fx.FB_MIN_CONFIDENCE)
    return spark.read.text(out).select(F.col("value").alias("line"))


def entity_any_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    ents = qualifying_entities(fx.fb_entities(spark, sf_dir), fx.FB_CATEGORIES)
    return ents.select("tid", F.array_join("categories", " ").alias("segment"))


def _fb_tx(spark: SparkSession, sf_dir: str, distinct: bool) -> DataFrame:
    return transactions(fx.fb_measurements(spark, sf_dir), fx.fb_entities(spark, sf_dir),
                        cutoff=fx.FB_CUTOFF, inclusive=True,
                        categories=fx.FB_CATEGORIES, distinct=distinct)


def transactions_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fb_tx(spark, sf_dir, True)


def transactions_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fb_tx(spark, sf_dir, False)


def baskets_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baskets(_fb_tx(spark, sf_dir, True)).select(
        "tid", items_text("items").alias("items"))


def basket_sizes_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return basket_sizes(_fb_tx(spark, sf_dir, False))


def support_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return support_stats(_fb_tx(spark, sf_dir, False), fx.FB_MIN_SUPPORT, fx.FB_MAX_SIZE)


# ---- F-B: mining ------------------------------------------------------------

def _mine(spark: SparkSession, sf_dir: str, max_size: int, distinct: bool) -> FrequentItemsets:
    return frequent_itemsets(_fb_tx(spark, sf_dir, distinct), fx.FB_MIN_SUPPORT, max_size)


def _sets_out(itemsets: DataFrame, with_k: bool = True) -> DataFrame:
    cols = [items_text("items").alias("itemset")]
    if with_k:
        cols.append("k")
    cols.append("support")
    return itemsets.select(*cols)


def frequent_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sets_out(_mine(spark, sf_dir, 1, True).itemsets, with_k=False)


def frequent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = _mine(spark, sf_dir, 2, True).itemsets
    return _sets_out(sets.where(F.col("k") == 2), with_k=False)


def frequent_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = _mine(spark, sf_dir, 3, True).itemsets
    return _sets_out(sets.where(F.col("k") == 3), with_k=False)


def frequent_itemsets_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sets_out(order_itemsets(_mine(spark, sf_dir, fx.FB_MAX_SIZE, True).itemsets))


def frequent_itemsets_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sets_out(order_itemsets(_mine(spark, sf_dir, fx.FB_MAX_SIZE, False).itemsets))


def itemset_report_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itemset_report_lines(_mine(spark, sf_dir, fx.FB_MAX_SIZE, True).itemsets)


def _write_report(spark: SparkSession, sf_dir: str) -> str:
    mined = _mine(spark, sf_dir, fx.FB_MAX_SIZE, True)
    path = mined.workspace.location("itemset-report")
    write_lines(itemset_report_lines(mined.itemsets), path)
    return path


def report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.text(_write_report(spark, sf_dir)).select(F.col("value").alias("line"))


def report_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report again, written set by set."""
    mined = _mine(spark, sf_dir, fx.FB_MAX_SIZE, True)
    path = mined.workspace.location("streamed-report")
    write_itemset_report(mined.itemsets, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def report_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sets_out(read_itemset_report(spark, _write_report(spark, sf_dir),
                                         item_type=T.IntegerType()))


def itemset_max_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = _mine(spark, sf_dir, fx.FB_MAX_SIZE, True).itemsets
    return sets.agg(F.max("k").alias("max_k"))


def proper_subsets_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = proper_subsets(_mine(spark, sf_dir, fx.FB_MAX_SIZE, True).itemsets)
    return subs.select(items_text("items").alias("itemset"),
                       items_text("subset").alias("subset"))


# ---- F-B: rules -------------------------------------------------------------

def _rules_out(rules: DataFrame) -> DataFrame:
    return rules.select(items_text("antecedent").alias("antecedent"),
                        items_text("consequent").alias("consequent"),
                        "support", "antecedent_support",
                        F.col("confidence").cast(T.DoubleType()).alias("confidence"))


def rules_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = _mine(spark, sf_dir, fx.FB_MAX_SIZE, True).itemsets
    return _rules_out(association_rules(sets, None))


def rules_confident(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = _mine(spark, sf_dir, fx.FB_MAX_SIZE, True).itemsets
    return _rules_out(association_rules(sets, fx.FB_MIN_CONFIDENCE))


def rules_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The confident rules again, from growing consequents."""
    mined = _mine(spark, sf_dir, fx.FB_MAX_SIZE, True)
    return _rules_out(grown_rules(mined.itemsets, fx.FB_MIN_CONFIDENCE, workspace=mined.workspace))


def rules_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = _mine(spark, sf_dir, fx.FB_MAX_SIZE, True).itemsets
    return _rules_out(order_rules(association_rules(sets, fx.FB_MIN_CONFIDENCE)))


def rules_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = _mine(spark, sf_dir, fx.FB_MAX_SIZE, False).itemsets
    return _rules_out(association_rules(sets, fx.FB_MIN_CONFIDENCE))


def rule_report_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = _mine(spark, sf_dir, fx.FB_MAX_SIZE, True).itemsets
    return rule_report_lines(association_rules(sets, fx.FB_MIN_CONFIDENCE)).select("line")


def rules_unsorted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules from a report that lists the items of every set backwards."""
    mined = _mine(spark, sf_dir, fx.FB_MAX_SIZE, True)
    path = mined.workspace.location("backwards-report")
    write_lines(itemset_report_lines(mined.itemsets.withColumn("items", F.reverse("items"))), path)
    return _rules_out(association_rules(read_itemset_report(spark, path), fx.FB_MIN_CONFIDENCE))


def rules_text_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items are whole brand names; mined, reported, parsed and ruled as text."""
    tx = transactions(fx.fb_text_measurements(spark, sf_dir), fx.fb_entities(spark, sf_dir),
                      cutoff=fx.FB_CUTOFF, inclusive=True, categories=fx.FB_CATEGORIES, distinct=True)
    mined = frequent_itemsets(tx, fx.FB_MIN_SUPPORT, fx.FB_MAX_SIZE)
    path = mined.workspace.location("text-report")
    write_lines(itemset_report_lines(mined.itemsets), path)
    return _rules_out(association_rules(read_itemset_report(spark, path), fx.FB_MIN_CONFIDENCE))


def rules_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules from the written table of sets, without any report line."""
    mined = _mine(spark, sf_dir, fx.FB_MAX_SIZE, True)
    path = mined.workspace.location("itemset-table")
    write_itemset_table(mined.itemsets, path)
    return _rules_out(association_rules(read_itemset_table(spark, path), fx.FB_MIN_CONFIDENCE))


# ---- inputs on which near-equal operators differ -----------------------------

def strong_filter_gt_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strong_measurements(fx.fa_measurements(spark, sf_dir),
                               cutoff=fx.a_price(spark, sf_dir), inclusive=False)


def strong_filter_ge_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strong_measurements(fx.fa_measurements(spark, sf_dir),
                               cutoff=fx.a_price(spark, sf_dir), inclusive=True)


def entity_any_of_many_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with any listed token among the several of their name."""
    ents = qualifying_entities(fx.fa_entities(spark, sf_dir), fx.FA_TOKEN_LIST)
    return ents.select("tid", F.array_join("categories", " ").alias("name"))


def transactions_repeated_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag transactions when an entity is listed more than once."""
    return transactions(fx.fb_measurements(spark, sf_dir), fx.fb_repeated_entities(spark, sf_dir),
                        cutoff=fx.FB_CUTOFF, inclusive=True, categories=fx.FB_CATEGORIES,
                        distinct=False)


def _ranked(ordered: DataFrame) -> DataFrame:
    """``rank``: the place of a row in an ordered frame, from 1.

    Places count up within the range partitions; each partition adds the sizes
    of those before it, a table of one row per partition.
    """
    at = F.monotonically_increasing_id()
    ws = Workspace(ordered.sparkSession)
    rows = ws.materialize(ordered.withColumn("at", at), "ordered").withColumn(
        "part", F.shiftright("at", 33))
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1).cast("bigint")) + F.col("before") + 1
    return rows.join(offsets, "part").withColumn("rank", place).drop("at", "part", "before")


def category_counts_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(category_counts_q(spark, sf_dir))


def itemset_lines_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(itemset_report_lines_q(spark, sf_dir)).select("line", "rank")


def rule_lines_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(rule_report_lines_q(spark, sf_dir)).select("line", "rank")


QUERIES: dict[str, Query] = {
    "strong_filter_gt": strong_filter_gt,
    "strong_filter_ge": strong_filter_ge,
    "text_scan_header": text_scan_header,
    "text_roundtrip_writer": text_roundtrip_writer,
    "entity_text_scan": entity_text_scan,
    "entity_any_token": entity_any_token,
    "category_tokens": category_tokens_q,
    "strong_join_entities": strong_join_entities,
    "category_counts": category_counts_q,
    "category_report_lines": category_report_lines_q,
    "transactions_distinct": transactions_distinct,
    "transactions_bag": transactions_bag,
    "baskets": baskets_q,
    "basket_sizes": basket_sizes_q,
    "support_stats": support_stats_q,
    "frequent_items": frequent_items,
    "frequent_pairs": frequent_pairs,
    "frequent_triples": frequent_triples,
    "frequent_itemsets": frequent_itemsets_q,
    "frequent_itemsets_bag": frequent_itemsets_bag,
    "itemset_report_lines": itemset_report_lines_q,
    "report_sink": report_sink,
    "report_streamed": report_streamed,
    "report_parse": report_parse,
    "itemset_max_size": itemset_max_size,
    "proper_subsets": proper_subsets_q,
    "rules_all": rules_all,
    "rules_confident": rules_confident,
    "rules_grown": rules_grown,
    "rules_ordered": rules_ordered,
    "rules_bag": rules_bag,
    "rule_report_lines": rule_report_lines_q,
    "category_job_text": category_job_text,
    "itemset_job_text": itemset_job_text,
    "rule_job_text": rule_job_text,
    "rules_unsorted_report": rules_unsorted_report,
    "rules_text_items": rules_text_items,
    "rules_from_table": rules_from_table,
    "strong_filter_gt_tie": strong_filter_gt_tie,
    "strong_filter_ge_tie": strong_filter_ge_tie,
    "entity_any_of_many_tokens": entity_any_of_many_tokens,
    "transactions_repeated_entities": transactions_repeated_entities,
    "category_counts_ranked": category_counts_ranked,
    "itemset_lines_ranked": itemset_lines_ranked,
    "rule_lines_ranked": rule_lines_ranked,
}
