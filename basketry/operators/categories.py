"""Category counts (job 1): strong measurements per category token.

The count is over (strong measurement x matching token) pairs of the
measurement-entity join on ``tid``: an entity with three strong
measurements adds 3 to each of its tokens, a token listed twice adds twice,
and duplicate entity rows multiply:

    n(category) = sum over tid of strong(tid) * tokens(tid, category)

The token side ``(tid, category, n_token)`` comes from the entity table.
It is written once; when its rows and bytes are within the broadcast bounds
it is joined map-side:
the measurement table is scanned once and never shuffled, each task
emits one partial sum per category. Otherwise strong measurements are
first aggregated per ``tid`` (a hot ``tid`` collapses to one row per
task) and joined by shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.predicates import (
    DEFAULT_CATEGORY_NAMES,
    DEFAULT_CATEGORY_SUBSTRING,
    DEFAULT_CUTOFF,
    category_token,
    strong_filter,
)
from basketry.session import DEFAULT_BROADCAST_ROWS, small_side


def strong_measurements(measurements: DataFrame, *, cutoff: float = DEFAULT_CUTOFF,
                        inclusive: bool = False) -> DataFrame:
    """Measurements whose value is strong (float comparison, no NaN)."""
    return strong_filter(measurements, "value", cutoff, inclusive)


def category_tokens(entities: DataFrame, *,
                    substring: str = DEFAULT_CATEGORY_SUBSTRING,
                    names: Iterable[str] = DEFAULT_CATEGORY_NAMES) -> DataFrame:
    """``(tid, category)``: one row per matching token of each entity row."""
    return (entities
            .select("tid", F.explode("categories").alias("category"))
            .where(category_token("category", substring, names)))


def strong_entity_pairs(measurements: DataFrame, entities: DataFrame, *,
                        cutoff: float = DEFAULT_CUTOFF,
                        inclusive: bool = False) -> DataFrame:
    """The job-1 join itself: ``(tid, value, categories)`` per matching pair."""
    strong = strong_measurements(measurements.select("tid", "value"),
                                 cutoff=cutoff, inclusive=inclusive)
    return strong.join(entities.select("tid", "categories"), "tid", "inner")


def category_counts(measurements: DataFrame, entities: DataFrame, *,
                    cutoff: float = DEFAULT_CUTOFF, inclusive: bool = False,
                    substring: str = DEFAULT_CATEGORY_SUBSTRING,
                    names: Iterable[str] = DEFAULT_CATEGORY_NAMES,
                    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``(category, n)``: unordered; see :func:`order_category_counts`."""
    strong = strong_measurements(measurements.select("tid", "value"),
                                 cutoff=cutoff, inclusive=inclusive)
    per_token = (category_tokens(entities, substring=substring, names=tuple(names))
                 .groupBy("tid", "category").agg(F.count(F.lit(1)).alias("n_token")))
    per_token, fits = small_side(per_token, "category-tokens", broadcast_rows)
    if fits:
        return (strong.join(F.broadcast(per_token), "tid", "inner")
                .groupBy("category")
                .agg(F.sum("n_token").cast("bigint").alias("n")))
    per_tid = strong.groupBy("tid").agg(F.count(F.lit(1)).alias("n_strong"))
    return (per_tid.join(per_token, "tid", "inner")
            .groupBy("category")
            .agg(F.sum(F.col("n_strong") * F.col("n_token")).cast("bigint").alias("n")))


def order_category_counts(counts: DataFrame) -> DataFrame:
    """Count descending; ties (unordered in the reference) by category."""
    return counts.orderBy(F.col("n").desc(), F.col("category"))


def category_report_lines(counts: DataFrame) -> DataFrame:
    """``category \\t n`` lines in report order, column ``line``."""
    return order_category_counts(counts).select(
        F.concat_ws("\t", F.col("category"), F.col("n").cast("string")).alias("line"),
        "n", "category")
