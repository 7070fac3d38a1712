"""Line dedup by distinct-site spread.

A line is known by two 64-bit hashes of its text without white space at the
ends. Its spread is the number of distinct sites it is found on: each task
keeps a HyperLogLog sketch per line hash and the sketches merge in the
aggregation, so the state of a line is bounded however many sites have it.
Lines whose estimate is clear of the threshold are decided by it; lines within
the estimate's error get an exact distinct count. A line on enough sites is
boilerplate: its first occurrence (smallest id, then position) stays, every
other one is removed. Enough are ``long_min_sites`` for a line of ``long_words``
words or more, which two authors hardly write alike, and ``min_sites`` for a
shorter one, which they may.

Only hashes and positions are shuffled for the counting. A very common line is
one sketch per task; when its occurrences are looked up, the boilerplate table
has one row per line, so Spark can split the occurrences.

Rows: null text stays null and has no lines; a null site counts as no site;
blank lines are never counted nor removed; repeated rows (same id and text)
are treated alike, so both keep a first occurrence; ties at the threshold are
boilerplate; an empty table gives no rows; all other columns pass through
unchanged, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Scratch

MIN_SITES = 10
LONG_WORDS = 20
LONG_MIN_SITES = 3
LG_CONFIG_K = 12
BLANKS = " \t\r"


def margin(min_sites: int, lg_k: int = LG_CONFIG_K) -> int:
    """Estimates this far from the threshold are settled without a count:
    five standard errors, one site at least."""
    return max(1, math.ceil(5 * 1.04 / math.sqrt(1 << lg_k) * min_sites))


def is_long(line: Column, long_words: int) -> Column:
    """Whether a line without blanks at its ends has that many words."""
    return F.array_size(F.split(line, f"[{BLANKS}]+", -1)) >= long_words


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def occurrences(docs: DataFrame, id_col: str, text_col: str, site_col: str, long_words: int) -> DataFrame:
    """``(h1, h2, long, id, version, pos, site)`` of every line that is not blank."""
    text = F.col(f"`{text_col}`")
    lines = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("version"),
                        F.col(f"`{site_col}`").cast("string").alias("site"),
                        F.posexplode(_lines(text)).alias("pos", "line"))
    key = F.btrim("line", F.lit(BLANKS))
    return (lines.withColumn("key", key).where(F.col("key") != "")
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
                    is_long(F.col("key"), long_words).alias("long"), "id", "version", "pos", "site"))


def boilerplate(lines: DataFrame, min_sites: int, long_min_sites: int, scratch: Scratch) -> DataFrame:
    """``(h1, h2, first)``: lines on enough distinct sites."""
    need = F.when(F.col("long"), F.lit(long_min_sites)).otherwise(F.lit(min_sites))
    near = F.when(F.col("long"), F.lit(margin(long_min_sites))).otherwise(F.lit(margin(min_sites)))
    estimate = F.hll_sketch_estimate("sketch")
    spread = (lines.groupBy("h1", "h2")
              .agg(F.hll_sketch_agg("site", F.lit(LG_CONFIG_K)).alias("sketch"),
                   F.min(F.struct("id", "version", "pos")).alias("first"),
                   F.first("long").alias("long"), F.count(F.lit(1)).alias("n"))
              .withColumns({"need": need, "near": near})
              .where(F.col("n") >= F.col("need"))
              .select("h1", "h2", "first", "need", "near", estimate.alias("sites"))
              .where(F.col("sites") >= F.col("need") - F.col("near")))
    spread = scratch.keep(spread, "spread")
    is_clear = F.col("sites") > F.col("need") + F.col("near")
    clear, unsure = spread.where(is_clear), spread.where(~is_clear)
    exact = (lines.join(unsure.select("h1", "h2"), ["h1", "h2"]).where("site is not null")
             .select("h1", "h2", "site").distinct().groupBy("h1", "h2")
             .agg(F.count(F.lit(1)).alias("counted")))
    counted = (unsure.join(exact, ["h1", "h2"]).where(F.col("counted") >= F.col("need"))
               .select("h1", "h2", "first"))
    return scratch.keep(clear.select("h1", "h2", "first").unionByName(counted), "boilerplate")


def line_dedup(docs: DataFrame, *, min_sites: int = MIN_SITES, long_words: int = LONG_WORDS,
               long_min_sites: int = LONG_MIN_SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
               scratch: Scratch | None = None, counts: bool = False) -> DataFrame:
    """``docs`` with the repeated boilerplate lines taken out of ``text_col``.

    With ``counts`` the result is ``(id, n_lines, n_removed, text)`` instead.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    lines = scratch.keep(occurrences(docs, id_col, text_col, site_col, long_words), "lines")
    bad = boilerplate(lines, min_sites, long_min_sites, scratch)
    gone = (lines.join(bad, ["h1", "h2"])
            .where(~F.struct("id", "version", "pos").eqNullSafe(F.col("first")))
            .select("id", "version", "pos").distinct()
            .groupBy("id", "version").agg(F.collect_list("pos").alias("gone")))
    rows = docs.select(F.struct("*").alias("row"))
    text = F.col("row").getField(text_col)
    rows = rows.select("row", F.col("row").getField(id_col).alias("id"), F.xxhash64(text).alias("version"))
    g = gone.select(F.col("id").alias("gone_id"), F.col("version").alias("gone_version"), "gone")
    rows = rows.join(g, F.col("id").eqNullSafe(F.col("gone_id"))
                     & (F.col("version") == F.col("gone_version")), "left")
    all_lines = _lines(text)
    left = F.array_except(F.sequence(F.lit(0), F.array_size(all_lines) - 1), F.col("gone"))
    cleaned = F.when(F.col("gone").isNull(), text).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(all_lines, i)), "\n"))
    if counts:
        zero = F.lit(0).cast("bigint")
        return rows.select("id", F.coalesce(F.array_size(all_lines).cast("bigint"), zero).alias("n_lines"),
                           F.coalesce(F.array_size("gone").cast("bigint"), zero).alias("n_removed"),
                           cleaned.alias("text"))
    return rows.select(F.col("row").withField(f"`{text_col}`", cleaned).alias("row")).select("row.*")
