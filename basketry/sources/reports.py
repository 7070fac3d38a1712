"""Text report sinks and the itemset report source.

Report formats (fixed by the reference):
  category counts   ``category \\t count``
  itemsets          ``support \\t 1;2;3 \\t 4;5 ...`` one line per support value
  rules             ``1 2 \\t 3 \\t 0.6666667``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.arrays import ITEM_SEPARATOR, SET_SEPARATOR, cast_or_raise, parse_items


def write_lines(lines: DataFrame, path: str, *, single_file: bool = False,
                mode: str = "errorifexists") -> None:
    """Write the string column ``line`` of an ordered frame as text.

    The sorted partitions are written in parallel and the part files, read
    in name order, hold the total order. ``single_file`` gives one part file
    like the reference's sinks, sorted and written by one task: for reports
    that fit one.
    """
    out = lines.select(F.col("line").alias("value"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).text(path)


def read_itemset_report(spark: SparkSession, path: str, *,
                        item_type: T.DataType = T.StringType()) -> DataFrame:
    """Itemset report text -> ``(items ARRAY, k INT, support BIGINT)``.

    Reads every part file under ``path`` (the reference reads only the
    first). Each line yields one row per set it lists, its items in the order
    listed. Ids stay text unless ``item_type`` says otherwise. A support or an
    item that cannot be read raises, whatever the session's ANSI setting.

    The text is scanned by tab, not by line, so a line of any length is many
    rows, in as many tasks as the file has splits. What lies between two tabs is
    a set or, around a line end, the last set of a line and the next line's
    support. A set's support is the last one before it: within its split, or
    else the last of the splits before, of which each has one row.
    """
    rows = spark.read.option("lineSep", SET_SEPARATOR).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.split("value", "\r?\n", -1).alias("parts"))
    split = ["file", "block"]
    ends_line = F.size("parts") > 1
    end = F.element_at("parts", -1)

    # the support a split hands on; a file begins with one
    handed = rows.groupBy(*split).agg(F.coalesce(
        F.max_by(F.when(ends_line, end), F.when(ends_line, F.col("at"))),
        F.min_by(F.when(F.col("block") == 0, end), "at")).alias("handed"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = handed.select(*split, F.last("handed", ignorenulls=True).over(before).alias("carried"))

    inside = Window.partitionBy(*split).orderBy("at")
    first = (F.col("block") == 0) & (F.row_number().over(inside) == 1)
    seen = rows.withColumn("first", first)
    seen = seen.withColumn("own", F.last(F.when(ends_line | F.col("first"), end), ignorenulls=True).over(
        inside.rowsBetween(Window.unboundedPreceding, -1)))
    between = F.slice("parts", 2, F.greatest(F.size("parts") - 2, F.lit(0)))   # lines without any set
    checked = F.forall(between, lambda x: cast_or_raise(x, T.LongType(), "support").isNotNull())
    return (seen.join(carried, split).where(~F.col("first") & checked)
            .select(parse_items(F.get("parts", F.lit(0)), ITEM_SEPARATOR, item_type).alias("items"),
                    cast_or_raise(F.coalesce("own", "carried"), T.LongType(), "support").alias("support"))
            .select("items", F.size("items").alias("k"), "support"))


def write_itemset_table(itemsets: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """``(items, k, support)`` as Parquet: one row per set, no line to build."""
    itemsets.select("items", "k", "support").write.mode(mode).parquet(path)


def read_itemset_table(spark: SparkSession, path: str) -> DataFrame:
    """The table written by :func:`write_itemset_table`."""
    return spark.read.parquet(path).select("items", "k", "support")
