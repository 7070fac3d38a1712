"""Comma-separated text scans with the reference's header rule.

The first line of a file is its header; every later line equal to it
ignoring case is dropped too, wherever it sits. Fields are taken by
position from ``split(line, ',')``; quotes are ordinary characters (no CSV
unquoting). A line with too few fields or a malformed number raises, whatever
the session's ANSI setting.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELD_SEPARATOR = ","   # fixed: field separator of both input files
TOKEN_SEPARATOR = " "   # fixed: separator of the multi-valued attribute


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, column ``value``."""
    return spark.read.text(path)


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of the first file (in name order) under ``path`` that has one.

    The name of the first file that is not empty comes from an aggregate over
    the file listing, which reads no content; then the head of that one file is
    read. A plain ``first()`` on the whole folder would not do: the scan orders
    file splits by size, so it may start in any file. Only if the file holds no
    line although it has bytes (an empty archive) are the lines themselves
    aggregated.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    name = files.agg(F.min("path").alias("path")).first()["path"]
    if name is None:
        return None
    row = spark.read.text(_escape_glob(name)).first()
    if row is not None:
        return row[0]
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")
    row = lines.agg(F.min(F.struct("file", "block", "at", "value")).alias("low")).first()["low"]
    return None if row is None else row["value"]


def _escape_glob(path: str) -> str:
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def drop_header(lines: DataFrame, header: str | None) -> DataFrame:
    """Drop every line equal to ``header`` ignoring case (no-op if None)."""
    if header is None:
        return lines
    return lines.where(F.lower(F.col("value")) != F.lower(F.lit(header)))


def read_body(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``path`` without its header line or any copy of it."""
    return drop_header(read_lines(spark, path), first_line(spark, path))


def _fields(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.split(F.col("value"), FIELD_SEPARATOR, -1).alias("f"))


def _field(at: int, as_type: T.DataType | None = None) -> Column:
    """Field ``at`` of a line; raises if it is missing or cannot be cast."""
    text = F.get("f", F.lit(at))
    bad = F.raise_error(F.concat(F.lit(f"field {at} is missing or malformed: "), F.col("value")))
    found = text if as_type is None or isinstance(as_type, T.StringType) else text.try_cast(as_type)
    return F.when(found.isNull(), bad).otherwise(found)


def read_measurements_text(spark: SparkSession, path: str, *,
                           item_type: T.DataType = T.IntegerType(),
                           tid_col: int = 0, item_col: int = 1,
                           value_col: int = 2) -> DataFrame:
    """``tid,item,value`` text -> ``(tid STRING, item, value FLOAT)``.

    Items are cast once here (integers by default, so sets order
    numerically); pass ``item_type=StringType()`` to keep text items.
    """
    f = _fields(read_body(spark, path))
    return f.select(
        _field(tid_col).alias("tid"),
        _field(item_col, item_type).alias("item"),
        _field(value_col, T.FloatType()).alias("value"),
    )


def read_entities_text(spark: SparkSession, path: str, *, tid_col: int = 0,
                       attr_col: int = 4) -> DataFrame:
    """Entity text -> ``(tid STRING, categories ARRAY<STRING>)``.

    The attribute is split on single spaces. Unlike Java's ``split`` a
    trailing empty token is kept; an empty token never matches a category,
    so results are unaffected.
    """
    f = _fields(read_body(spark, path))
    return f.select(
        _field(tid_col).alias("tid"),
        F.split(_field(attr_col), TOKEN_SEPARATOR, -1).alias("categories"),
    )


def write_measurements_text(measurements: DataFrame, path: str, *,
                            header: str = "tid,item,value",
                            mode: str = "errorifexists") -> None:
    """Write ``(tid, item, value)`` as comma-separated lines plus a header.

    The header goes in its own first part file so readers see it first.
    """
    spark = measurements.sparkSession
    body = measurements.select(F.concat_ws(
        FIELD_SEPARATOR, F.col("tid").cast("string"), F.col("item").cast("string"),
        F.col("value").cast("string")).alias("value"))
    head = spark.createDataFrame([(header,)], "value string")
    head.unionByName(body).write.mode(mode).text(path)


def write_entities_text(entities: DataFrame, path: str, *,
                        header: str = "tid,a,b,c,categories",
                        mode: str = "errorifexists") -> None:
    """Write ``(tid, categories)`` as 5-field lines, attribute in field 4."""
    spark = entities.sparkSession
    body = entities.select(F.concat_ws(
        FIELD_SEPARATOR, F.col("tid").cast("string"), F.lit(""), F.lit(""), F.lit(""),
        F.array_join(F.col("categories"), TOKEN_SEPARATOR)).alias("value"))
    head = spark.createDataFrame([(header,)], "value string")
    head.unionByName(body).write.mode(mode).text(path)
