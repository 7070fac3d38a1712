"""Adapters from any DataFrame (Parquet, tables, ...) to the engine's shapes.

measurements: ``(tid, item, value)``  one row per measurement
entities:     ``(tid, categories ARRAY<STRING>)``  one row per entity record

Only ``select`` and renames happen here, so column pruning and filters
still reach the underlying scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.sources.text import TOKEN_SEPARATOR


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_measurements(df: DataFrame, tid: Column | str, value: Column | str,
                    item: Column | str | None = None) -> DataFrame:
    """Project ``df`` to ``(tid, [item,] value)``."""
    cols = [_col(tid).alias("tid")]
    if item is not None:
        cols.append(_col(item).alias("item"))
    cols.append(_col(value).alias("value"))
    return df.select(*cols)


def as_entities(df: DataFrame, tid: Column | str, attribute: Column | str,
                sep: str = TOKEN_SEPARATOR) -> DataFrame:
    """Project ``df`` to ``(tid, categories)`` splitting a text attribute."""
    return df.select(_col(tid).alias("tid"),
                     F.split(_col(attribute), sep, -1).alias("categories"))
