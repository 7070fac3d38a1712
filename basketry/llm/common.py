"""Helpers the operators share: scratch tables, docs in.

Scratch tables are Parquet files in a folder of their own per run under the
shared checkpoint folder of the session (see ``basketry.session``); reading
them back cuts the lineage, so a lost executor costs a re-read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import Workspace, ship  # noqa: F401  (ship: for the operators)

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when their table is whole.

    Nothing reads them again, as the written table takes their place; without
    this they stay until the driver happens to collect what refers to them.
    """
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


class Scratch(Workspace):
    """A run's folder of written tables, zstd-compressed."""

    def keep(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        """Write ``df`` once and read it back."""
        target = self.location(name)
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with freed_shuffles(self.spark):
            writer.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)


    def bucketed(self, df: DataFrame, name: str, column: str) -> DataFrame:
        """Write ``df`` once, each task's rows in files by bucket of ``column``, and read it back.

        Grouping or joining the table by ``column`` then needs no exchange of it.
        There are as many buckets as shuffle partitions. The catalog entry that
        the write needs goes at once; the files stay with the other tables.
        """
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"basketry_{uuid.uuid4().hex}"
        with freed_shuffles(self.spark):
            (df.write.format("parquet").option("compression", "zstd").option("path", self.location(name))
             .bucketBy(n, column).saveAsTable(table))
        found = self.spark.table(table)
        found.schema            # the plan holds the files and their buckets from here on
        self.spark.sql(f"drop table {table}")
        return found


def columns(df: DataFrame, **named: str | Column) -> DataFrame:
    """Exactly the named columns, so extra or clashing ones cannot matter.

    A string names a column of ``df`` literally (dots and all).
    """
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(n)
                       for n, c in named.items()])


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)``."""
    return columns(docs, doc_id=id_col, text=text_col)


def crc_mod(col: str, n: int) -> Column:
    """``crc32(<id as text>) mod n``."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(n)


def texts(batch, i: int = 1) -> list[str]:
    """Column ``i`` of an Arrow batch as strings; null is empty."""
    return [t or "" for t in batch.column(i).to_pylist()]


def ascii_lower(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased and nothing else changed."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER)


def mask64(x: int) -> int:
    return x & 0xFFFFFFFFFFFFFFFF


def signed(a: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the signed longs Spark stores."""
    return np.ascontiguousarray(a, dtype=np.uint64).view(np.int64)
