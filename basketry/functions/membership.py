"""A bounded stand-in for a set of keys that may be too large to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILTER_BITS = 24   # 2^24 bits: at most 2^18 rows of 64, whatever the number of keys


def maybe_in(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``df`` without most rows whose ``column`` is not in ``keys (column)``.

    Never drops a row whose key is there. The keys' hashes set bits of a bitmap
    of fixed size, which is small enough to broadcast by construction; the more
    keys there are, the less it drops. Meant before a shuffle join that decides.
    Equal values of two types hash differently: whole numbers are hashed as
    bigint then, and with any other two types every row is left to the join.
    """
    kinds = [d.schema[column].dataType for d in (df, keys)]
    key = F.col(column)
    if kinds[0] != kinds[1]:
        if not all(isinstance(k, T.IntegralType) for k in kinds):
            return df
        key = key.cast("bigint")
    bit = F.xxhash64(key).bitwiseAND(F.lit((1 << FILTER_BITS) - 1).cast("bigint"))
    place = (bit % 64).cast("int")
    words = (keys.select(F.shiftright(bit, 6).alias("__word"),
                         F.call_function("shiftleft", F.lit(1).cast("bigint"), place).alias("set"))
             .groupBy("__word").agg(F.bit_or("set").alias("__bits")))
    rows = df.withColumn("__word", F.shiftright(bit, 6)).join(F.broadcast(words), "__word")
    return (rows.where(F.call_function("shiftrightunsigned", F.col("__bits"), place)
                       .bitwiseAND(F.lit(1).cast("bigint")) == 1)
            .drop("__word", "__bits"))
