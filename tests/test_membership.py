"""The bounded bitmap never drops a row whose key is there."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketry.functions import membership
from basketry.functions.membership import maybe_in
from basketry.operators.baskets import transactions


def test_keeps_every_key_and_drops_most_others(spark):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("tid"), F.col("id").alias("bits"))
    keys = rows.where("bits % 10 = 3").select("tid")
    got = maybe_in(rows, keys, "tid")
    assert got.columns == rows.columns
    assert got.join(keys, "tid").count() == 2000 and got.count() < 2100
    assert maybe_in(rows, keys.limit(0), "tid").count() == 0


def test_a_full_bitmap_drops_nothing_wrongly(spark, monkeypatch):
    monkeypatch.setattr(membership, "FILTER_BITS", 6)
    rows = spark.createDataFrame([(i,) for i in range(500)] + [(None,)], "tid int")
    keys = rows.where("tid % 2 = 0 or tid is null")
    got = {r.tid for r in maybe_in(rows, keys, "tid").collect()}
    assert got >= {None, *range(0, 500, 2)}


@pytest.mark.parametrize("left, right", [("int", "bigint"), ("bigint", "smallint"), ("int", "string"),
                                         ("string", "bigint"), ("int", "double")])
def test_keys_of_two_types_lose_nothing(spark, left, right):
    n = spark.range(2000)
    m = n.select(F.col("id").cast(left).alias("tid"), F.lit(1).alias("item"), F.lit(2e6).alias("value"))
    e = n.where("id % 2 = 0").select(F.col("id").cast(right).alias("tid"), F.array(F.lit("a")).alias("categories"))
    small, large = (sorted(map(tuple, transactions(m, e, categories=["a"], broadcast_rows=b).collect()))
                    for b in (1_000_000, 0))
    assert len(small) == 1000 and large == small
