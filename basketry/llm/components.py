"""Connected components of a table of links, by alternating star contractions.

Large-star hangs every larger neighbour of a node on the node's smallest
neighbour, small-star does so for the smaller ones (Kiveris et al. 2014); the
links end as stars whose centre is the smallest node. Each half round is a
partial aggregation and a join on the node; a round's links are written to the
shared folder, so the plan stays short. A node with very many links is one row
on the aggregated side, which is written first so that Spark can split the
rows of that node on the other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Scratch


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
                    .alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame, scratch: Scratch, name: str = "links") -> DataFrame:
    """``(node, root)`` for every node of ``links (u, v)`` that is not a root.

    ``root`` is the smallest node reachable. Nodes are of any orderable type;
    links of a node with itself, repeated ones and nulls are ignored.
    """
    def kept(df: DataFrame, step: str) -> DataFrame:
        return scratch.keep(df, f"{name}-{step}")

    links = kept(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u is not null and v is not null and u <> v").distinct(), "0")
    state, k = _state(links), 0
    while state[0]:
        k += 1
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = kept(both.groupBy("u").agg(F.min("v").alias("m"))
                   .select("u", F.least("u", "m").alias("m")), f"large-{k}")
        large = kept(both.join(low, "u").where("v > u")
                     .select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .where("u <> v").distinct(), f"a{k}")
        low = kept(large.groupBy("u").agg(F.min("v").alias("m")), f"small-{k}")
        down = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = kept(down.unionByName(low.select("u", F.col("m").alias("v")))
                     .where("u <> v").distinct(), f"b{k}")
        before, state = state, _state(links)
        if before == state:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
