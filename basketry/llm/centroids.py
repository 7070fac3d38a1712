"""Centroid clustering of integer vectors with scalar lookup tables.

Vectors become integers once and are written. A round is one pass over them:
for a block of vectors and each dimension, the squared differences between
every integer that occurs there and every centroid are tabulated, and a
vector's distances are the sum of its rows gathered from the tables, so no
difference is computed per vector. A task sums its vectors per cluster and
sends one row of sums a cluster; the driver sees ``k`` rows of sums a round and
takes the exact floors. The blocks bound a task's memory, whatever the range
of the values: a table has at most as many rows as its block.

Rows: a vector of another length, or with a null, infinite or NaN component, is
left out, so is a null vector; repeated rows each give a row and count each
time; a null id has the empty text in its seed and may start a centroid like
any other. Ties go to the smaller centroid, those between equal seeds to the
smaller vector. With fewer vectors than ``k`` there are that many centroids; an
empty table gives no rows; other columns are ignored. An integer beyond
``MAX_COMPONENT`` in size raises, as distances could leave 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import Scratch, columns, ship

K = 40
ROUNDS = 5
DIM = 64
SCALE = 256
SEED = "2"
MAX_COMPONENT = 1 << 26
BLOCK = 8192            # vectors whose distances are summed at once


def integers(vectors: DataFrame, *, dim: int = DIM, scale: int = SCALE, id_col: str = "vec_id",
             vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)``: ``floor(scale * x)`` of the vectors that are kept."""
    v = F.col("v")
    whole = columns(vectors, vec_id=id_col, v=F.col(f"`{vector_col}`").cast("array<double>"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    size = F.lit(float(MAX_COMPONENT))

    def floor(x):
        y = F.floor(x * F.lit(float(scale)))
        return F.when(F.abs(x * F.lit(float(scale))) <= size, y.cast("int")).otherwise(
            F.raise_error(F.concat(F.lit(f"component beyond {MAX_COMPONENT} / {scale}: "), x.cast("string"))))

    return whole.where((F.size("v") == dim) & finite).select("vec_id", F.transform(v, floor).alias("v"))


def tabulated(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The squared differences of the values of one dimension from every
    centroid, and the row of each vector in that table."""
    low, high = int(x.min()), int(x.max())
    if high - low < 4 * len(x) + 1024:
        at = x - low
        occurs = np.zeros(high - low + 1, dtype=bool)
        occurs[at] = True
        values, at = np.flatnonzero(occurs) + low, (np.cumsum(occurs) - 1)[at]
    else:
        values, at = np.unique(x, return_inverse=True)
    return (values.astype(np.int64)[:, None] - centroids[None, :]) ** 2, at


def nearest(block: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of every row; ties to the smaller cluster."""
    distance = np.zeros((len(block), len(centroids)), dtype=np.int64)
    for d in range(block.shape[1]):
        table, at = tabulated(block[:, d], centroids[:, d])
        distance += table[at]
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(block)), cluster]


def _blocks(batch: pa.RecordBatch, dim: int):
    """(first row, vectors) of a batch's runs of at most ``BLOCK`` rows."""
    v = batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(-1, dim)
    for at in range(0, len(v), BLOCK):
        yield at, v[at:at + BLOCK]


def _moved(ints: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: assign, then the floor of every non-empty cluster's mean."""
    k, dim = centroids.shape

    def run(batches):
        n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dim), dtype=np.int64)
        for batch in batches:
            for _, block in _blocks(batch, dim):
                cluster, _ = nearest(block, centroids)
                member = (cluster[:, None] == np.arange(k)).astype(np.float64)
                n += member.sum(axis=0).astype(np.int64)
                # whole numbers below 2**53, so the product is exact
                sums += (member.T @ block.astype(np.float64)).astype(np.int64)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(n[some]), *[pa.array(sums[some, d]) for d in range(dim)]],
            ["c", "n", *[f"s{d}" for d in range(dim)]])

    sums = [f"s{d}" for d in range(dim)]
    parts = ints.select("v").mapInArrow(run, ", ".join(f"{c} bigint" for c in ["c", "n", *sums]))
    rows = parts.groupBy("c").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums]).collect()
    out = centroids.copy()
    for row in rows:            # one row a cluster
        out[row["c"]] = [row[s] // row["n"] for s in sums]
    return out


def _assigned(ints: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(vec_id, cluster, distance)``."""
    schema = T.StructType([ints.schema["vec_id"], T.StructField("cluster", T.IntegerType()),
                           T.StructField("distance", T.LongType())])
    dim = centroids.shape[1]

    def run(batches):
        for batch in batches:
            for at, block in _blocks(batch, dim):
                cluster, distance = nearest(block, centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(block)), pa.array(cluster.astype(np.int32)),
                     pa.array(distance)], ["vec_id", "cluster", "distance"])

    return ints.mapInArrow(run, schema)


def centroid_clustering(vectors: DataFrame, *, k: int = K, rounds: int = ROUNDS, dim: int = DIM,
                        scale: int = SCALE, seed: str = SEED, id_col: str = "vec_id",
                        vector_col: str = "embedding", scratch: Scratch | None = None) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every kept vector.

    Centroids start as the ``k`` vectors of smallest SHA-256 of ``seed:id``.
    """
    spark = vectors.sparkSession
    ship(spark)
    scratch = scratch or Scratch(spark)
    ints = scratch.keep(integers(vectors, dim=dim, scale=scale, id_col=id_col, vector_col=vector_col), "integers")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = ints.select(drawn.alias("h"), "v").orderBy("h", "v").limit(k).collect()   # k rows
    centroids = np.array([r["v"] for r in first], dtype=np.int64).reshape(-1, dim)
    if first:
        for _ in range(rounds):
            centroids = _moved(ints, centroids)
        rows = scratch.keep(_assigned(ints, centroids), "assigned")
    else:
        rows = ints.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
    spread = rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()   # a row a cluster
    inertia = sum(r["s"] for r in spread)
    named = [(r["cluster"], r["s"], inertia,
              hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest())
             for r in spread]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia bigint, inertia bigint, "
                                         "centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
