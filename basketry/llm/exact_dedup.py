"""Exact dedup: binary-fuse filters per snapshot, byte checks, batch groups.

A snapshot is an immutable set of documents that were deduplicated before. Of
it are written: an exact table ``(bucket, digest, keep_id, n)`` with one row
per distinct normalised text (A-Z lower-cased, SHA-256), and one static 3-wise
binary-fuse filter per bucket of digests. An incoming batch is first grouped
by digest on its own (its own duplicates meet in a partial aggregation, so a
text that makes up a third of all rows is one row per task). Its distinct
digests then meet the filter of their bucket; only those that pass join the
exact table. The texts of every group are last compared byte by byte.

Filters travel to the digests of their bucket, never to the driver and never
whole to a task. The number of buckets follows the number of digests, which
are uniform, so a bucket stays near ``BUCKET_DIGESTS`` of either part.

Rows: null text counts as empty, empty texts are equal to each other, repeated
rows (same id) count each and all rows of the largest id stay, a null id is
below any other, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.membership import maybe_in
from basketry.llm.common import Scratch, documents, ship

BUCKET_DIGESTS = 100_000
HASHES = 3


# ---- the filter ---------------------------------------------------------------

def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser; ``seed`` makes another hash of the same keys."""
    with np.errstate(over="ignore"):
        h = keys ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def _layout(n: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of start segments for n keys."""
    if n <= 1:
        return 4, 1
    length = 1 << min(18, int(np.floor(np.log(n) / np.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    starts = max(1, int(np.ceil(n * factor / length)) - (HASHES - 1))
    return length, starts


def _slots(h: np.ndarray, length: int, starts: int) -> np.ndarray:
    """Three slots in consecutive segments, shape (3, n)."""
    first = ((h >> np.uint64(32)) * np.uint64(starts * length)) >> np.uint64(32)
    low = np.uint64(length - 1)
    second = (first + np.uint64(length)) ^ ((h >> np.uint64(18)) & low)
    third = (first + np.uint64(2 * length)) ^ (h & low)
    return np.stack([first, second, third]).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFFFF)).astype(np.uint16)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """``(seed, segment_length, starts, table)`` of distinct unsigned keys.

    Peeling by rounds: all slots that one key alone uses are peeled at once;
    the table is filled in the reverse order of the rounds.
    """
    keys = np.unique(np.asarray(keys, np.uint64))
    length, starts = _layout(len(keys))
    for seed in range(200):
        h = _mix(keys, seed)
        slots = _slots(h, length, starts)
        size = length * (starts + HASHES - 1)
        degree = np.bincount(slots.ravel(), minlength=size).astype(np.int32)
        owner = np.zeros(size, np.int64)            # xor of the key numbers in a slot
        numbers = np.arange(len(keys), dtype=np.int64)
        for row in slots:
            np.bitwise_xor.at(owner, row, numbers)
        rounds, left = [], len(keys)
        front = np.flatnonzero(degree == 1)
        while len(front):
            who, at = np.unique(owner[front], return_index=True)
            where = front[at]
            rounds.append((who, where))
            left -= len(who)
            touched = slots[:, who]
            for row in touched:
                np.subtract.at(degree, row, 1)
                np.bitwise_xor.at(owner, row, who)
            near = np.unique(touched)
            front = near[degree[near] == 1]
        if left == 0:
            table = np.zeros(size, np.uint16)
            prints = _prints(h)
            for who, where in reversed(rounds):
                a, b, c = table[slots[:, who]]
                table[where] = prints[who] ^ a ^ b ^ c   # its own slot is still zero
            return seed, length, starts, table.tobytes()
        if seed % 20 == 19:
            starts += max(1, starts // 10)
    raise RuntimeError("no seed gives a peelable filter")


def probe(keys: np.ndarray, seed: int, length: int, starts: int, table: bytes) -> np.ndarray:
    """Whether each key may be in the filter; never False for one that is."""
    h = _mix(np.asarray(keys, np.uint64), seed)
    a, b, c = np.frombuffer(table, np.uint16)[_slots(h, length, starts)]
    return (a ^ b ^ c) == _prints(h)


# ---- Spark --------------------------------------------------------------------

def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest)``: SHA-256 of the normalised text, as lowercase hex."""
    return documents(docs, id_col, text_col).select("doc_id", F.sha2(normalised("text"), 256).alias("digest"))


def normalised(text: str) -> Column:
    """A text with A-Z lower-cased; null is empty."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")


def _bucketed(groups: DataFrame, n_buckets: int) -> DataFrame:
    """Adds the 64-bit filter key of a digest and its bucket."""
    key = F.conv(F.substring("digest", 1, 15), 16, 10).cast("bigint")
    return groups.withColumn("key", key).withColumn("bucket", F.col("key") % F.lit(n_buckets))


def snapshot(rows: DataFrame, scratch: Scratch, name: str = "snapshot",
             bucket_digests: int = BUCKET_DIGESTS, incoming: int = 0) -> tuple[DataFrame, DataFrame, int]:
    """Exact table, filters and number of buckets of ``(doc_id, digest)`` rows.

    A bucket holds about ``bucket_digests`` digests at most, of the snapshot and
    of ``incoming`` others, so a small snapshot does not bring a batch together.
    """
    ship(rows.sparkSession)
    groups = scratch.keep(
        rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")),
        f"{name}-groups")
    n_buckets = 1 + max(groups.count(), incoming) // bucket_digests
    exact = _bucketed(groups, n_buckets)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, length, starts, table = build_filter(pdf["key"].to_numpy(np.uint64))
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "seed": [seed],
                             "length": [length], "starts": [starts], "filter": [table]})

    filters = scratch.keep(
        exact.select("bucket", "key").groupBy("bucket").applyInPandas(
            build, "bucket bigint, seed int, length int, starts int, filter binary"),
        f"{name}-filters")
    return exact, filters, n_buckets


def screen(groups: DataFrame, filters: DataFrame, n_buckets: int) -> DataFrame:
    """``groups`` whose digest passes the snapshot's filter of its bucket."""
    incoming = _bucketed(groups, n_buckets)

    def look(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return left[["digest"]].iloc[:0]
        f = right.iloc[0]
        hit = probe(left["key"].to_numpy(np.uint64), int(f["seed"]), int(f["length"]),
                    int(f["starts"]), f["filter"])
        return left.loc[hit, ["digest"]]

    return (incoming.select("bucket", "digest", "key").groupBy("bucket")
            .cogroup(filters.groupBy("bucket")).applyInPandas(look, "digest string"))


def exact_dedup(docs: DataFrame, in_snapshot, *, bucket_digests: int = BUCKET_DIGESTS,
                scratch: Scratch | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256, in_snapshot)`` of every row.

    ``in_snapshot`` is a boolean Column over ``doc_id``: those rows make up the
    earlier snapshot, the others are the incoming batch. The row with the
    largest id of a group of equal texts stays, in whichever part it is.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    rows = scratch.keep(
        digests(docs, id_col, text_col).withColumn("old", F.coalesce(in_snapshot, F.lit(False))),
        "digests")
    batch = scratch.keep(
        rows.where(~F.col("old")).groupBy("digest").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")), "batch-groups")
    exact, filters, n_buckets = snapshot(rows.where("old"), scratch, bucket_digests=bucket_digests,
                                         incoming=batch.count())
    maybe = screen(batch, filters, n_buckets)
    # positives join the exact bucket table; false positives fall out here
    both = (batch.join(maybe, "digest", "left_semi")
            .join(exact.select("digest", F.col("keep_id").alias("old_id"), F.col("n").alias("old_n")),
                  "digest"))
    across = scratch.keep(
        both.select("digest", F.greatest("keep_id", "old_id").alias("keep_id"),
                    (F.col("n") + F.col("old_n")).alias("n")), "across")
    within = (batch.unionByName(exact.select("digest", "keep_id", "n")).where("n > 1")
              .join(across, "digest", "left_anti"))
    groups = scratch.keep(across.unionByName(within), "groups")

    members = scratch.keep(rows.join(groups, "digest"), "members")
    _check_bytes(documents(docs, id_col, text_col), members)
    single = (rows.join(groups.select("digest"), "digest", "left_anti")
              .select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("n"),
                      "digest", "old"))
    return (members.select(*single.columns).unionByName(single)
            .select("doc_id", "keep_id", F.col("n").cast("bigint").alias("group_size"),
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("digest").alias("text_sha256"), F.col("old").alias("in_snapshot")))


def _check_bytes(docs: DataFrame, members: DataFrame) -> None:
    """Compare the normalised texts of every group of two or more rows.

    The texts of one digest are equal if the smallest is the largest, which a
    partial aggregation finds: each task passes on two texts a digest, however
    many copies it has. A bitmap of the members' ids keeps most other texts
    out. Unequal texts of one SHA-256 stop the run.
    """
    texts = maybe_in(docs, members, "doc_id").select(normalised("text").alias("norm"))
    wrong = (texts.groupBy(F.sha2("norm", 256).alias("digest"))
             .agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
             .where("low <> high").agg(F.count(F.lit(1)).alias("n")).first()["n"])
    if wrong:
        raise RuntimeError("two different texts share a SHA-256 digest")
