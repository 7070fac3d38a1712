"""SimHash near-dedup over a Gray-order hierarchical index.

A document's fingerprint takes the majority of each bit of the 64-bit hashes
of its word shingles. Two fingerprints link at ``distance`` or fewer differing
bits; a document's class is its component under all links.

The index. The top level factors the masked bit pattern of one block: the 64
bits fall into ``distance + 1`` blocks, and two linked fingerprints agree on
at least one block whole, so routing every distinct fingerprint to the groups
of each of its blocks (accumulated difference zero) loses no link. Within a
group the fingerprints are sorted by Gray rank, which puts equal leading bits
side by side, and nodes of ``FANOUT`` consecutive ones are stacked into a
tree; a node holds the bits all below it share (mask and pattern). Two nodes
are compared on the bits both have fixed: if those alone differ in more than
``distance`` places, every pair below is pruned at once; else their children
are compared, down to the fingerprints. Pairs whose members are already in one
component are skipped. Only a spanning star of each local component leaves the
task, never all pairs, so a group of copies gives one row per member.

Groups larger than ``MAX_GROUP`` are routed once more by blocks of their
remaining bits (again exact), and what is still larger is dealt as tiles, every
pair of which is one task's work.

Rows: null and empty texts have fingerprint zero and link like any other;
repeated rows each give a row; ties do not arise (the class is the smallest id
reachable); an empty table gives no rows; other columns are ignored. A null id
is never the class id unless its class has no other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Scratch, ascii_lower, documents, ship, signed
from basketry.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
FANOUT = 8
MAX_GROUP = 20_000
PAIRS_AT_ONCE = 1 << 18
HASHES_AT_ONCE = 1 << 16


# ---- fingerprints ---------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a whole text (0 without words)."""
    words = ascii_lower(text).split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles, n = iter((b" ".join(words),)), 1
    else:
        n = len(words) - shingle + 1
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    ones = np.zeros(64, np.int64)
    digest, left = xxhash.xxh64_intdigest, n
    while left:
        m = min(left, HASHES_AT_ONCE)
        h = np.fromiter((digest(s, seed) for _, s in zip(range(m), shingles)), np.uint64, m)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
        left -= m
    majority = np.packbits(2 * ones > n, bitorder="little")
    return int.from_bytes(majority.tobytes(), "little")


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE, seed: int = SEED,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, code)``: the fingerprint as a signed long."""
    ship(docs.sparkSession)
    rows = documents(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            codes = np.fromiter((fingerprint(t, shingle, seed) for t in b.column(1).to_pylist()),
                                np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(signed(codes))],
                                             ["doc_id", "code"])

    return rows.mapInArrow(run, f"doc_id {id_type}, code bigint")


# ---- the index within a task ------------------------------------------------------

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = np.asarray(codes, np.uint64).copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _roots(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest label of each component after linking ``a[i]`` with ``b[i]``."""
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return label
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label != (up := label[label])).any():
            label = up


def link_groups(group: np.ndarray, codes: np.ndarray, distance: int = DISTANCE):
    """Local components of distinct ``codes`` within each group.

    ``group`` numbers the rows 0.. in ascending order. Returns ``(codes,
    roots)``: the codes in index order and the first code of their component.
    """
    order = np.lexsort((gray_rank(codes), group))
    group, codes = group[order], codes[order]
    n = len(codes)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    # levels[l] = (start of each node in the level below, stop, mask, pattern)
    levels = [(np.arange(n), np.arange(n) + 1, np.full(n, ~np.uint64(0)), codes)]
    roots = [first[size == 1]]          # node number of each group's root, by level
    at, count = first, size
    while (count > 1).any():
        up_count = -(-count // FANOUT)
        up_at = np.r_[0, np.cumsum(up_count)[:-1]]
        within = np.arange(up_count.sum()) - np.repeat(up_at, up_count)
        start = np.repeat(at, up_count) + within * FANOUT
        stop = np.minimum(start + FANOUT, np.repeat(at + count, up_count))
        _, _, mask, pattern = levels[-1]
        both = np.bitwise_and.reduceat(pattern, start)
        some = np.bitwise_or.reduceat(pattern, start)
        shared = np.bitwise_and.reduceat(mask, start) & ~(both ^ some)
        levels.append((start, stop, shared, both & shared))
        roots.append(up_at[(up_count == 1) & (count > 1)])
        at, count = up_at, up_count
    label = np.arange(n)
    stack = [(l, r, r) for l, r in enumerate(roots) if l and len(r)]
    while stack:
        level, a, b = stack.pop()
        if len(a) > PAIRS_AT_ONCE // (FANOUT * FANOUT) and level:
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        start, stop, _, _ = levels[level]
        if level == 1 and len(a):       # skip leaves whose codes are joined already
            low, high = np.minimum.reduceat(label, start), np.maximum.reduceat(label, start)
            done = (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
            a, b = a[~done], b[~done]
        na, nb = stop[a] - start[a], stop[b] - start[b]
        pair = np.repeat(np.arange(len(a)), na * nb)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
        x, y = start[a][pair] + k // nb[pair], start[b][pair] + k % nb[pair]
        below = level - 1
        _, _, mask, pattern = levels[below]
        keep = (x <= y) if below else (x < y)
        x, y = x[keep], y[keep]
        differ = np.bitwise_count((pattern[x] ^ pattern[y]) & mask[x] & mask[y])
        near = differ <= distance
        x, y = x[near], y[near]
        if not len(x):
            continue
        if below:
            stack.append((below, x, y))
        else:
            label = _roots(label, x, y)
    return codes, codes[label]


# ---- Spark ----------------------------------------------------------------------

def _block(code: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(code, at).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def _edges(distance: int, of: int) -> list[tuple[int, int]]:
    """``(first bit, width)`` of ``distance + 1`` blocks that cover ``of`` bits."""
    cuts = [i * of // (distance + 1) for i in range(distance + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _routed(codes: DataFrame, distance: int, max_group: int, scratch: Scratch) -> DataFrame:
    """``(k1, k2, tile, code)``: every code in each group it must be compared in."""
    code = F.col("code")
    outer = _edges(distance, 64)
    keys = F.array(*[F.struct(F.lit(i).alias("i"), _block(code, a, w).alias("k1"))
                     for i, (a, w) in enumerate(outer)])
    routed = scratch.keep(
        codes.select("code", F.explode(keys).alias("k")).select("code", "k.i", "k.k1"), "routed")
    # blocks have at most 2^ceil(64 / (distance + 1)) values; only the hot ones matter
    hot = routed.groupBy("i", "k1").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > max_group).select("i", "k1", F.lit(True).alias("hot"))
    hot = scratch.keep(hot, "hot-groups")
    none = F.lit(0).cast("bigint")
    if hot.isEmpty():
        return routed.select("i", "k1", none.alias("k2"), none.alias("tile"), "code")
    marked = routed.join(hot, ["i", "k1"], "left")
    cold = marked.where("hot is null").select("i", "k1", none.alias("k2"), none.alias("tile"), "code")
    rest = F.lit(None).cast("bigint")      # the bits outside block i, moved together
    for i, (a, w) in enumerate(outer):
        high = (F.shiftrightunsigned(code, a + w) if a + w < 64 else F.lit(0).cast("bigint"))
        low = _block(code, 0, a) if a else F.lit(0).cast("bigint")
        rest = F.when(F.col("i") == i, F.shiftleft(high, a).bitwiseOR(low)).otherwise(rest)
    inner = _edges(distance, 64 - max(w for _, w in outer))
    inner[-1] = (inner[-1][0], 64 - min(w for _, w in outer) - inner[-1][0])
    sub = F.array(*[(F.lit(j << 32).cast("bigint") + _block(F.col("rest"), a, w) + 1)
                    for j, (a, w) in enumerate(inner)])
    warm = scratch.keep(marked.where("hot").withColumn("rest", rest)
                        .select("i", "k1", F.explode(sub).alias("k2"), "code"), "warm")
    tiles = scratch.keep(
        warm.groupBy("i", "k1", "k2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_group)
        .select("i", "k1", "k2", F.ceil(F.col("n") * 2 / max_group).cast("int").alias("t")), "dense")
    warm = warm.join(tiles, ["i", "k1", "k2"], "left")
    t = F.col("t")
    mine = F.pmod(F.xxhash64("code"), t).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), t - 1), lambda o: (
        F.least(o, mine) * t + F.greatest(o, mine)).cast("bigint"))
    tile = F.when(t.isNull(), F.array(none)).otherwise(pairs)
    return cold.unionByName(warm.select("i", "k1", "k2", F.explode(tile).alias("tile"), "code"))


def links(codes: DataFrame, *, distance: int = DISTANCE, max_group: int = MAX_GROUP,
          scratch: Scratch | None = None) -> DataFrame:
    """``(u, v)``: links that span every component of distinct ``codes (code)``.

    Two codes within ``distance`` bits are connected by the links returned.
    """
    ship(codes.sparkSession)
    scratch = scratch or Scratch(codes.sparkSession)
    routed = _routed(codes, distance, max_group, scratch)
    keys = ["i", "k1", "k2", "tile"]

    def run(batches):
        held: list[np.ndarray] = []     # rows of the group that may go on in the next batch

        def solve(rows: np.ndarray):
            new = (rows[1:, :4] != rows[:-1, :4]).any(axis=1)
            group = np.r_[0, np.cumsum(new)] if len(rows) else np.zeros(0, np.int64)
            codes, roots = link_groups(group, rows[:, 4].copy().view(np.uint64), distance)
            linked = codes != roots
            return pa.RecordBatch.from_arrays(
                [pa.array(signed(codes[linked])), pa.array(signed(roots[linked]))], ["u", "v"])

        for b in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns], 1)
            if not len(rows):
                continue
            last = (rows[:, :4] == rows[-1, :4]).all(axis=1)
            cut = len(rows) - int(np.argmin(last[::-1])) if not last.all() else 0
            if cut == 0:
                if held and (held[-1][-1, :4] != rows[0, :4]).any():
                    yield solve(np.concatenate(held))
                    held = []
                held.append(rows)
                continue
            yield solve(np.concatenate([*held, rows[:cut]]))
            held = [rows[cut:]]
        if held:
            yield solve(np.concatenate(held))

    return (routed.repartition(*keys).sortWithinPartitions(*keys)
            .select(*keys, "code").mapInArrow(run, "u bigint, v bigint"))


def near_dedup(docs: DataFrame, *, shingle: int = SHINGLE, distance: int = DISTANCE,
               seed: int = SEED, max_group: int = MAX_GROUP, scratch: Scratch | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the smallest
    id among the documents reachable over links of ``distance`` or fewer bits.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    rows = scratch.keep(fingerprints(docs, shingle=shingle, seed=seed, id_col=id_col,
                                     text_col=text_col), "fingerprints")
    codes = scratch.keep(rows.groupBy("code").agg(F.min("doc_id").alias("low"),
                                                  F.count(F.lit(1)).alias("n")), "codes")
    roots = components(links(codes.select("code"), distance=distance, max_group=max_group,
                             scratch=scratch), scratch)
    # only codes with company need a look-up; every other row is its own class
    member = codes.join(roots.withColumnRenamed("node", "code"), "code", "left")
    centre = roots.select(F.col("root").alias("code"), F.lit(True).alias("centre")).distinct()
    member = (member.join(centre, "code", "left")
              .where("n > 1 or root is not null or centre")
              .select("code", "low", F.coalesce("root", "code").alias("root")))
    member = scratch.keep(member, "members")
    lowest = scratch.keep(member.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    named = scratch.keep(member.join(lowest, "root").select("code", "component_id", F.lit(True).alias("any")),
                         "classes")
    return (rows.join(named, "code", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("any"), F.col("component_id")).otherwise(F.col("doc_id"))
                    .alias("component_id")))
