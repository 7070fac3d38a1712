"""MinHash near-dedup by a chosen-path set similarity join.

A document's set is its distinct word shingles (as 64-bit hashes); equal sets
form one class, and everything below works on classes. A class has ``TOKENS``
minwise tokens: one of them is the same in two classes with probability equal
to the Jaccard similarity of their sets.

The tree (after Christiani, Pagh and Sivertsen, "Scalable and robust set
similarity join", 2018). A tree's root chooses two of the tokens and every class
goes down both branches, to the nodes its tokens name; two classes share a node
if they share the token. A node of at most ``SMALL`` classes is compared
exhaustively. A larger one chooses two more tokens, by a hash of its path, and
is branched on, so unlike classes part on the way. With two branches a level
and similarity s, a tree misses a pair with probability f, ``f = (1 - s (1 -
f))**2``, at most 1/16 at 0.8 however deep it grows; independent trees, over
other tokens, are repeated until ``f**trees`` is under the target. What is still
large when the tokens are used up is dealt as tiles, every pair of which is one
task's work, so no node is left out.

Before full sets are fetched, a pair must pass its sizes, and two bits of each
token (``MAX_DIFFER`` of 64 places may differ, which a pair at the threshold
exceeds with probability 1.5e-7). What a node yields are not the pairs that
pass but links that span their components, so it yields a row a class at most,
however alike its classes are; a node whose classes are all in one component
already (in a large node every class is first compared with the pivot, the node's
smallest class) is finished and not branched on. A component of these links, a
suspect group, holds every pair that can link.

Links are confirmed on full sets, rebuilt from one text of each suspect class.
The sets of a group meet in one task, each once; there pairs that pass are
tested, nearest first, unless links confirmed before connect them. A group with
more than ``GROUP_HASHES`` hashes is dealt as tiles like a large node.

Rows: documents without words, empty and null texts have an empty set, link
with nothing and are their own component, equal or not; with fewer words than a
shingle the whole sequence is the one shingle. Repeated rows each give a row;
ties do not arise (the component is the smallest id reachable); a null id is
never the component unless it has no other; an empty table gives no rows; other
columns are ignored. Long texts are taken whole, a row at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.membership import maybe_in
from basketry.llm.common import Scratch, ascii_lower, documents, ship, signed
from basketry.llm.components import components

SHINGLE = 2
PERCENT = 80            # of the union must be in the intersection
RECALL = 1 - 1e-6       # of a pair at the threshold
TOKENS = 64
BRANCHES = 2
POOL = 9                # tokens a level below the root chooses from
SMALL = 1000
MAX_DIFFER = 26
GROUP_ROWS = 20_000     # classes, and hashes of their sets, that a task confirms together
GROUP_HASHES = 4_000_000
PAIRS_AT_ONCE = 1 << 20
HASHES_AT_ONCE = 1 << 15
MAX_WORDS = 500_000     # hashes of words a worker remembers

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_WORDS: dict[bytes, int] = {}


# ---- sets and tokens ------------------------------------------------------------------

def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit words (the finalizer of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Ascending distinct hashes of a text's word shingles."""
    words = ascii_lower(text).split()
    if not words:
        return np.zeros(0, np.uint64)
    try:
        hashes = list(map(_WORDS.__getitem__, words))
    except KeyError:
        if len(_WORDS) > MAX_WORDS:
            _WORDS.clear()
        for w in set(words):
            if w not in _WORDS:
                _WORDS[w] = xxhash.xxh64_intdigest(w)
        hashes = list(map(_WORDS.__getitem__, words))
    w = np.array(hashes, dtype=np.uint64)
    width = min(shingle, len(w))
    h = np.full(len(w) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        h = mixed(h + _GOLDEN) ^ w[i:len(w) - width + 1 + i]
    return np.unique(mixed(h))


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.arange(1, 2 * n + 1, dtype=np.uint64) * _GOLDEN
    m = mixed(i)
    return m[:n], m[n:] | np.uint64(1)


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """``(len(sets), TOKENS)`` 32-bit minwise tokens of non-empty sets."""
    xor, odd = _constants(TOKENS)
    out = np.full((len(sets), TOKENS), 0xFFFFFFFF, dtype=np.uint64)
    sizes = np.array([len(s) for s in sets])
    at, n_sets = 0, len(sets)
    while at < n_sets:
        # as many whole sets as fit, one at least
        to = max(at + 1, at + int(np.searchsorted(np.cumsum(sizes[at:]), HASHES_AT_ONCE, side="right")))
        flat = np.concatenate(sets[at:to])
        starts = np.r_[0, np.cumsum(sizes[at:to])[:-1]]
        for c in range(TOKENS):
            out[at:to, c] = np.minimum.reduceat(((flat ^ xor[c]) * odd[c]) >> np.uint64(32), starts)
        at = to
    return out.astype(np.uint32)


def sketch(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of every token, as two 64-bit words."""
    bits = (tokens & np.uint32(3)).astype(np.uint64)
    place = np.arange(0, 64, 2, dtype=np.uint64)
    return (bits[:, :32] << place).sum(axis=1, dtype=np.uint64), (bits[:, 32:] << place).sum(axis=1, dtype=np.uint64)


def _signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """``(doc_id, seen, key, n, s0, s1, tokens)``; ``key`` names the set."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = batch.column(2)
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                sets = [shingle_set(t, shingle) for t in texts.slice(lo, 500).to_pylist()]
                some = [i for i, s in enumerate(sets) if len(s)]
                tokens = np.zeros((len(sets), TOKENS), np.uint32)
                if some:
                    tokens[some] = minwise([sets[i] for i in some])
                s0, s1 = sketch(tokens)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(signed(s0)), pa.array(signed(s1)),
                     pa.ListArray.from_arrays(np.arange(0, tokens.size + 1, TOKENS, dtype=np.int32),
                                              pa.array(tokens.view(np.int32).ravel()))],
                    ["doc_id", "seen", "key", "n", "s0", "s1", "tokens"])

    return docs.mapInArrow(run, f"doc_id {id_type}, seen bigint, key binary, n bigint, s0 bigint, "
                                "s1 bigint, tokens array<int>")


def _classes(rows: DataFrame) -> DataFrame:
    """One row per set that is not empty: its number ``cls``, its smallest id
    ``low``, its rows ``many``, and (``rep``) one of them by id and text hash."""
    return (rows.where("n > 0").groupBy("key")
            .agg(F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "seen")).alias("rep"),
                 F.count(F.lit(1)).alias("many"), *[F.first(c).alias(c) for c in ("n", "s0", "s1", "tokens")])
            .withColumn("cls", F.monotonically_increasing_id()))


# ---- the tree ---------------------------------------------------------------------------

def trees_for(percent: int, recall: float) -> int:
    """Independent trees that reach ``recall`` for a pair at the threshold."""
    s, f = percent / 100, 0.0
    for _ in range(100):
        f = (1 - s * (1 - f)) ** BRANCHES
    return math.ceil(math.log(1 - recall) / math.log(f))


def _levels(trees: int) -> int:
    """Levels below the roots for which there are tokens."""
    return (TOKENS - trees * BRANCHES) // POOL


def _roots(classes: DataFrame, trees: int) -> DataFrame:
    """Every class in the nodes below all roots: ``BRANCHES`` tokens a tree."""
    path = F.transform(F.sequence(F.lit(0), F.lit(trees * BRANCHES - 1)),
                       lambda c: F.xxhash64(c, F.get("tokens", c)))
    return classes.select("cls", "n", "s0", "s1", F.explode(path).alias("path"))


def _branched(rows: DataFrame, tokens: DataFrame, first: int) -> DataFrame:
    """Rows of large nodes in the children: two of the ``POOL`` tokens from ``first`` on."""
    a = F.pmod(F.col("path"), F.lit(POOL)).cast("int")
    step = F.pmod(F.shiftright("path", 20), F.lit(POOL - 1)).cast("int") + 1
    picks = [F.lit(first) + a, F.lit(first) + F.pmod(a + step, F.lit(POOL))]
    children = F.array(*[F.xxhash64("path", c, F.get("tokens", c)) for c in picks])
    return rows.join(tokens, "cls").withColumn("path", F.explode(children)).drop("tokens")


def _differ(x: Column, y: Column) -> Column:
    odd = F.lit(0x5555555555555555).cast("bigint")
    z = x.bitwiseXOR(y)
    return F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseAND(odd))


def _alike(row: dict[str, Column], other: dict[str, Column], percent: int) -> Column:
    """A pair that sizes and token bits do not rule out."""
    sizes = F.least(row["n"], other["n"]) * 100 >= F.greatest(row["n"], other["n"]) * percent
    return sizes & (_differ(row["s0"], other["s0"]) + _differ(row["s1"], other["s1"]) <= MAX_DIFFER)


def candidates(node: np.ndarray, label: np.ndarray, cls: np.ndarray, n: np.ndarray,
               s0: np.ndarray, s1: np.ndarray, percent: int):
    """Pairs of rows that share a node, differ in label and pass sizes and bits.

    Rows are sorted by ``node``. Yields arrays of rows ``(i, j)`` and of the
    places in which they differ, a bounded number of comparisons at a time.
    """
    stop = np.searchsorted(node, node, side="right")
    count = stop - np.arange(len(node)) - 1
    work = np.cumsum(count)
    odd = np.uint64(0x5555555555555555)
    lo = 0
    while lo < len(node):
        done = work[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(work, done + PAIRS_AT_ONCE, side="right")))
        k = count[lo:hi]
        i = np.repeat(np.arange(lo, hi), k)
        j = np.arange(len(i)) - np.repeat(np.cumsum(k) - k, k) + i + 1
        lo = hi
        keep = label[i] != label[j]
        i, j = i[keep], j[keep]
        keep = np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent
        i, j = i[keep], j[keep]
        differ = np.zeros(len(i), np.uint8)
        for s in (s0, s1):
            z = s[i] ^ s[j]
            differ += np.bitwise_count((z | (z >> np.uint64(1))) & odd)
        keep = differ <= MAX_DIFFER
        if keep.any():
            yield i[keep], j[keep], differ[keep]


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links ``(u, v)`` but the smallest of its component, and that smallest."""
    nodes, at = np.unique(np.r_[u, v], return_inverse=True)
    u, v = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        for end in (u, v, root[u], root[v]):
            np.minimum.at(new, end, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    below = root != np.arange(len(nodes))
    return nodes[below], nodes[root[below]]


def _by_group(rows: DataFrame, keys: list[str], solve, schema: str) -> DataFrame:
    """``solve(table)`` of whole groups, a batch's worth of groups at a time.

    Rows are dealt by ``keys`` and sorted, so a group's rows follow one another.
    """
    def run(batches):
        held: list[pa.Table] = []       # rows of the group that may go on in the next batch

        for b in batches:
            t = pa.Table.from_batches([b])
            if not len(t):
                continue
            ends = np.ones(len(t), bool)
            for k in keys:
                c = t.column(k).to_numpy()
                ends &= c == c[-1]
            cut = len(t) - int(ends[::-1].argmin()) if not ends.all() else 0   # where the last group begins
            if cut == 0:
                if held and any(held[-1].column(k)[-1].as_py() != t.column(k)[0].as_py() for k in keys):
                    yield from solve(pa.concat_tables(held))
                    held = []
                held.append(t)
                continue
            yield from solve(pa.concat_tables([*held, t.slice(0, cut)]))
            held = [t.slice(cut)]
        if held:
            yield from solve(pa.concat_tables(held))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _links_batch(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _compared(rows: DataFrame, percent: int) -> DataFrame:
    """``(u, v)``: links that span the components of an exhaustive comparison of small nodes."""
    def solve(t: pa.Table):
        path, label, cls, n, s0, s1 = (t.column(c).to_numpy() for c in ("path", "label", "cls", "n", "s0", "s1"))
        u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i, j, _ in candidates(path, label, cls, n, s0.view(np.uint64), s1.view(np.uint64), percent):
            u, v = spanning(np.r_[u, label[i]], np.r_[v, label[j]])
        if len(u):
            yield _links_batch(u, v)

    return _by_group(rows.select("path", "label", "cls", "n", "s0", "s1"), ["path"], solve,
                     "u bigint, v bigint").distinct()


def _tiled(rows: DataFrame, small: int) -> DataFrame:
    """Large nodes whose tokens are used up: tiles that hold every pair of them."""
    t = F.ceil(F.col("size") * 2 / small).cast("int")
    mine = F.pmod(F.xxhash64("cls"), t).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), t - 1),
                        lambda o: F.xxhash64("path", F.least(o, mine), F.greatest(o, mine)))
    return rows.withColumn("path", F.explode(tiles))


def _sized(rows: DataFrame) -> DataFrame:
    """Nodes that can still link two components, with their number of rows."""
    return (rows.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("lowest"),
                                     F.max("label").alias("highest"))
            .where("lowest <> highest").select("path", "size"))


# ---- confirmation on full sets ---------------------------------------------------------------

def _sets(need: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """``(cls, hashes)`` of the classes ``need (cls)``, from the text of one row each."""
    reps = need.join(classes.select("cls", "rep"), "cls").select(
        "cls", F.col("rep.doc_id").alias("rep_id"), F.col("rep.seen").alias("seen"))
    texts = maybe_in(docs, reps, "seen").withColumnRenamed("seen", "of")
    found = texts.join(reps, (F.col("of") == F.col("seen")) & F.col("doc_id").eqNullSafe(F.col("rep_id")))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([shingle_set(t, shingle).tobytes()
                                               for t in part.column(1).to_pylist()], pa.binary())],
                    ["cls", "hashes"])

    return found.select("cls", "text").mapInArrow(run, "cls bigint, hashes binary").dropDuplicates(["cls"])


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether ascending distinct arrays have that share of their union in common."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def confirmed(group: np.ndarray, n: np.ndarray, s0: np.ndarray, s1: np.ndarray, sets: list[np.ndarray],
              percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``(u, v)`` whose links span the components of all similar pairs within groups.

    Of the pairs not yet connected, each row's nearest are tested in turn.
    """
    rows = np.arange(len(group))
    root = rows.copy()
    for i, j, differ in candidates(group, rows, rows, n, s0, s1, percent):
        order = np.argsort(differ, kind="stable")
        i, j = i[order], j[order]
        while len(i):
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
            if not len(i):
                break
            test = np.zeros(len(i), bool)
            for end in (i, j):
                test[np.unique(end, return_index=True)[1]] = True
            linked = [similar(sets[x], sets[y], percent) for x, y in zip(i[test].tolist(), j[test].tolist())]
            if any(linked):
                u, v = i[test][linked], j[test][linked]
                below, low = spanning(np.r_[root[u], rows], np.r_[root[v], root])
                root[below] = low
            i, j = i[~test], j[~test]
    below = root != rows
    return rows[below], root[below]


def _confirm(rows: DataFrame, percent: int) -> DataFrame:
    """``(u, v)``: confirmed links of ``rows (root, tile, cls, n, s0, s1, hashes)``."""
    def solve(t: pa.Table):
        root, tile, cls, n, s0, s1 = (t.column(c).to_numpy() for c in ("root", "tile", "cls", "n", "s0", "s1"))
        new = np.r_[True, (root[1:] != root[:-1]) | (tile[1:] != tile[:-1])]
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in t.column("hashes")]
        u, v = confirmed(np.cumsum(new), n, s0.view(np.uint64), s1.view(np.uint64), sets, percent)
        if len(u):
            yield _links_batch(cls[u], cls[v])

    return _by_group(rows.select("root", "tile", "cls", "n", "s0", "s1", "hashes"), ["root", "tile"], solve,
                     "u bigint, v bigint")


# ---- the join ----------------------------------------------------------------------------------

def _suspects(classes: DataFrame, scratch: Scratch, *, percent: int, recall: float, small: int) -> DataFrame:
    """``(cls, root)``: groups of two or more classes that hold every pair that can link."""
    trees = trees_for(percent, recall)
    if trees * BRANCHES > TOKENS:
        raise ValueError(f"{trees} trees need more than {TOKENS} tokens")

    own = ["cls", "n", "s0", "s1"]
    roots = _roots(classes, trees)
    pivots = scratch.keep(roots.groupBy("path").agg(F.count(F.lit(1)).alias("size"),
                                                    F.min(F.struct(*own)).alias("pivot"))
                          .where("size > 1"), "pivots")
    # small nodes are compared; in a large one every class meets the node's pivot first
    rows = scratch.keep(roots.join(pivots, "path").withColumn("label", F.col("cls")), "level-0")
    row, pivot = {c: F.col(c) for c in own}, {c: F.col(f"pivot.{c}") for c in own}
    large = F.col("size") > small
    near = (rows.where(large & (row["cls"] != pivot["cls"]) & _alike(row, pivot, percent))
            .select(pivot["cls"].alias("u"), row["cls"].alias("v")).distinct())
    links = scratch.keep(_compared(rows.where(~large), percent).unionByName(near), "compared-0")
    named = components(links, scratch, "suspects")
    if not pivots.where(large).isEmpty():
        rows = (rows.where(large).drop("pivot", "label", "size")
                .join(named.withColumnRenamed("node", "cls"), "cls", "left")
                .withColumn("label", F.coalesce("root", "cls")).drop("root"))
        more = _deeper(scratch.keep(rows, "large-0"), classes.select("cls", "tokens"), scratch,
                       percent=percent, trees=trees, small=small)
        if more is not None:
            stars = named.select(F.col("node").alias("u"), F.col("root").alias("v"))
            named = components(stars.unionByName(more), scratch, "all-suspects")
    centre = named.select(F.col("root").alias("cls"), "root").distinct()
    return scratch.keep(named.select(F.col("node").alias("cls"), "root").unionByName(centre), "suspects")


def _deeper(rows: DataFrame, tokens: DataFrame, scratch: Scratch, *, percent: int, trees: int,
            small: int) -> DataFrame | None:
    """Links from below large nodes ``rows (path, label, cls, ...)``; None if all are finished."""
    links, depth = None, 0
    while True:
        sized = scratch.keep(_sized(rows), f"sized-{depth}")
        if depth:
            found = scratch.keep(_compared(rows.join(sized.where(F.col("size") <= small), "path"), percent),
                                 f"compared-{depth}")
            links = found if links is None else links.unionByName(found)
        large = sized.where(F.col("size") > small) if depth else sized
        if large.isEmpty():
            return links
        rows = rows.join(large, "path")
        if depth == _levels(trees):
            found = scratch.keep(_compared(_tiled(rows, small), percent), "compared-tiles")
            return found if links is None else links.unionByName(found)
        first = trees * BRANCHES + depth * POOL
        depth += 1
        rows = scratch.keep(_branched(rows, tokens, first).drop("size"), f"level-{depth}")


def _components(classes: DataFrame, docs: DataFrame, scratch: Scratch, *, shingle: int, percent: int,
           recall: float, small: int, group_rows: int, group_hashes: int) -> DataFrame:
    """``(node, root)`` of every class that is not the root of its component."""
    suspects = _suspects(classes, scratch, percent=percent, recall=recall, small=small)
    own = suspects.join(classes.select("cls", "n", "s0", "s1"), "cls")
    # tiles of a group: one, or those of its parts that a row is in
    t = F.greatest(F.lit(1), F.ceil(F.col("many") * 2 / group_rows), F.ceil(F.col("all") * 2 / group_hashes))
    t = F.when((F.col("many") <= group_rows) & (F.col("all") <= group_hashes), F.lit(1)).otherwise(t).cast("bigint")
    groups = scratch.keep(own.groupBy("root").agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("all"))
                          .select("root", t.alias("t")), "suspect-groups")
    own = scratch.keep(own.join(groups, "root"), "suspect-rows")
    mine = F.pmod(F.xxhash64("cls"), F.col("t"))
    tiles = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("t") - 1),
                        lambda o: F.least(o, mine) * F.col("t") + F.greatest(o, mine))
    sets = _sets(own.select("cls"), classes, docs, shingle)
    rows = own.join(sets, "cls").withColumn("tile", F.explode(tiles))
    links = scratch.keep(_confirm(rows, percent), "links")
    if groups.where("t > 1").isEmpty():     # a group met as a whole: its links are stars already
        return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return components(links, scratch)


def chosen_path_dedup(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT,
                      recall: float = RECALL, small: int = SMALL, group_rows: int = GROUP_ROWS,
                      group_hashes: int = GROUP_HASHES, scratch: Scratch | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row."""
    spark = docs.sparkSession
    ship(spark)
    scratch = scratch or Scratch(spark)
    texts = documents(docs, id_col, text_col).withColumn("seen", F.xxhash64("text")).select("doc_id", "seen", "text")
    rows = scratch.keep(_signatures(texts, shingle), "signatures")
    classes = scratch.keep(_classes(rows), "classes")
    roots = _components(classes, texts, scratch, shingle=shingle, percent=percent, recall=recall,
                        small=small, group_rows=group_rows, group_hashes=group_hashes)
    # only classes with company need a look-up; every other row is its own component
    member = classes.select("cls", "key", "low", "many").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    centre = roots.select(F.col("root").alias("cls"), F.lit(True).alias("centre")).distinct()
    member = (member.join(centre, "cls", "left").where("many > 1 or root is not null or centre")
              .select("key", "low", F.coalesce("root", "cls").alias("root")))
    member = scratch.keep(member, "members")
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    named = scratch.keep(member.join(lowest, "root").select("key", "component_id", F.lit(True).alias("any")),
                         "named")
    component = F.when(F.col("any"), F.col("component_id")).otherwise(F.col("doc_id"))
    return (rows.select("doc_id", "key", "n").join(named, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                    F.col("doc_id").eqNullSafe(component).alias("kept")))
