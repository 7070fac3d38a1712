"""Level-wise frequent-itemset mining on DataFrames.

Set-oriented counting (SETM, Houtsma & Swami 1995) with Apriori candidates
(Agrawal & Srikant 1994), over equivalence classes of sets that share a prefix:

* ``tx(tid, item, m)``  one row per distinct (tid, item), ``m`` its weight.
* a *class* row ``(tid, i1..i{k-2}, w, tail)``: the transaction holds the prefix
  and every item of ``tail``, and each prefix + item is a frequent (k-1)-set;
  ``w`` is the weight of the set's first (smallest) item in the transaction.
* level k: each ``y`` of ``tail`` with the items ``x`` after it gives the
  candidates prefix + y + x, both of whose (k-1)-sets sharing the prefix are
  frequent; ``GROUP BY i1..ik HAVING sum(w) >= threshold`` counts them.
* the classes of level k keep, per (tid, prefix + y), the ``x`` whose k-set is
  frequent: a join with the frequent sets grouped by their prefix.

So a candidate is only counted if the sets it joins are frequent, candidates
are never written (only classes, one row per transaction and prefix), and the
transactions themselves are read once: no level joins them again.

A pass over the classes counts one level or several. Levels are combined when
that is cheap: a bound on the candidates of one level gives one on the next
(Geerts, Goethals & Van den Bussche 2001), taking all candidates for frequent,
and the sizes of the tails say how many rows the levels yield. While the bound
stays under ``COMBINED_SETS`` and the rows under ``COMBINED_ROWS`` a task, the
next level is counted in the same pass, by one aggregate over the sets of all
its levels: a row goes on to longer sets or stops. A superset of an infrequent
set has at most its support, so the result is the same.

Tails are cut before they move. The classes of the next pass are made from
this one's within their tasks: an item of a tail stays if (prefix, item) is
frequent. Sets within the broadcast bounds are looked up by prefix as they are;
beyond, in a bitmap of fixed size that is dealt by prefix into blocks, each row
probing the one block its prefix names. The bitmap may keep an infrequent set,
which the count drops again, but never loses a frequent one. Only then are the
classes dealt out.

The weight rule reproduces the reference's bag counting exactly: there the
id list of a set keeps the duplicates of its first item's id list, so
support(S) = sum over transactions holding S of m(tid, first(S)). With
``m = 1`` everywhere this is the usual distinct support. Both sets of a
candidate's pair keep its first item, so their supports bound the candidate's
in bag mode too.

``prune=True`` also tests the other (k-1)-subsets known to bound the support:
all of them in distinct mode, those that keep the first item in bag mode
(dropping it changes the weights, so bag support is not anti-monotone there).
The tests are semi-joins with the level below; Spark picks their strategy.

Work follows a class's output, not its input: a tail of t items yields
t (t - 1) / 2 candidates, so a class whose tail would yield more than
``rows_per_task`` is split into that many parts, each taking every n-th ``y``,
and classes are dealt over the shuffle partitions by (tid, prefix, part). A huge
transaction thereby becomes many bounded units at every level.

Dense data are mined over bitmaps of transactions instead
(:mod:`basketry.operators.vertical`), by the same passes and the same counting.

The driver sees the numbers taken while tables are written (transactions,
largest basket, sets per level); no job only counts. What a pass finds is
written to the run's workspace, as are the classes of the next, and a note says
which passes are done: plans stay short, a lost executor costs at most one pass,
and ``resume=True`` goes on after the last whole pass without the transactions.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.arrays import support_threshold
from basketry.operators import vertical
from basketry.session import BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, Workspace

DEFAULT_MIN_SUPPORT = 0.3   # fixed: reference default minimum support
DEFAULT_MAX_SIZE = 5        # fixed: reference default largest itemset size
SPARSE_LEVEL = 0.5          # ``prune=None`` prunes when a level holds at most this share of sets
DEFAULT_ROWS_PER_TASK = 1_000_000   # candidates one class row may yield before it is split
COMBINED_SETS = 1_000_000   # candidates of a level that is counted along with the one below
COMBINED_ROWS = 2_000_000   # candidate rows a task may yield in a pass that combines levels
MAX_COMBINED = vertical.MAX_TAKEN   # levels a pass counts at most
BLOCKS_LOG2 = 11            # blocks of the bitmap for sets beyond the broadcast bounds
BLOCK_BITS = 1 << 16        # bits of each: 16 MB in all, whatever the number of sets
NOTE = "passes"


@dataclass
class FrequentItemsets:
    """Mining result: the sets plus the scalars the driver saw."""

    itemsets: DataFrame            # (items ARRAY, k INT, support BIGINT)
    n_transactions: int
    threshold: int
    max_basket: int
    weighted: bool                 # some weight > 1 (bag counting differs)
    level_counts: list[int] = field(default_factory=list)
    workspace: Workspace | None = None
    cached: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        """Free the cached levels and delete the run's written tables.

        ``itemsets`` is unusable afterwards.
        """
        for df in self.cached:
            df.unpersist()
        self.cached.clear()
        if self.workspace is not None:
            self.workspace.drop()


def _cols(k: int) -> list[str]:
    """Column names of a k-set carried flat: ``i1 .. ik`` ascending."""
    return [f"i{j}" for j in range(1, k + 1)]


def _split(classes: DataFrame, k: int, rows_per_task: int) -> DataFrame:
    """Deal classes out by their work.

    Adds ``part`` and ``parts``: a class is copied into as many parts as its
    candidates need, and the rows are spread by (tid, prefix, part).
    """
    n = F.size("tail").cast(T.LongType())
    work = n * (n - 1) / 2
    parts = F.least(F.ceil(work / F.lit(float(rows_per_task))), n - 1).cast(T.IntegerType())
    keys = ["tid", *_cols(k - 2), "part"]
    width = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (classes.where(F.size("tail") >= 2).withColumn("parts", parts)
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .repartition(width, *keys))


def _steps(classes: DataFrame, k: int) -> DataFrame:
    """``(tid, i1..i{k-1}, w, tail)``: each y of a class with the items after it."""
    at = F.explode(F.sequence(F.col("part"), F.size("tail") - 2, F.col("parts"))).alias("at")
    rows = classes.select("*", at)
    # on the first level the weight is that of y itself, later that of i1
    w = F.get("weights", F.col("at")) if k == 2 else F.col("w")
    return rows.select("tid", *_cols(k - 2), F.get("tail", F.col("at")).alias(f"i{k - 1}"),
                       w.alias("w"), F.slice("tail", F.col("at") + 2, F.size("tail")).alias("tail"))


def _keep_frequent(steps: DataFrame, level: DataFrame, k: int, small: bool) -> DataFrame:
    """Classes of level k: tails reduced to the items whose k-set is frequent.

    ``small`` says that the sets are within the broadcast bounds. What is
    broadcast is bounded either way, so the uncut tails do not move.
    """
    prefix = _cols(k - 1)
    if small:
        frequent = level.groupBy(*prefix).agg(F.collect_set(f"i{k}").alias("next"))
        return (steps.join(F.broadcast(frequent), prefix)
                .select("tid", *prefix, "w", F.array_intersect("tail", "next").alias("tail")))
    blocks, words = 1 << BLOCKS_LOG2, BLOCK_BITS // 64
    block = F.pmod(F.xxhash64(*prefix), F.lit(blocks)).cast("int").alias("block")

    def word_and_bit(item: Column | str) -> tuple[Column, Column]:
        at = F.pmod(F.xxhash64(F.lit(k), *prefix, item), F.lit(BLOCK_BITS)).cast("int")
        one = F.lit(1).cast("bigint")
        return F.floor(at / 64).cast("int"), F.call_function("shiftleft", one, at % 64)

    word, bit = word_and_bit(f"i{k}")
    # every word of every block is there, so its place in the array is its number
    empty = level.sparkSession.range(blocks).select(
        F.col("id").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(words - 1))).alias("word"),
        F.lit(0).cast("bigint").alias("bits"))
    bitmap = (level.select(block, word.alias("word"), bit.alias("bits")).unionByName(empty)
              .groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
              .groupBy("block").agg(F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"].alias("bitmap")))

    def member(item: Column) -> Column:
        word, bit = word_and_bit(item)
        return F.get(F.col("bitmap"), word).bitwiseAND(bit) != 0

    return (steps.select("*", block).join(F.broadcast(bitmap), "block")
            .select("tid", *prefix, "w", F.filter("tail", member).alias("tail")))


def _prune(candidates: DataFrame, prev: DataFrame, k: int, weighted: bool) -> DataFrame:
    """Keep candidates whose other bounding (k-1)-subsets are all in ``prev``.

    The two subsets without the last or the last but one item are frequent by
    construction.
    """
    for j in range(1 if weighted else 0, k - 2):
        kept = [c for pos, c in enumerate(_cols(k)) if pos != j]
        keys = prev.select(*[F.col(p).alias(c) for p, c in zip(_cols(k - 1), kept)])
        candidates = candidates.join(keys, kept, "left_semi")
    return candidates


def _worth_pruning(prune: bool | None, n_prev: int, n_possible: int) -> bool:
    """Prune when asked, or (``prune=None``) when level k-1 is sparse.

    If most (k-1)-sets over the frequent items are frequent, almost every
    extension passes the subset test and the probes are wasted work; when
    few are, most extensions fail it and are dropped before counting.
    """
    if prune is not None:
        return prune
    return n_prev <= SPARSE_LEVEL * n_possible


def _candidates(steps: DataFrame, k: int, last: int) -> DataFrame:
    """``(i1..i{last}, w)``, one row per candidate and transaction holding it.

    The candidates have ``k`` to ``last`` items; places beyond a set's size are null.
    """
    none = F.lit(None).cast(steps.schema["tail"].dataType.elementType)
    rows = steps.where(F.size("tail") > 0)
    for j in range(k, last):
        # an item of the tail with those after it or, once the set has k items, none
        first = 0 if j == k else -1
        stops = F.col("at") < 0
        rows = rows.select("*", F.explode(F.sequence(F.lit(first), F.size("tail") - 1)).alias("at")).select(
            *_cols(j - 1), "w", F.when(stops, none).otherwise(F.get("tail", F.col("at"))).alias(f"i{j}"),
            F.when(stops, F.slice("tail", 1, 0)).otherwise(
                F.slice("tail", F.greatest("at", F.lit(0)) + 2, F.size("tail"))).alias("tail"))
    ends = F.col("tail") if last == k else F.concat(F.array(none), F.col("tail"))
    return rows.select(*_cols(last - 1), "w", F.explode(ends).alias(f"i{last}"))


def _baskets(tx: DataFrame, run: _Run) -> None:
    """Write ``items (item, support)`` and ``baskets (tid, pairs)``.

    ``pairs`` are a transaction's ``(item, m, support)`` by item: one row per
    distinct item, so as long as the item universe at most. Supports travel
    along, because the threshold is only known once all transactions are
    counted, which happens while the baskets are written.
    """
    # one row per (tid, item): it makes duplicate or null-keyed input safe
    pairs = run.ws.materialize(
        tx.where(F.col("tid").isNotNull() & F.col("item").isNotNull())
        .groupBy("tid", "item").agg(F.sum("m").cast(T.LongType()).alias("m")), "transactions")
    run.measured(pairs.groupBy("item").agg(F.sum("m").cast(T.LongType()).alias("support")), "items",
                 n=F.count(F.lit(1)))
    basket = F.array_sort(F.collect_list(F.struct("item", "m", "support")))
    baskets = pairs.join(run.table("items"), "item").groupBy("tid").agg(basket.alias("pairs"))
    size = F.aggregate("pairs", F.lit(0).cast("bigint"), lambda n, p: n + p["m"])
    run.measured(baskets, "baskets", n=F.count(F.lit(1)), size=F.max(size),
                 w=F.max(F.array_max(F.col("pairs")["m"])), **_work(F.col("pairs"), F.lit(1)))


def _count_levels(candidates: DataFrame, k: int, last: int, threshold: int) -> DataFrame:
    """``(i1..i{last}, k, support)`` of the frequent candidates."""
    size = F.lit(k)
    for j in range(k + 1, last + 1):
        size = size + F.col(f"i{j}").isNotNull().cast("int")
    return (candidates.groupBy(*_cols(last))
            .agg(F.sum("w").cast(T.LongType()).alias("support"))
            .where(F.col("support") >= F.lit(threshold)).withColumn("k", size))


def next_bound(n: int, k: int) -> int:
    """The most candidates of k + 1 items that ``n`` sets of k items can have.

    ``n`` is written as C(a, k) + C(b, k - 1) + ... with the largest a, then b, ...
    that fit; the bound is the same sum with every lower index one up.
    """
    bound = 0
    while n > 0 and k > 0:
        low, high = k, k + 1
        while math.comb(high, k) <= n:
            low, high = high, 2 * high
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if math.comb(middle, k) <= n else (low, middle)
        n -= math.comb(low, k)
        bound += math.comb(low, k + 1)
        k -= 1
    return bound


def _work(tail: Column, parts: Column) -> dict[str, Column]:
    """Rows that tails yield by the items taken from them: in all, and the most of one part."""
    n = each = F.size(tail).cast("double")
    out = {}
    for j in range(2, 2 + MAX_COMBINED):
        each = each * (n - (j - 1)) / j
        out[f"sum{j}"], out[f"max{j}"] = F.sum(each / parts), F.max(each / parts)
    return out


def _last_level(k: int, k_max: int, n_below: int, work: dict, tasks: int) -> int:
    """The last level to count in the pass that begins with level ``k``.

    ``n_below`` is the number of frequent sets of level k - 1, ``work`` that of
    the classes as :func:`_work` takes it.
    """
    last, bound = k, next_bound(n_below, k - 1)
    rows, most = work["sum2"], work["max2"]
    while last < min(k_max, k + MAX_COMBINED - 1):
        bound = next_bound(bound, last)
        rows += work[f"sum{last - k + 3}"]
        most += work[f"max{last - k + 3}"]
        if bound > COMBINED_SETS or rows > COMBINED_ROWS * tasks or most > COMBINED_ROWS:
            break
        last += 1
    return last


class _Run:
    """What a mining run has written: the passes, the classes, the numbers seen.

    The note is replaced after every table, so it names whole tables only.
    """

    def __init__(self, ws: Workspace, note: dict):
        self.ws, self.note = ws, note
        self.tables: dict[str, DataFrame] = {}
        self.item: T.DataType | None = None
        self.vertical = False       # classes hold bitmaps of transactions

    def measured(self, df: DataFrame, name: str, **metrics: Column) -> dict:
        self.tables[name], seen = self.ws.measured(df, name, **metrics)
        self.note["seen"][name] = {c: v or 0 for c, v in seen.items()}
        self.ws.note(NOTE, json.dumps(self.note))
        return self.note["seen"][name]

    def seen(self, name: str) -> dict | None:
        return self.note["seen"].get(name)

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            self.tables[name] = self.ws.spark.read.parquet(self.ws.location(name))
        return self.tables[name]

    def passes(self) -> list[tuple[int, int]]:
        """(first, last) level of every pass."""
        names = [n.split("-")[1:] for n in self.note["seen"] if n.startswith("sets-")]
        return sorted((int(first), int(last)) for first, last in names)

    def counts(self) -> list[int]:
        """Sets per level, up to the first level without any."""
        out = []
        for first, last in self.passes():
            out += [self.seen(f"sets-{first}-{last}")[f"n{j}"] for j in range(first, last + 1)]
        return out[:out.index(0) + 1] if 0 in out else out

    def count(self, found: DataFrame, first: int, last: int) -> None:
        """Write the frequent sets of levels ``first`` to ``last``."""
        n = {f"n{j}": F.sum((F.col("k") == j).cast("bigint")) for j in range(first, last + 1)}
        size = F.lit(16)
        for c in _cols(last):
            size = size + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + F.lit(8)
        self.measured(found, f"sets-{first}-{last}", **n, bytes=F.sum(size.cast("bigint")),
                      supports=F.sum("support"))

    def level(self, k: int) -> DataFrame:
        """``(i1..ik, support)`` of the frequent k-sets."""
        (first, last), = [p for p in self.passes() if p[0] <= k <= p[1]]
        sets = self.table(f"sets-{first}-{last}")
        return (sets if first == last else sets.where(F.col("k") == k)).select(*_cols(k), "support")

    def small(self, k: int) -> bool:
        """Whether the k-sets are within the broadcast bounds."""
        (first, last), = [p for p in self.passes() if p[0] <= k <= p[1]]
        seen = self.seen(f"sets-{first}-{last}")
        return seen[f"n{k}"] <= DEFAULT_BROADCAST_ROWS and seen["bytes"] <= BROADCAST_BYTES

    def first_classes(self, threshold: int, rows_per_task: int) -> tuple[DataFrame, dict]:
        """The classes of level 2, whose tails are transactions' frequent items, and their work."""
        frequent = F.filter("pairs", lambda p: p["support"] >= threshold)
        baskets = self.table("baskets").select("tid", frequent.alias("pairs"))
        work = self.seen("baskets")
        if self.vertical:
            classes = vertical.first_classes(baskets.select(F.col("pairs")["item"].alias("items")), self.item)
            if vertical.is_light(self.counts()[0], rows_per_task):
                return (classes.withColumns({"part": F.lit(0), "parts": F.lit(1)}),
                        vertical.bound(self.counts()[0], work["n"]))
            return self.dealt(classes, 2, rows_per_task)
        classes = (baskets.select("tid", F.col("pairs")["item"].alias("tail"), F.col("pairs")["m"].alias("weights"))
                   .where(F.size("tail") >= 2))
        if work["max2"] <= rows_per_task:       # no transaction is more than one task's work
            return _whole(classes), work
        return self.dealt(classes, 2, rows_per_task)

    def next_classes(self, k: int, threshold: int, rows_per_task: int) -> tuple[DataFrame, dict]:
        """The classes of level k: those of the last pass, stepped and cut per level it counted."""
        if self.seen(f"classes-{k}") is None:
            first, last = self.passes()[-1]
            classes = (self.first_classes(threshold, rows_per_task)[0] if first == 2
                       else self.table(f"classes-{first}"))
            for j in range(first, last + 1):
                if self.vertical:
                    level = self.level(j) if self.small(j) else None
                    classes = vertical.stepped(classes, level, j, self.item).withColumns(
                        {"part": F.lit(0), "parts": F.lit(1)})
                else:
                    classes = _whole(_keep_frequent(_steps(classes, j), self.level(j), j, self.small(j)))
            return self.dealt(classes.drop("part", "parts"), k, rows_per_task)
        return self.dealt(None, k, rows_per_task)

    def dealt(self, classes: DataFrame | None, k: int, rows_per_task: int) -> tuple[DataFrame, dict]:
        """Classes dealt out and written, unless an earlier run has done so."""
        name = f"classes-{k}"
        if self.seen(name) is None:
            tail = F.col("items" if self.vertical else "tail")
            deal = vertical.dealt if self.vertical else _split
            self.measured(deal(classes, k, rows_per_task), name, **_work(tail, F.col("parts")))
        return self.table(name), self.seen(name)


def _whole(classes: DataFrame) -> DataFrame:
    """Classes that are not dealt out: one part each."""
    return (classes.where(F.size("tail") >= 2)
            .withColumns({"part": F.lit(0), "parts": F.lit(1)}))


def _as_itemsets(level: DataFrame, k: int) -> DataFrame:
    return level.select(F.array(*_cols(k)).alias("items"), F.lit(k).alias("k"), "support")


def frequent_itemsets(tx: DataFrame | None, min_support: float = DEFAULT_MIN_SUPPORT,
                      max_size: int = DEFAULT_MAX_SIZE, *,
                      prune: bool | None = False,
                      rows_per_task: int = DEFAULT_ROWS_PER_TASK,
                      combine: bool = True,
                      layout: str | None = None,
                      workspace: Workspace | None = None,
                      resume: bool = False) -> FrequentItemsets:
    """Mine all sets of at most ``max_size`` items with support >= threshold.

    ``threshold = trunc(n_transactions * min_support)`` (double product);
    sets of two or more items also need a transaction holding them all, so
    the effective threshold is at least 1. Levels stop at the first empty
    one; ``max_size`` is clamped to the largest basket, which cannot change
    the result.

    Inside the loop the prefix of a class travels as flat columns ``i1..``
    (fixed per level), so joins and aggregates hash primitive keys inside
    whole-stage codegen; set arrays are built only for the returned table.

    ``prune`` adds the subset tests described above: ``True`` always,
    ``False`` never, ``None`` per level, when level k-1 holds at most half of
    all possible (k-1)-sets over the frequent items; levels are only combined
    without it. ``rows_per_task`` bounds the candidates of one unit of work,
    ``combine=False`` counts one level a pass. ``layout`` is ``"horizontal"``,
    ``"vertical"`` (see :mod:`basketry.operators.vertical`) or None, which takes
    the vertical one for distinct counting of data whose measured density says
    that it is smaller. None of them changes the result.

    ``resume=True`` continues the run whose folder ``workspace`` reopens, with
    the same parameters, after its last whole table; ``tx`` is read only if that
    run had not yet written its baskets, and may be None otherwise.
    """
    if int(max_size) < 1:
        raise ValueError(f"max_size must be >= 1, got {max_size!r}")
    support_threshold(0, min_support)  # validates min_support
    if layout not in (None, "horizontal", "vertical"):
        raise ValueError(f"layout must be horizontal, vertical or None, got {layout!r}")
    if resume and workspace is None:
        raise ValueError("resume needs the workspace of the run to resume")
    ws = workspace or Workspace(tx.sparkSession)
    spark = ws.spark
    asked = {"min_support": float(min_support), "max_size": int(max_size), "layout": layout}
    note = json.loads((ws.noted(NOTE) if resume else None) or json.dumps({"asked": asked, "seen": {}}))
    if note["asked"] != asked:
        raise ValueError(f"the run to resume was asked for {note['asked']}, not {asked}")
    run = _Run(ws, note)
    if run.seen("baskets") is None:
        _baskets(tx, run)
    seen = run.seen("baskets")
    item_type = run.table("baskets").schema["pairs"].dataType.elementType["item"].dataType
    n, max_basket = int(seen["n"]), int(seen["size"])
    result_schema = T.StructType([
        T.StructField("items", T.ArrayType(item_type)),
        T.StructField("k", T.IntegerType()),
        T.StructField("support", T.LongType()),
    ])
    result = FrequentItemsets(spark.createDataFrame([], result_schema), n, support_threshold(n, min_support),
                              max_basket, int(seen["w"]) > 1, [], ws)
    if n == 0:
        return result
    effective = max(1, result.threshold)
    k_max = min(int(max_size), max_basket)
    if not run.passes():
        frequent = run.table("items").where(F.col("support") >= F.lit(effective))
        run.count(frequent.select(F.col("item").alias("i1"), "support", F.lit(1).alias("k")), 1, 1)

    if layout == "vertical" and result.weighted:
        raise ValueError("bag counting needs the horizontal layout")
    dense = not result.weighted and prune is False and vertical.is_dense(
        run.seen("sets-1-1")["supports"], n, run.counts()[0])
    run.item, run.vertical = item_type, dense if layout is None else layout == "vertical"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while run.counts()[-1] > 0 and (k := run.passes()[-1][1] + 1) <= k_max:
        classes, work = (run.first_classes(effective, rows_per_task) if k == 2
                         else run.next_classes(k, effective, rows_per_task))
        counts = run.counts()
        pruned = k >= 3 and _worth_pruning(prune, counts[-1], math.comb(counts[0], k - 1))
        last = _last_level(k, k_max, counts[-1], work, tasks) if combine and prune is False else k
        candidates = (vertical.candidates(classes, k, last, item_type) if run.vertical
                      else _candidates(_steps(classes, k), k, last))
        if pruned:
            candidates = _prune(candidates, run.level(k - 1), k, result.weighted)
        run.count(_count_levels(candidates, k, last, effective), k, last)

    result.level_counts = run.counts()
    levels = [_as_itemsets(run.level(k), k) for k, n_sets in enumerate(result.level_counts, 1)
              if n_sets or k == 1]
    itemsets = levels[0]
    for lv in levels[1:]:
        itemsets = itemsets.unionByName(lv)
    # rules and reports read the sets more than once; the first use fills the cache
    result.itemsets = itemsets.persist(StorageLevel.MEMORY_AND_DISK)
    result.cached.append(result.itemsets)
    return result


def order_itemsets(itemsets: DataFrame) -> DataFrame:
    """Report order of sets: size, then items compared element-wise."""
    return itemsets.orderBy("k", "items")
