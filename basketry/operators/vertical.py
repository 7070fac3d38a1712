"""Vertical classes: bitmaps of transactions per item, for dense data.

A horizontal class row holds one transaction, so a candidate costs one row per
transaction that has it. Where most transactions hold many of the frequent
items, bits are smaller and faster (Zaki 2000, "Scalable algorithms for
association mining"): transactions are numbered, ``RANGE`` of them make up a
range, and a vertical class row is one range and prefix:

    (range, i1..i{k-2}, items, bits)

``items`` are those of the tail that occur in the range, ``bits`` has one bitmap
of the range's transactions per item: who holds the prefix and it. A candidate
prefix + y + x is the AND of two of them, its count in the range the number of
bits left, so a level's rows are sums per range and candidate, whatever the
number of transactions. An item that no transaction of the range has is left
out, so empty parts take no room.

Ranges follow the written baskets' rows within a task, so building the bitmaps
needs no exchange; classes of a later level are dealt out by their work like the
horizontal ones. Only distinct counting is done here: bag supports weigh every
transaction by its first item.

Rows: a transaction without frequent items only takes a number; ties and
repeated transactions are counted like any other; no baskets give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import ship

RANGE = 1 << 13         # transactions of a range, a multiple of 64
MAX_TAKEN = 4           # items taken from a tail that :func:`bound` speaks of
MIN_DENSITY = 1 / 32    # share of (transaction, frequent item) cells from which bits are smaller


def is_dense(n_pairs: int, n_transactions: int, n_items: int) -> bool:
    """Whether bitmaps of the frequent items take less room than their pairs."""
    return n_items > 0 and n_pairs >= MIN_DENSITY * n_transactions * n_items


def _cols(k: int) -> list[str]:
    return [f"i{j}" for j in range(1, k + 1)]


def class_schema(item: T.DataType, k: int) -> T.StructType:
    """Classes of level k: a prefix of k - 2 items."""
    return T.StructType([
        T.StructField("range", T.LongType()), *[T.StructField(c, item) for c in _cols(k - 2)],
        T.StructField("items", T.ArrayType(item)), T.StructField("bits", T.BinaryType())])


def _arrow(item: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(item)


def first_classes(baskets: DataFrame, item: T.DataType) -> DataFrame:
    """Classes of level 2 from ``baskets (items)``, each ascending and distinct."""
    kind, size = _arrow(item), RANGE
    ship(baskets.sparkSession)

    def bitmaps(place: np.ndarray, values: list, number: int) -> tuple:
        known = sorted(set(values))
        code = {v: i for i, v in enumerate(known)}
        cells = np.zeros((len(known), size), bool)
        cells[np.fromiter(map(code.__getitem__, values), np.int64, len(values)), place] = True
        return number, known, np.packbits(cells, axis=1, bitorder="little").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        places, values, filled = [], [], 0

        def row():
            n, known, bits = bitmaps(np.concatenate(places), values, number)
            return pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([known], pa.list_(kind)), pa.array([bits], pa.binary())],
                ["range", "items", "bits"])

        for batch in batches:
            lists = batch.column(0)
            at = 0
            while at < len(lists):
                part = lists.slice(at, min(size - filled, len(lists) - at))
                sizes = np.asarray(part.value_lengths().fill_null(0))
                places.append(np.repeat(np.arange(filled, filled + len(part)), sizes))
                values += part.flatten().to_pylist()
                at, filled = at + len(part), filled + len(part)
                if filled == size:
                    if values:
                        yield row()
                    number, places, values, filled = number + 1, [], [], 0
        if values:
            yield row()

    return baskets.select("items").mapInArrow(run, class_schema(item, 2))


def _classes(batch: pa.RecordBatch, k: int) -> Iterator[tuple]:
    """``(range, prefix, items, bits, more)`` of every row, ``bits`` with a row of words an item."""
    columns = [c.to_pylist() for c in batch.columns]
    for row in zip(*columns):
        bits = np.frombuffer(row[k], np.uint64).reshape(len(row[k - 1]), -1)
        yield row[0], row[1:k - 1], row[k - 1], bits, row[k + 1:]


def bound(n_items: int, n_transactions: int) -> dict[str, float]:
    """The most rows that ranges of all transactions yield by the items taken, in all and one."""
    ranges = n_transactions / RANGE + 1
    most = {j: float(math.comb(n_items, j)) for j in range(2, 2 + MAX_TAKEN)}
    return {f"sum{j}": n * ranges for j, n in most.items()} | {f"max{j}": n for j, n in most.items()}


def is_light(n_items: int, rows_per_task: int) -> bool:
    """Whether no range is more than one task's work at level 2."""
    return math.comb(n_items, 2) * (RANGE // 64) <= rows_per_task


def dealt(classes: DataFrame, k: int, rows_per_task: int) -> DataFrame:
    """Classes dealt out by their work: one AND of a pair is a range's words.

    Adds ``part`` and ``parts``, as for horizontal classes.
    """
    n = F.size("items").cast("double")
    parts = F.greatest(F.lit(1), F.least(F.ceil(n * (n - 1) / 2 * (RANGE // 64) / rows_per_task), n - 1)).cast("int")
    width = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (classes.where(F.size("items") >= 2).withColumn("parts", parts)
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .repartition(width, "range", *_cols(k - 2), "part"))


def candidates(classes: DataFrame, k: int, last: int, item: T.DataType) -> DataFrame:
    """``(i1..i{last}, w)``: the candidates of levels ``k`` to ``last`` and their
    count in a range; places beyond a set's size are null. ``classes`` are dealt."""
    kind = _arrow(item)
    names = [*_cols(last), "w"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, prefix, items, bits, (parts, part) in _classes(batch, k):
                found: list[tuple] = []
                # (items of the set, those after its last one, their bitmaps with the set)
                open_ = [((*prefix, items[at]), items[at + 1:], bits[at] & bits[at + 1:])
                         for at in range(part, len(items) - 1, parts)]
                while open_:
                    head, tail, both = open_.pop()
                    count = np.bitwise_count(both).sum(axis=1)
                    some = np.flatnonzero(count)
                    rest = (None,) * (last - len(head) - 1)
                    found += [(*head, tail[i], *rest, int(count[i])) for i in some.tolist()]
                    if len(head) + 1 < last:
                        open_ += [((*head, tail[i]), [tail[j] for j in some[a + 1:].tolist()],
                                   both[i] & both[some[a + 1:]]) for a, i in enumerate(some[:-1].tolist())]
                    if len(found) > 50_000:
                        yield _rows(found, names, kind)
                        found = []
                if found:
                    yield _rows(found, names, kind)

    schema = T.StructType([*[T.StructField(c, item) for c in _cols(last)], T.StructField("w", T.LongType())])
    cols = ["range", *_cols(k - 2), "items", "bits", "parts", "part"]
    return classes.select(*cols).mapInArrow(run, schema)


def _rows(found: list[tuple], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*found))
    return pa.RecordBatch.from_arrays(
        [*[pa.array(c, kind) for c in columns[:-1]], pa.array(columns[-1], pa.int64())], names)


def stepped(classes: DataFrame, level: DataFrame | None, k: int, item: T.DataType) -> DataFrame:
    """Classes of level k + 1: each y of a tail with the items after it.

    ``level (i1..ik)``, broadcast, cuts the tails to the items whose k-set is
    frequent; without it only items that no transaction has go.
    """
    kind = _arrow(item)
    prefix = _cols(k - 1)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *[pa.array(c, kind) for c in columns[1:k]],
             pa.array(columns[k], pa.list_(kind)), pa.array(columns[k + 1], pa.binary())],
            ["range", *prefix, "items", "bits"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, head, items, bits, (parts, part) in _classes(batch, k):
                for at in range(part, len(items) - 1, parts):
                    both = bits[at] & bits[at + 1:]
                    some = np.flatnonzero(both.any(axis=1)).tolist()
                    if some:
                        yield batch_of([(number, *head, items[at], [items[at + 1 + i] for i in some],
                                         both[some].tobytes())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for number, head, items, bits, (frequent,) in _classes(batch, k + 1):
                frequent = set(frequent)
                some = [i for i, x in enumerate(items) if x in frequent]
                if some:
                    rows.append((number, *head, [items[i] for i in some], bits[some].tobytes()))
            if rows:
                yield batch_of(rows)

    cols = ["range", *_cols(k - 2), "items", "bits", "parts", "part"]
    rows = classes.select(*cols).mapInArrow(step, class_schema(item, k + 1))
    if level is None:
        return rows
    frequent = level.groupBy(*prefix).agg(F.collect_set(f"i{k}").alias("next"))
    return (rows.join(F.broadcast(frequent), prefix).select("range", *prefix, "items", "bits", "next")
            .mapInArrow(cut, class_schema(item, k + 1)))
