"""Benchmark decontamination by winnowing.

Item and document words are hashed, k-grams of them get a rolling hash, and of
every ``w`` consecutive k-grams the one with the smallest hash is kept, with
``k + w - 1 = window``: two texts that share ``window`` words in a row share a
kept fingerprint, so no shared span of that length is missed. Items shorter
than a window are one window of their own length, whose fingerprint is the
hash of all its words; documents are fingerprinted densely at those lengths.

Document fingerprints first meet a bitmap of the benchmark's, of fixed size
whatever the benchmark's; what passes joins the benchmark windows on the
fingerprint, the hit is extended to the window's full length and compared word
by word. Overlapping windows merge to spans by a running maximum over each
document's hits, so long shared passages cost a row per window at most.

Rows: null text has no words, a document without words is clean; repeated rows
are judged each; equal windows of several items count for each of the items;
an empty benchmark leaves every document clean, an empty ``docs`` gives no
rows; other columns are ignored. Items with a null id contaminate, but cannot
be listed or counted as items.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import Scratch, columns, documents, ship, signed

WINDOW = 10
BITMAP_BITS = 24            # 2 MB
BLOCK_CHARS = 4_000_000

_KEEP = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
_WORDS = bytes(c if c in _KEEP else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and all non-ASCII characters."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def grams(hashes: np.ndarray, k: int, length: int) -> np.ndarray:
    """Hash of each k-gram; ``length``, the window length served, is mixed in."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        g = hashes[:n].copy()
        for j in range(1, k):
            g *= np.uint64(0x9E3779B97F4A7C15)
            g += hashes[j:j + n]
        g ^= np.uint64(length * 0xD6E8FEB86659FD93 % 2**64)
        g ^= g >> np.uint64(32)
        g *= np.uint64(0xD6E8FEB86659FD93)
        g ^= g >> np.uint64(29)
    return g


def sliding_min(g: np.ndarray, w: int) -> np.ndarray:
    n = len(g) - w + 1
    low = g[:n].copy()
    for j in range(1, w):
        np.minimum(low, g[j:j + n], out=low)
    return low


def shape(window: int, length: int) -> tuple[int, int]:
    """``(k, w)`` for windows of ``length`` words."""
    if length < window:
        return length, 1
    k = max(1, window // 2)
    return k, window - k + 1


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, *, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """``(item_id, len, h, at, words)``: each window, its fingerprint and the
    place of that k-gram in it."""
    ship(benchmark.sparkSession)
    rows = columns(benchmark, item_id=id_col, text=text_col)
    id_type = rows.schema["item_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text)
                if not words:
                    continue
                length = min(window, len(words))
                k, w = shape(window, length)
                g = grams(word_hashes(words), k, length)
                low = sliding_min(g, w)
                at = np.zeros(len(low), np.int64)
                for j in range(w):
                    at[g[j:j + len(low)] == low] = j
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(low), b.schema.field(0).type),
                     pa.array([length] * len(low), pa.int32()), pa.array(signed(low)),
                     pa.array(at, pa.int32()),
                     pa.array([b" ".join(words[s:s + length]).decode("utf-8", "surrogatepass")
                               for s in range(len(low))], pa.string())],
                    ["item_id", "len", "h", "at", "words"])

    return rows.mapInArrow(run, f"item_id {id_type}, len int, h bigint, at int, words string")


def _bitmap(windows: DataFrame) -> np.ndarray:
    """Bits of the fingerprints present; at most 2^BITMAP_BITS / 64 rows arrive."""
    bit = F.col("h").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1).cast("bigint"))
    rows = (windows.select(F.shiftright(bit, 6).alias("word"),
                           F.expr(f"shiftleft(1L, cast((h & {(1 << BITMAP_BITS) - 1}) % 64 as int))")
                           .alias("bits"))
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).collect())
    table = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for r in rows:
        table[r["word"]] = r["bits"]
    return table.view(np.uint64)


def _in_bitmap(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h & np.uint64((1 << BITMAP_BITS) - 1)
    return (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)) == 1


def candidates(docs: DataFrame, lengths: list[int], table, window: int = WINDOW) -> DataFrame:
    """``(row, doc_id, n_words, hits)``: kept fingerprints that pass the bitmap,
    with the words around them that a window may cover."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    hit_type = "array<struct<len:int,h:bigint,pos:int,left:int,around:string>>"

    def block(words: list[bytes], counts: np.ndarray, bits: np.ndarray):
        hashes = word_hashes(words)
        ends = np.cumsum(counts)
        starts = ends - counts
        found: list[list] = [[] for _ in counts]
        for length in lengths:
            k, w = shape(window, length)
            g = grams(hashes, k, length)
            if not len(g):
                continue
            if w > 1 and len(g) >= w:
                for e in ends[ends < len(hashes)]:     # k-grams across documents are never kept
                    g[max(0, e - k + 1):e] = ~np.uint64(0)
                low = sliding_min(g, w)
                kept = np.zeros(len(g), bool)
                for j in range(w):
                    kept[j:j + len(low)] |= g[j:j + len(low)] == low
                at = np.flatnonzero(kept)
            else:
                at = np.arange(len(g))
            at = at[_in_bitmap(bits, g[at])]
            doc = np.searchsorted(ends, at, "right")
            side = length - k
            for p, d in zip(at.tolist(), doc.tolist()):
                lo, hi = max(p - side, int(starts[d])), min(p + k + side, int(ends[d]))
                if p + k <= hi and hi - lo >= length:
                    found[d].append({
                        "len": length, "h": int(g[p].astype(np.int64)), "pos": p - int(starts[d]),
                        "left": p - lo, "around": b" ".join(words[lo:hi]).decode("utf-8", "surrogatepass")})
        return found

    def run(batches):
        bits = table.value
        row = TaskContext.get().partitionId() << 33
        hit_arrow = pa.list_(pa.struct([("len", pa.int32()), ("h", pa.int64()), ("pos", pa.int32()),
                                        ("left", pa.int32()), ("around", pa.string())]))
        for b in batches:
            ids, text = b.column(0), b.column(1).to_pylist()
            lo = 0
            while lo < len(text):
                words, counts, chars = [], [], 0
                while lo + len(counts) < len(text) and chars < BLOCK_CHARS:
                    t = text[lo + len(counts)]
                    chars += len(t or "")
                    own = words_of(t)
                    counts.append(len(own))
                    words += own
                n = len(counts)
                found = block(words, np.array(counts, np.int64), bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row, row + n), pa.int64()), ids.slice(lo, n),
                     pa.array(counts, pa.int64()), pa.array(found, hit_arrow)],
                    ["row", "doc_id", "n_words", "hits"])
                row += n
                lo += n

    return docs.mapInArrow(run, f"row bigint, doc_id {id_type}, n_words bigint, hits {hit_type}")


def shared_spans(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW,
                 scratch: Scratch | None = None, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text"):
    """``(rows, hits, items)`` as written tables.

    ``rows (row, doc_id, n_words)`` has every input row under a number of its
    own; ``hits (row, start, len, window_id)`` every window that occurs, in
    words; ``items (window_id, item_id)`` the items a window comes from.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    found = scratch.keep(benchmark_windows(benchmark, window, id_col=item_id_col,
                                           text_col=item_text_col), "item-windows")
    windows = scratch.keep(found.select("len", "h", "at", "words").distinct()
                           .withColumn("window_id", F.monotonically_increasing_id()), "windows")
    items = scratch.keep(found.join(windows, ["len", "h", "at", "words"])
                         .select("window_id", "item_id").distinct(), "window-items")
    lengths = sorted(r["len"] for r in windows.select("len").distinct().collect())  # at most `window`
    rows = scratch.keep(candidates(documents(docs, id_col, text_col), lengths,
                                   sc.broadcast(_bitmap(windows)), window), "candidates")
    hit = rows.where(F.size("hits") > 0).select("row", F.explode("hits").alias("c")).select("row", "c.*")
    first = F.col("left") - F.col("at")
    here = F.array_join(F.slice(F.split("around", " "), first + 1, F.col("len")), " ")
    hits = (hit.join(windows, ["len", "h"]).where(first >= 0).where(here == F.col("words"))
            .select("row", (F.col("pos") - F.col("at")).alias("start"), "len", "window_id").distinct())
    return rows.select("row", "doc_id", "n_words"), scratch.keep(hits, "hits"), items


def contamination(docs: DataFrame, benchmark: DataFrame, *, scratch: Scratch | None = None,
                  **options) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items, contaminated)`` of every row.

    ``n_hit`` counts the words inside any shared window, ``items`` is the
    sorted list of the ids (as strings) of the items that have one.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    rows, hits, items = shared_spans(docs, benchmark, scratch=scratch, **options)
    end = F.col("start") + F.col("len")
    before = Window.partitionBy("row").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0)))
    n_hit = (hits.select("row", "start", "len").distinct()
             .select("row", F.greatest(end - reach, F.lit(0)).alias("new"))
             .groupBy("row").agg(F.sum("new").cast("bigint").alias("n_hit")))
    listed = (hits.select("row", "window_id").distinct().join(items, "window_id")
              .where("item_id is not null").select("row", F.col("item_id").cast("string").alias("item"))
              .distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items")))
    return (rows.join(n_hit, "row", "left").join(listed, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                    F.coalesce(F.array_size("items").cast("bigint"), F.lit(0).cast("bigint")).alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.col("n_hit").isNotNull().alias("contaminated")))
