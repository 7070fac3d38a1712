"""Packing: vector bin packing of documents into training sequences.

A document's ids (its tokens and an end id) are cut freely and placed into
sequences under three limits at once: tokens, segments and loss-bearing
tokens. The heuristic is the dot product: for the open sequence, the item is
taken whose demand vector has the largest product with the sequence's
remaining capacities (all as shares of the limits), among the items that fit;
if none fits whole, the best one is cut to fill the sequence exactly.

Packing needs no view of the whole corpus: each task packs the documents of
its own input split with a pool of bounded size, and closes its last sequence
by cutting the rest into sequences whose lengths are powers of two, which take
no padding. So nothing is shuffled, no row is held beyond the pool, and a lost
executor costs the re-run of its splits.

Rows: null text counts as empty and still has the end id; repeated rows are
packed each; ties in the heuristic go to the earlier item; an empty table
gives no rows; other columns are ignored. ``sequence_id`` is the partition
number in the high bits and a running number below, unique within one result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import columns, ship
from basketry.llm.token_pieces import byte_blocks, encoder

MAX_TOKENS = 2048
MAX_SEGMENTS = 256
POOL_TOKENS = 2_000_000
BLOCK_CHARS = 2_000_000
CANDIDATE_CLASSES = 64   # items are pooled by size class; one candidate per class


class Packer:
    """Fills sequences from a pool of items; see the module text.

    An item is ``[key, start, stop, loss_start]``: ids ``start .. stop`` of
    ``key`` are to be placed, those from ``loss_start`` on bear loss. Items are
    pooled by size class and the last one of each class is a candidate, so a
    step looks at a bounded number of items.
    """

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int):
        self.limits = (max_tokens, max_segments, max_loss)
        self.classes: list[list] = [[] for _ in range(CANDIDATE_CLASSES + 1)]
        self.tokens = 0                # in the pool
        self.n = 0                     # sequences closed
        self.left = list(self.limits)  # capacities of the open sequence
        self.offset = 0                # its tokens so far
        self.out: list[tuple] = []     # (key, start, length, sequence, offset)

    def add(self, key, length: int, loss_start: int = 0) -> None:
        self.tokens += length
        self._pool([key, 0, length, min(loss_start, length)])

    def _pool(self, item) -> None:
        tokens = item[2] - item[1]
        self.classes[min(CANDIDATE_CLASSES, tokens * CANDIDATE_CLASSES // self.limits[0])].append(item)

    def _head(self, item) -> int:
        """The longest head of ``item`` that the open sequence still takes."""
        _, a, b, loss = item
        n = min(b - a, self.left[0])
        return n - max(0, a + n - max(a, loss) - self.left[2])

    def step(self) -> bool:
        """Place one piece; False if the pool is empty."""
        tokens, segments, bearing = self.limits
        room = (self.left[0] / tokens ** 2, self.left[1] / segments ** 2, self.left[2] / bearing ** 2)
        best, best_rank = None, (False, -1.0)
        for items in self.classes:
            if items:
                _, a, b, loss = item = items[-1]
                bears = b - max(a, loss)
                product = (b - a) * room[0] + room[1] + bears * room[2]
                whole = b - a <= self.left[0] and bears <= self.left[2]
                rank = (whole, product) if self.left[1] > 1 else (False, self._head(item))
                if rank > best_rank:
                    best, best_rank = items, rank
        if best is None:
            return False
        n = self._head(best[-1])
        if n <= 0:                     # no loss-bearing room left
            self.close()
            return True
        item = best.pop()
        key, a, b, loss = item
        self.out.append((key, a, n, self.n, self.offset))
        self.offset += n
        self.tokens -= n
        self.left[0] -= n
        self.left[1] -= 1
        self.left[2] -= max(0, a + n - max(a, loss))
        if a + n < b:
            item[1] = a + n
            self._pool(item)
        if self.left[0] == 0 or self.left[1] == 0:
            self.close()
        return True

    def drain(self, below: int = 0) -> None:
        while self.tokens > below and self.step():
            pass

    def close(self) -> None:
        """End the open sequence; if it is not full, deal its pieces again into
        sequences whose lengths are powers of two."""
        rest = self.offset
        if not rest:
            return
        if rest < self.limits[0] and rest & (rest - 1):
            mine = []
            while self.out and self.out[-1][3] == self.n:
                mine.append(self.out.pop())
            room, offset, seq = 1 << (rest.bit_length() - 1), 0, self.n
            for key, start, length, _, _ in reversed(mine):
                while length:
                    if room == 0:
                        room, offset, seq = 1 << (rest.bit_length() - 1), 0, seq + 1
                    n = min(length, room)
                    self.out.append((key, start, n, seq, offset))
                    start, length, offset = start + n, length - n, offset + n
                    room, rest = room - n, rest - n
            self.n = seq
        self.n += 1
        self.left, self.offset = list(self.limits), 0

    def finish(self) -> None:
        self.drain()
        self.close()

    def rows(self) -> list[tuple]:
        """Placements in sequences closed since the last call."""
        ready = [p for p in self.out if p[3] < self.n]
        self.out = [p for p in self.out if p[3] >= self.n]
        return ready


def pack(docs: DataFrame, vocabulary: str, *, end_id: int = 1,
         max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
         max_loss_tokens: int | None = None, pool_tokens: int = POOL_TOKENS,
         prompt_tokens_col: str | None = None, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])``.

    One row per piece. ``prompt_tokens_col`` names a column that counts the
    leading tokens of a row that bear no loss (instruction data); without it
    all tokens bear loss. ``max_loss_tokens`` defaults to ``max_tokens``.
    ``with_ids`` adds the piece's ids as an array.
    """
    ship(docs.sparkSession)
    loss = F.lit(0) if prompt_tokens_col is None else F.coalesce(
        F.col(f"`{prompt_tokens_col}`"), F.lit(0))
    rows = columns(docs, doc_id=id_col, text=text_col, prompt=loss.cast("int"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    max_loss = max_loss_tokens or max_tokens
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        pieces = encoder(vocabulary)
        packer = Packer(max_tokens, max_segments, max_loss)
        held: dict[int, list] = {}     # key -> [doc_id, ids, tokens not yet out]
        base = TaskContext.get().partitionId() << 33
        key = 0

        def emit():
            placed = packer.rows()
            if not placed:
                return None
            cols = [[] for _ in names]
            ids_out = []
            for k, start, length, seq, offset in placed:
                doc = held[k]
                part = doc[1][4 * start:4 * (start + length)]
                for c, v in zip(cols, (doc[0], start, length, zlib.crc32(part),
                                       len(doc[1]) // 4, base + seq, offset)):
                    c.append(v)
                if with_ids:
                    ids_out.append(np.frombuffer(part, "<u4").astype(np.int64))
                doc[2] -= length
                if doc[2] == 0:
                    del held[k]
            arrays = [pa.array(cols[0], id_arrow), *[pa.array(c, pa.int64()) for c in cols[1:]]]
            if with_ids:
                arrays.append(pa.array(ids_out, pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

        id_arrow = None
        for b in batches:
            id_arrow = b.schema.field(0).type
            doc_ids, text = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            prompts = b.column(2).to_pylist()
            for lo, hi in byte_blocks(text, BLOCK_CHARS):
                for i, ids in zip(range(lo, hi), pieces.encode(text[lo:hi])):
                    ids += end
                    held[key] = [doc_ids[i], ids, len(ids) // 4]
                    packer.add(key, len(ids) // 4, prompts[i])
                    key += 1
                if packer.tokens > pool_tokens:
                    packer.drain(pool_tokens // 2)
                    if (out := emit()) is not None:
                        yield out
        packer.finish()
        if (out := emit()) is not None:
            yield out

    schema = (f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, "
              "doc_tokens bigint, sequence_id bigint, offset bigint")
    return rows.mapInArrow(run, schema + (", ids array<bigint>" if with_ids else ""))
