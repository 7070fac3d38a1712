"""Token counts: batch encoding in Arrow functions that return lengths only.

Rows: every document gets one output row; null text counts as empty (0 bytes,
0 tokens), repeated rows are counted each, ties do not arise, an empty table
gives an empty result, other columns are ignored. Only ids and lengths leave
the workers. Batches are cut by bytes, not rows, so a run of long texts does
not pile up; long texts are split at safe boundaries (see ``token_pieces``).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from basketry.llm.common import documents, ship
from basketry.llm.token_pieces import byte_blocks, counter

BLOCK_CHARS = 4_000_000


def token_counts(docs: DataFrame, vocabulary: str, *, limit: int = 512,
                 block_chars: int = BLOCK_CHARS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row.

    ``vocabulary`` is the path of a byte-level BPE file every executor can
    read; ``over_limit`` is ``n_tokens > limit``.
    """
    ship(docs.sparkSession)
    rows = documents(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def count(batches):
        pieces = counter(vocabulary)
        for b in batches:
            ids, text = b.column(0), [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in byte_blocks(text, block_chars):
                n = pieces.encode(text[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo),
                     pa.array([len(t.encode("utf-8")) for t in text[lo:hi]], pa.int64()),
                     pa.array(n, pa.int64()),
                     pa.array([x > limit for x in n], pa.bool_())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(
        count, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
