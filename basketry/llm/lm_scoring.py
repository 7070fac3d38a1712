"""LM scoring with a probabilistic suffix tree over words.

The tree's states are contexts of one to ``depth`` words. Every string of up to
``depth + 1`` words that occurs ``min_count`` times or more in the training
corpus takes part, whatever the corpus' size. A context becomes a state if a
divergence test holds: for some next symbol, the count departs from what the
next shorter state predicts by a deviance of ``min_deviance`` or more. In a
state the next symbols are smoothed by absolute discounting: what the discount
and the symbols without a count of their own leave goes to the next shorter
state, at last to the smoothed word frequencies, so every state's distribution
sums to one. A token is scored in the state of the longest suffix of the words
before it.

How it is spread. Nothing of the model is held in one place. Documents are
condensed to blocks (a vocabulary and the texts as numbers in it). Level by
level each block asks for the corpus counts of its distinct strings, packed by
range of the key (bucket); a bucket's task adds them up and returns the totals
that the block does not know already. The blocks themselves never move: they are
written by hash of their number, and only questions and replies are exchanged,
whose shuffle files go when a level is written: keys as gaps between sorted
ones, numbers in as many bytes as the largest needs. A string is asked for only if the strings
it extends reach ``min_count``, which its own count never exceeds. One block
of those that have a string (its owner) tells the
bucket of its context whether it is deviant; the bucket decides on the state and
tells every block that asked for this context what its strings hold, so what weight
it leaves to the shorter one. A block so
knows the part of the tree its own texts touch, and scores them. Very common
strings are one entry per block. Blocks, questions and replies are written to
the shared folder; buckets grow in number with the corpus, not in size. Words
and strings are told apart by 64-bit hashes.

Rows: null text counts as empty; an empty text has one token, the end; a null
id is a training row; repeated rows are learned from and scored each; without
training rows every token is unknown; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Scratch, columns, ship

DEPTH = 3
MIN_COUNT = 2
MIN_DEVIANCE = 20.0
DISCOUNT = 0.5
BLOCK_TOKENS = 1_000_000
STRINGS_HELD = 2_000_000  # strings a bucket is asked for, about
END = np.uint64(xxhash.xxh3_64_intdigest(b""))


def _prepared(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = columns(docs, doc_id=id_col, text=text)
    return rows.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))


# ---- numbers -------------------------------------------------------------------------

def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in as many bytes as the largest needs: all lowest bytes first, and so on."""
    wide = np.ascontiguousarray(numbers, "<u8")
    width = max(1, -(-int(wide.max()).bit_length() // 8)) if len(wide) else 1
    return bytes([width]) + wide.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    low = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((low.shape[1], 8), np.uint8)
    out[:, :width] = low.T
    return out.view("<u8").ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys or places: the first, and the gaps."""
    return keys[:1].astype("<u8").tobytes() + _packed(np.diff(keys))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(np.concatenate([np.frombuffer(data, "<u8", 1), _unpacked(data[8:])]), dtype=np.uint64)


def _order(keys: np.ndarray) -> np.ndarray:
    """Stable order of 64-bit keys.

    Sorted are the upper bits of the keys with the places in the lower ones,
    which is several times faster than an argsort; where keys agree in the upper
    bits only and come out of order, it is left to that.
    """
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    order = (np.sort(keys & ~low | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    ordered = keys[order]
    return order if (ordered[1:] >= ordered[:-1]).all() else np.argsort(keys, kind="stable")


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, sorted, the first place of each, and the number of every key among them."""
    order = _order(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], order[new], number


# ---- blocks --------------------------------------------------------------------------

def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A-Z lower-cased, and how many each text has; a word is a run without white space."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, count = split.flatten(), pc.list_value_length(split).to_numpy(zero_copy_only=False)
    some = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    if not some.all():      # white space at a text's begin or end
        kept = np.r_[0, np.cumsum(some)]
        count = np.diff(kept[np.r_[0, np.cumsum(count)]])
        words = words.filter(pa.array(some))
    return words, count.astype(np.int64)


def blocks(rows: DataFrame) -> DataFrame:
    """Documents condensed by block.

    ``kind`` 0, per document: its ``place`` in the block. ``kind`` 1, per block:
    ``words`` the word hashes, common words first, ``counts`` their counts in the
    block's training documents, ``tokens`` the documents one after the other as
    numbers of the words, ``sizes`` the documents' tokens, ``held`` 1 if held out.
    """
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["kind", "block", "place", "doc_id", "held_out", "n_tokens",
             "words", "counts", "tokens", "sizes", "held"]

    def run(batches):
        block = TaskContext.get().partitionId() << 20
        docs: list[tuple] = []          # of runs of documents: ids, held out, words, how many each has
        size = 0

        def close():
            ids, held, words, count = ([d[i] for d in docs] for i in range(4))
            held, count = np.concatenate(held), np.concatenate(count) + 1
            found = pa.concat_arrays(words).dictionary_encode()
            distinct = found.dictionary.cast(pa.large_binary()).to_pylist()
            keys = np.full(len(distinct) + 1, END)
            keys[1:] = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
            number = np.zeros(count.sum(), np.int64)        # 0: the end, the last of a document
            inside = np.ones(len(number), bool)
            inside[np.cumsum(count) - 1] = False
            number[inside] = found.indices.to_numpy() + 1
            keys, which = np.unique(keys, return_inverse=True)
            number = which[number]
            order = np.argsort(-np.bincount(number), kind="stable")
            keys, number = keys[order], np.argsort(order)[number]
            counts = np.bincount(number[np.repeat(~held, count)], minlength=len(keys))
            n = len(count)
            return pa.RecordBatch.from_arrays([
                pa.array([0] * n + [1], pa.int32()), pa.array([block] * (n + 1), pa.int64()),
                pa.array([*range(n), None], pa.int32()),
                pa.concat_arrays([*ids, pa.nulls(1, ids[0].type)]),
                pa.array([*held.tolist(), None], pa.bool_()),
                pa.array([*count.tolist(), None], pa.int64()),
                *[pa.array([None] * n + [x], pa.binary()) for x in (
                    keys.astype("<u8").tobytes(), _packed(counts), _packed(number),
                    _packed(count), _packed(held))]], names)

        for batch in batches:
            ids, texts, held = batch.columns
            held = held.to_numpy(zero_copy_only=False).astype(bool)
            words, count = _words(texts)
            end, tokens = np.r_[0, np.cumsum(count)], np.r_[0, np.cumsum(count + 1)]
            lo = 0
            while lo < len(count):
                # up to the document that fills the block
                hi = min(len(count), int(np.searchsorted(tokens, tokens[lo] + BLOCK_TOKENS - size)))
                docs.append((ids[lo:hi], held[lo:hi], words[int(end[lo]):int(end[hi])], count[lo:hi]))
                size += tokens[hi] - tokens[lo]
                if size >= BLOCK_TOKENS:
                    yield close()
                    block, docs, size = block + 1, [], 0
                lo = hi
        if docs:
            yield close()

    return rows.mapInArrow(run, f"kind int, block bigint, place int, doc_id {id_type}, held_out boolean, "
                                "n_tokens bigint, words binary, counts binary, tokens binary, "
                                "sizes binary, held binary")


# ---- questions and replies -----------------------------------------------------------

#: ``kind`` 0 asks for the totals of ``keys``, with the block's own counts ``n``
#: and the place ``lo`` of the first key among the block's; ``kind`` 1 has contexts'
#: ``kids`` (next symbols that the block owns), their counts' sum ``n`` and, in its
#: lowest bit, whether one is deviant; ``kind`` 2 asks for the weights of the contexts
#: ``keys``, ``lo`` among the block's strings of the level that reach ``min_count``.
QUESTIONS = "kind int, bucket int, block bigint, lo int, keys binary, n binary, kids binary"
#: ``what`` 0: totals of the block's strings at ``at``, in the lowest bit whether it is
#: the owner, 1: sum ``value`` and number ``kids`` of the next symbols' counts of the block's
#: contexts at ``at`` that are states; both ``level`` words long. The row
#: of block -1 counts a bucket's strings and their occurrences.
REPLIES = ("block bigint, level int, what int, at binary, value binary, kids binary, "
           "n_strings bigint, n_seen bigint")


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind])
                     for i, (name, kind) in enumerate(fields)})


def _dealt(kind: int, block: int, n_buckets: int, keys: np.ndarray, *numbers: np.ndarray) -> list[tuple]:
    """Rows of ``QUESTIONS`` for sorted keys, one per bucket that has any."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
    cut = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)) if len(keys) else []
    none = [None] * (2 - len(numbers))
    return [(kind, int(bucket[lo]), block, int(lo), _packed_keys(keys[lo:hi]),
             *[_packed(n[lo:hi]) for n in numbers], *none) for lo, hi in zip(cut, cut[1:])]


def ask_words(condensed: DataFrame, n_buckets: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for block, words, counts in zip(*(c.to_pylist() for c in b.columns)):
                keys = np.frombuffer(words, "<u8")
                order = np.argsort(keys)
                rows = _dealt(0, block, n_buckets, keys[order], _unpacked(counts)[order])
                yield from _table(rows, QUESTIONS).to_batches()

    return condensed.where("kind = 1").select("block", "words", "counts").mapInArrow(run, QUESTIONS)


def _joined(t: pa.Table, column: str, unpack=_unpacked) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(unpack(x) for x in t.column(column).to_pylist())])


def _totals(t: pa.Table, level: int) -> list[tuple]:
    """Replies to the blocks: totals that differ from the block's own count."""
    asks = [_unpacked_keys(x) for x in t.column("keys").to_pylist()]
    n = _joined(t, "n").astype(np.int64)
    keys, _, where = _distinct(np.concatenate([np.zeros(0, np.uint64), *asks]))
    total = np.bincount(where, weights=n, minlength=len(keys)).astype(np.int64)
    has = np.flatnonzero(n)[::-1]
    owner = np.zeros(len(keys), np.int64)
    owner[where[has]] = has         # the last one written is the first that has the string
    rows = [(-1, level, 0, b"", b"", b"", int((total > 0).sum()), int(total.sum()))]
    lo = 0
    for block, first, ask in zip(t.column("block").to_pylist(), t.column("lo").to_pylist(), asks):
        hi = lo + len(ask)
        of = total[where[lo:hi]]
        at = np.flatnonzero(of != n[lo:hi])
        if len(at):
            mine = (n[lo + at] > 0) & (owner[where[lo + at]] == lo + at)
            rows.append((block, level, 0, _packed_keys(at + first), _packed(of[at] << 1 | mine), b"", None, None))
        lo = hi
    return rows


def _weights(t: pa.Table, c: pa.Table, level: int) -> list[tuple]:
    """Replies to the blocks: what the next symbols of each state hold."""
    keys, _, where = _distinct(_joined(c, "keys", _unpacked_keys))
    n = _joined(c, "n")
    held = np.bincount(where, weights=n >> np.uint64(1), minlength=len(keys)).astype(np.int64)
    kids = np.bincount(where, weights=_joined(c, "kids"), minlength=len(keys)).astype(np.int64)
    state = np.zeros(len(keys), bool)
    state[where[(n & np.uint64(1)) > 0]] = True
    keys, held, kids = keys[state], held[state], kids[state]
    rows = []
    for block, first, asks in zip(*(t.column(x).to_pylist() for x in ("block", "lo", "keys"))):
        found = _find(keys, _unpacked_keys(asks))
        at = np.flatnonzero(found >= 0)
        if len(at):
            rows.append((block, level, 1, _packed_keys(at + first), _packed(held[found[at]]),
                         _packed(kids[found[at]]), None, None))
    return rows


def answers(sent: DataFrame, level: int) -> DataFrame:
    """Totals of strings of ``level`` words, weights of contexts two words shorter."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        kind = t.column("kind").to_numpy()
        asked, contexts, wanted = (t.filter(pa.array(kind == k)) for k in range(3))
        return _table(_totals(asked, level) + _weights(wanted, contexts, level - 2), REPLIES)

    return sent.groupBy("bucket").applyInArrow(run, REPLIES)


# ---- the part of the tree a block touches ----------------------------------------------

def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in a sorted table, -1 if absent."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return np.where(table[at] == keys, at, -1)


def _longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of strings from the keys of their prefixes and their last words' hashes."""
    with np.errstate(over="ignore"):
        k = prefix * np.uint64(0x9E3779B97F4A7C15)
        k += word
        k ^= k >> np.uint64(32)
        k *= np.uint64(0xD6E8FEB86659FD93)
        k ^= k >> np.uint64(29)
        k *= np.uint64(0x9E3779B97F4A7C15)
        k ^= k >> np.uint64(32)
    return k


class Part:
    """A block's strings by length, as far as the replies tell.

    By level (0: words): ``keys`` sorted, ``total`` counts of the corpus, ``mine``
    marks of the strings the block is the owner of, ``at`` the string that ends at
    each token if it reaches ``min_count``, or -1, ``before`` and ``shorter``
    each string's prefix and suffix in the level before, ``p`` the
    probability of the last word after the longest state that ends the prefix,
    ``rest`` the weight a context leaves to the shorter state, NaN if no state.
    """

    def __init__(self, block: dict, replies: pa.Table, levels: int, min_count: int,
                 discount: float, norm: float):
        self.block = block["block"]
        self.min_count, self.discount, self.norm = min_count, discount, norm
        self.size = _unpacked(block["sizes"]).astype(np.int64)
        keys = np.frombuffer(block["words"], "<u8")
        order = np.argsort(keys)
        self.word = np.argsort(order)[_unpacked(block["tokens"]).astype(np.int64)]
        self.hashes = keys[order]
        self.inside = self.word != np.searchsorted(self.hashes, END)
        self.train = np.repeat(_unpacked(block["held"]) == 0, self.size)
        self.replies: dict = {}
        for level, what, *reply in zip(*(replies.column(c).to_pylist() for c in
                                         ("level", "what", "at", "value", "kids"))):
            self.replies.setdefault((level, what), []).append(reply)
        self.keys, self.total, self.mine, self.at = [], [], [], []
        self.before, self.shorter, self.p, self.rest = [], [], [], []
        own = _unpacked(block["counts"]).astype(np.int64)[order]
        self._add(self.hashes, own, slice(None), self.word, None, None)
        for _ in range(1, levels):
            self._add(*self._next())

    def _reply(self, level: int, what: int) -> tuple[np.ndarray, list[np.ndarray]]:
        found = self.replies.get((level, what), [])
        none = np.zeros(0, np.int64)
        return (np.concatenate([none, *(_unpacked_keys(f[0]).astype(np.int64) for f in found)]),
                [np.concatenate([none, *(_unpacked(f[i]).astype(np.int64) for f in found)])
                 for i in range(1, 2 + what)])

    def _add(self, keys, own, here, number, before, shorter):
        """A level: strings, and the number of that which ends at each of the tokens ``here``."""
        level = len(self.keys) + 1
        total, mine = own.copy(), own > 0
        place, (value,) = self._reply(level, 0)
        total[place], mine[place] = value >> 1, value & 1
        frequent = total >= self.min_count
        at = np.full(len(self.word), -1, np.int64)
        at[here] = np.where(frequent[number], number, -1)
        if before is None:
            p = (total + 0.5) / 10 ** self.norm
        else:
            p = self.p[-1][shorter]
            rest = self.rest[-1][before]
            state = np.flatnonzero(~np.isnan(rest))
            of = self.total[-1][before[state]]
            p[state] = (total[state] - self.discount) / of + rest[state] * p[state]
            p = np.maximum(p, 1e-300)
        rest = np.full(len(keys), np.nan)
        place, (held, kids) = self._reply(level, 1)
        context = np.flatnonzero(frequent)[place]
        rest[context] = 1 - (held - self.discount * kids) / total[context]
        for to, x in ((self.keys, keys), (self.total, total), (self.mine, mine), (self.at, at),
                      (self.before, before), (self.shorter, shorter), (self.p, p), (self.rest, rest)):
            to.append(x)

    def _next(self) -> tuple[np.ndarray, ...]:
        """The next level: strings whose prefix and suffix reach ``min_count``; none reaches across an end."""
        at, keys = self.at[-1], self.keys[-1]
        known = at >= 0
        here = np.flatnonzero(known[1:] & known[:-1] & self.inside[:-1]) + 1
        before = at[here - 1]
        keys, first, number = _distinct(_longer(keys[before], self.hashes[self.word[here]]))
        own = np.bincount(number[self.train[here]], minlength=len(keys))
        return keys, own, here, number, before[first], at[here[first]]

    def questions(self, n_buckets: int) -> list[tuple]:
        """Asks for the totals of the next level."""
        keys, own, *_ = self._next()
        return _dealt(0, self.block, n_buckets, keys, own)

    def wanted(self, n_buckets: int, level: int) -> list[tuple]:
        """Asks for the weights of the contexts of a level."""
        return _dealt(2, self.block, n_buckets, self.keys[level][self.total[level] >= self.min_count])

    def deviances(self, n_buckets: int, level: int, min_deviance: float) -> list[tuple]:
        """What the strings of a level the block owns say about their contexts."""
        owned = np.flatnonzero(self.mine[level] & (self.total[level] >= self.min_count))
        before, n = self.before[level][owned], self.total[level][owned].astype(float)
        expected = self.total[level - 1][before] * self.p[level - 1][self.shorter[level][owned]]
        deviance = 2 * (n * np.log(n / expected) - (n - expected))
        size = len(self.keys[level - 1])
        kids = np.bincount(before, minlength=size)
        held = np.bincount(before, weights=n, minlength=size).astype(np.int64) << 1
        held[before[deviance >= min_deviance]] |= 1
        context = np.flatnonzero(kids)
        return _dealt(1, self.block, n_buckets, self.keys[level - 1][context], held[context], kids[context])

    def scores(self) -> tuple[np.ndarray, np.ndarray]:
        """log10 P(token) and log10 P(token | state) of every token."""
        base = (np.log10(self.total[0] + 0.5) - self.norm)[self.word]
        score = base.copy()
        for level in range(1, len(self.keys)):
            with np.errstate(invalid="ignore"):
                rest = np.log10(np.maximum(self.rest[level - 1], 1e-300))
            before = self.at[level - 1][:-1]
            here = np.flatnonzero((before >= 0) & self.inside[:-1])
            here = here[~np.isnan(rest[before[here]])]
            x = self.at[level][here + 1]
            score[here + 1] = np.where(x >= 0, np.log10(self.p[level])[x] if len(self.p[level]) else 0,
                                       score[here + 1] + rest[before[here]])
        return base, score


# ---- the operator ------------------------------------------------------------------------

def lm_scores(docs: DataFrame, held_out: Column, *, depth: int = DEPTH, min_count: int = MIN_COUNT,
              min_deviance: float = MIN_DEVIANCE, discount: float = DISCOUNT,
              scratch: Scratch | None = None, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``.

    ``held_out`` is a boolean Column over ``doc_id``: those rows are scored but
    not learned from. Scores are log10 probabilities of the whole text.
    """
    if min_count < 1:
        raise ValueError("min_count must be at least 1")
    spark = docs.sparkSession
    ship(spark)
    scratch = scratch or Scratch(spark)
    rows = _prepared(docs, held_out, id_col, text_col)
    condensed = scratch.bucketed(blocks(rows), "blocks", "block")
    n_tokens = condensed.agg(F.sum("n_tokens").alias("n")).first()["n"] or 0
    # small inputs are dealt finer, or a few tasks would do all the work
    n_buckets = max(1, -(-n_tokens // STRINGS_HELD), min(64, n_tokens // 50_000))

    replies = scratch.keep(answers(ask_words(condensed, n_buckets), 1), "answers-1")
    size = replies.agg(F.sum("n_seen").alias("n"), F.sum("n_strings").alias("v")).first()
    n_train, n_words = int(size["n"] or 0), int(size["v"] or 0)
    norm = math.log10(n_train + 0.5 * (n_words + 1))

    def told(rows: DataFrame):
        found = replies.where("block >= 0").select("block", "level", "what", "at", "value", "kids")
        return rows.groupBy("block").cogroup(found.groupBy("block"))

    packed = ["block", "words", "counts", "tokens", "sizes", "held"]

    def step(level: int):
        def run(block: pa.Table, known: pa.Table) -> pa.Table:
            part = Part(block.to_pylist()[0], known, level, min_count, discount, norm)
            out = []
            if level > 1:
                out += part.deviances(n_buckets, level - 1, min_deviance)
                out += part.wanted(n_buckets, level - 2)
            if level <= depth:
                out += part.questions(n_buckets)
            return _table(out, QUESTIONS)
        return run

    texts = condensed.where("kind = 1").select(packed)
    for level in range(1, depth + 2):
        found = answers(told(texts).applyInArrow(step(level), QUESTIONS), level + 1)
        replies = replies.unionByName(scratch.keep(found, f"answers-{level + 1}"))

    id_type = condensed.schema["doc_id"].dataType.simpleString()

    def score(block: pa.Table, known: pa.Table) -> pa.Table:
        kind = block.column("kind").to_numpy()
        docs = block.filter(pa.array(kind == 0)).sort_by("place")
        text = block.filter(pa.array(kind == 1)).select(packed).to_pylist()[0]
        part = Part(text, known, depth + 1, min_count, discount, norm)
        start = np.r_[0, np.cumsum(part.size)[:-1]]
        base, score = part.scores()
        return pa.Table.from_arrays(
            [docs.column("doc_id"), docs.column("held_out"), docs.column("n_tokens"),
             pa.array(np.add.reduceat((part.total[0] > 0).astype(np.int64)[part.word], start)),
             pa.array(np.add.reduceat(base, start)), pa.array(np.add.reduceat(score, start))],
            ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    scored = told(condensed).applyInArrow(score, f"doc_id {id_type}, held_out boolean, n_tokens bigint, "
                                                 "n_known bigint, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known",
                         F.lit(n_train).cast("bigint").alias("train_tokens"), "base_score", "score")
