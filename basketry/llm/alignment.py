"""Cross-tokenizer alignment by pointer jumping.

Both tokenizers cut the same bytes (a space and the text) into tokens. Every
token points to its farthest-right overlapping token, the last token of its
group to itself; all pointers of a block of documents are one array, and
doubling the successors (``next = next[next]``) converges, in logarithmically
many gathers, to the terminal token of every group, which labels it. A link is
a pair of tokens of the two sides whose bytes overlap.

Counting the links of the whole corpus. A pass over the texts writes, per block
of documents (``BLOCK_BYTES`` of text, one document at least), the distinct id
pairs of the block with their number, and per document the places of its pairs
in that list. The pairs are summed by a grouped aggregation, which also marks
each second id's highest counts, and joined back to the blocks that hold them.
One block's pairs and documents then meet in a task: no table of pairs is
broadcast or collected, and a frequent pair has one row a block.

Rows: null and empty texts, and those whose tokens do not spell space and text
exactly (a normalised character, say), have no tokens: zeros, an empty digest
and no part in the counts. Repeated rows each give a row and count each time;
ids may be null or equal; equal counts are all highest; an empty table gives no
rows; other columns are ignored. A very long text is a block of its own and
needs memory in proportion to itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Scratch, documents, ship
from basketry.llm.token_pieces import LATIN, TAIL, Pieces

BLOCK_BYTES = 8 << 20
ENCODE_BYTES = 1 << 19      # text encoded and aligned at once, one document at least

MAX_KEPT = 300_000          # parts a worker remembers; the table is emptied beyond
MAX_KEPT_CHARS = 64         # longer parts are encoded each time
MAX_TAILS = 10_000          # runs of punctuation a worker remembers
WORDS_AT_ONCE = 2000
SAFE = re.compile(r"(?<=\S) (?=\S)")

_LOADED: dict = {}


# ---- tokens and their bytes ----------------------------------------------------------

def _ids(ids: list[int]) -> bytes:
    return pack(f"<{len(ids)}I", *ids)


@dataclass
class Side:
    """One tokenizer: texts to id arrays, and the bytes of every id."""

    encode: object
    spelt: list[bytes]
    sizes: np.ndarray


def _side(encode, spelt: list[bytes]) -> Side:
    return Side(encode, spelt, np.array([len(b) for b in spelt], dtype=np.int64))


def byte_letters() -> dict[str, int]:
    """Letter of the byte-level alphabet -> byte.

    Printable ASCII and Latin-1 bytes are their own letters, the others take
    the code points from 256 on, in order.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level(path: str) -> Side:
    """A byte-level BPE of the tokenizers library; encodes space + text."""
    pieces = Pieces(path, list, None)
    t = pieces.tokenizer
    t.encode_special_tokens = True      # their strings in a text are plain text
    letters = byte_letters()
    spelt = [b""] * t.get_vocab_size()
    for piece, i in t.get_vocab().items():
        spelt[i] = (bytes(letters[c] for c in piece) if all(c in letters for c in piece)
                    else piece.encode())
    return _side(pieces.with_space, spelt)


def sentence_piece(path: str) -> Side:
    """A sentencepiece model, which adds the space itself."""
    import sentencepiece

    s = sentencepiece.SentencePieceProcessor(model_file=path)
    spelt = []
    for i in range(s.get_piece_size()):
        piece = s.id_to_piece(i)
        byte = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece) if s.is_byte(i) else None
        spelt.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
    return _side(lambda texts: s.encode(texts, num_threads=1), spelt)


# ---- groups and links -------------------------------------------------------------------

def terminals(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Label of every token of the two sides, and the rounds of doubling.

    ``end_*`` are the ascending byte ends of tokens that tile the same bytes.
    A label is the number of the group's terminal token (the second side's
    tokens are numbered after the first's).
    """
    n = len(end_a)
    # the token whose bytes hold the last byte of mine reaches farthest right
    to_b = np.searchsorted(end_b, end_a)
    to_a = np.searchsorted(end_a, end_b)
    own = np.arange(len(end_b))
    succ = np.concatenate([n + to_b, np.where(end_a[to_a] > end_b, to_a, n + own)])
    rounds = 0
    while True:
        far = succ[succ]
        rounds += 1
        if (far == succ).all():
            return succ[:n], succ[n:], rounds
        succ = far


def links(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs (token of a, token of b) whose bytes overlap, by token of a,
    and their number up to and with each token of a."""
    last = np.searchsorted(end_b, end_a)
    # the next token of a begins with the same token of b, or with the one after a common end
    first = np.r_[0, (last + (end_b[last] == end_a))[:-1]]
    n = last - first + 1
    upto = np.cumsum(n)
    i = np.repeat(np.arange(len(end_a)), n)
    j = np.arange(len(i)) + np.repeat(first - (upto - n), n)
    return i, j, upto


class Aligner:
    """Aligns batches of texts under two tokenizers.

    A space between two characters that are no white space begins a token on
    both sides (a new pre-token on the one; no piece of the other holds a space
    after another character, which is checked), so the ids of a text are those
    of its parts between such spaces, each with a space before it. Parts seen
    lately come from a table of bounded size, the others are encoded: plain words
    many at a time, as one text that is cut where the words end. A line break
    between such characters and the border between a letter and ASCII punctuation
    are borders of both sides too, so lines and words with punctuation are put
    together from theirs.
    """

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_level(path_a), sentence_piece(path_b)
        pieces = [x.decode("utf-8", "replace") for x in self.b.spelt]
        self.cut = not any(" " in x.lstrip(" ") for x in pieces)
        # what no piece of the second side holds after a letter
        joined = {y for x in pieces for c, y in zip(x, x[1:]) if c.isalpha()}
        self.tail = "".join(c for c in TAIL if c not in joined)
        self.lines = not any("\n" in x and len(x) > 1 for x in pieces)
        # part -> ids of both sides, or None if it must stay with its neighbours
        self.kept: dict[str, tuple[bytes, bytes] | None] = {}
        self.older: dict[str, tuple[bytes, bytes] | None] = {}
        self.tails: dict[str, tuple[bytes, bytes]] = {"": (b"", b"")}
        self.odd: set[str] = set()      # parts whose tokens do not spell them
        self.brief: set[str] = set()    # parts that are not kept
        most = max(len(self.a.spelt), len(self.b.spelt))
        # an id with what follows it: next of its side, other side, next group, end
        self.written = [f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(most)]
        self.width = most

    def _learn(self, parts: set[str]) -> None:
        """Entries of parts that are not in the table."""
        kept, older = self.kept, self.older
        words, others, made = set(), [], []
        for p in parts:
            if p in older:
                kept[p] = older[p]
                continue
            if not p or p[0].isspace() or p[-1].isspace():
                kept[p] = None
                continue
            if "\n" in p and self.lines:
                lines = p.split("\n")
                if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                    made.append((p, [lines[0], *["\n" + x for x in lines[1:]]]))
                    self.brief.add(p)
                    continue
            made.append((p, [p]))
            if len(p) > MAX_KEPT_CHARS:
                self.brief.add(p)
        for p, lines in made:
            for x in lines:
                word = x.rstrip(self.tail)
                if len(x) > MAX_KEPT_CHARS:
                    self.brief.add(x)
                plain = word[1:] if word[:1] == "\n" else word
                if not (plain.isalpha() and (plain.isascii() or max(plain) < chr(LATIN))):
                    word = x
                    if x not in kept and x not in older:
                        others.append(x)
                elif word not in kept and word not in older:
                    words.add(word)
                if len(x) > len(word) and x[len(word):] not in self.tails:
                    self._learn_tail(x[len(word):])
        self._learn_words(sorted(words, key=lambda w: w[0] == "\n"))
        self._learn_each(sorted(set(others)))
        for p, lines in made:
            a, b = [], []
            for x in lines:
                entry, tail = kept.get(x) or older.get(x), ""
                if entry is None:
                    word = x.rstrip(self.tail)
                    entry, tail = kept.get(word) or older[word], x[len(word):]
                    if word in self.odd:
                        self.odd.add(p)
                elif x in self.odd:
                    self.odd.add(p)
                a += [entry[0], self.tails[tail][0]]
                b += [entry[1], self.tails[tail][1]]
            if p not in kept:
                kept[p] = b"".join(a), b"".join(b)

    def _learn_tail(self, tail: str) -> None:
        """Ids of punctuation after a letter."""
        (a, a0), (b, b0) = (side.encode(["a" + tail, "a"]) for side in (self.a, self.b))
        self.tails[tail] = _ids(a[len(a0):]), _ids(b[len(b0):])

    def _learn_words(self, words: list[str]) -> None:
        """Plain words, some after a line break, as one text a time."""
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at:at + WORDS_AT_ONCE]
            text = "".join([w if w[0] == "\n" else " " + w for w in some])
            # a leading space is the one that both sides add; words after a break come last
            lead = text[0] == "\n"
            wanted = (" " * lead + text).encode()
            ends = np.cumsum([len(w.encode()) + (w[0] != "\n") for w in some]) + lead
            found = []
            for side in (self.a, self.b):
                ids = np.array(side.encode([text if lead else text[1:]])[0], dtype="<u4")
                upto = np.cumsum(side.sizes[ids])
                cut = np.searchsorted(upto, ends)
                good = (len(ids) and b"".join(map(side.spelt.__getitem__, ids.tolist())) == wanted
                        and (upto[cut] == ends).all() and (not lead or upto[0] == 1))
                if not good:
                    break
                flat, cut = ids.tobytes(), [4 * lead, *(4 * (cut + 1)).tolist()]
                found.append([flat[x:y] for x, y in zip(cut, cut[1:])])
            if len(found) < 2:
                self._learn_each(some)
            else:
                self.kept.update(zip(some, zip(*found)))

    def _learn_each(self, parts: list[str]) -> None:
        """Parts of any kind, one by one; those after a break lose the space added."""
        a, b = self.a.encode(parts), self.b.encode(parts)
        for p, x, y in zip(parts, a, b):
            if p[0] != "\n":
                self.kept[p] = self._entry(p, x, y)
            elif self.a.spelt[x[0]] == self.b.spelt[y[0]] == b" ":
                self.kept[p] = self._entry(p, x, y, drop=1)
            else:
                raise ValueError(f"a space and a line break make one token: {p!r}")

    def _entry(self, part: str, a: list[int], b: list[int], drop: int = 0) -> tuple[bytes, bytes]:
        wanted = b" " + part.encode("utf-8", "surrogatepass")
        if (b"".join([self.a.spelt[i] for i in a]) != wanted
                or b"".join([self.b.spelt[i] for i in b]) != wanted):
            self.odd.add(part)
        return _ids(a[drop:]), _ids(b[drop:])

    def _spells(self, ids: bytes, side: Side, text: str) -> bool:
        joined = b"".join([side.spelt[i] for i in np.frombuffer(ids, "<u4")])
        return joined == b" " + text.encode("utf-8", "surrogatepass")

    def _joined(self, text: str) -> tuple[list[str], list[tuple[bytes, bytes]]]:
        """Parts of a text with other white space, which stays with its neighbours."""
        parts = SAFE.split(text) if self.cut else [text]
        self._learn({p for p in parts if p not in self.kept and p[0] != "\n"})
        loose = [p for p in parts if p[0] == "\n" or self.kept[p] is None]
        found = {p: self._entry(p, a, b) for p, a, b in zip(loose, self.a.encode(loose), self.b.encode(loose))}
        return parts, [found.get(p) or self.kept[p] for p in parts]

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Per text the ids of both sides as little-endian 32-bit integers;
        none where the tokens do not spell space and text."""
        if len(self.kept) > MAX_KEPT:
            self.kept, self.older = {}, self.kept
        if len(self.tails) > MAX_TAILS:
            self.tails = {"": (b"", b"")}
        # a part that begins with a line break is no line of another part, whose entry has no space
        split = [t.split(" ") if t and self.cut and t[0] != "\n" and " \n" not in t else [] for t in texts]
        kept = self.kept
        self._learn({p for parts in split for p in parts if p not in kept})
        out = []
        for text, parts in zip(texts, split):
            found = list(map(kept.__getitem__, parts))
            if text and (not found or None in found):
                parts, found = self._joined(text)
            a, b = b"".join([x for x, _ in found]), b"".join([y for _, y in found])
            if self.odd and not self.odd.isdisjoint(parts) and not (
                    self._spells(a, self.a, text) and self._spells(b, self.b, text)):
                a = b = b""
            out.append((a, b))
        for p in self.brief:
            kept.pop(p, None)
        self.brief.clear()
        return out

    def align(self, texts: list[str | None]) -> list[tuple]:
        """Per text ``(n_a, n_b, n_groups, digest, pairs)``; ``pairs`` has
        ``a << 32 | b`` of every link."""
        out: list = [(0, 0, 0, "", np.zeros(0, np.int64))] * len(texts)
        ids = self.encode(texts)
        good = [i for i, (x, _) in enumerate(ids) if x]
        if not good:
            return out
        a, b = (np.frombuffer(b"".join([ids[i][side] for i in good]), "<u4").astype(np.int64)
                for side in (0, 1))
        # documents side by side: both sides end together there, so no group spans two
        to_a, to_b = (np.cumsum([len(ids[i][side]) // 4 for i in good]) for side in (0, 1))
        end_a, end_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        label_a, label_b, _ = terminals(end_a, end_b)
        i, j, upto = links(end_a, end_b)
        pairs = a[i] << 32 | b[j]
        to_link = upto[to_a - 1]
        text = self._text(a, b, label_a, label_b, to_a, to_b)
        ended = np.cumsum(label_b == len(a) + np.arange(len(b)))[to_b - 1]   # groups ended by then
        ends = [x.tolist() for x in (to_a, to_b, ended, to_link)]
        for place, now, before in zip(good, zip(*ends), [(0, 0, 0, 0), *zip(*ends)]):
            n_a, n_b, n_groups, _ = (x - y for x, y in zip(now, before))
            out[place] = (n_a, n_b, n_groups, hashlib.sha256(next(text).encode()).hexdigest(),
                          pairs[before[3]:now[3]])
        return out

    def _text(self, a, b, label_a, label_b, to_a, to_b) -> Iterator[str]:
        """``a1,a2|b1;a3|b2,b3`` of every document."""
        last_a = np.r_[label_a[1:] != label_a[:-1], True]
        last_b = np.r_[label_b[1:] != label_b[:-1], True]
        mark_a = np.where(last_a, 1, 0)
        mark_b = np.where(last_b, 2, 0)
        mark_b[to_b - 1] = 3
        # by group, the first side before the second; labels ascend along each side
        n = len(a) + len(b)
        at_a = np.arange(len(a)) + np.searchsorted(label_b, label_a)
        at_b = np.arange(len(b)) + np.searchsorted(label_a, label_b, side="right")
        code = np.empty(n, dtype=np.int64)
        code[at_a] = a + mark_a * self.width
        code[at_b] = b + mark_b * self.width
        parts = list(map(self.written.__getitem__, code.tolist()))
        ends = (to_a + to_b).tolist()
        return ("".join(parts[lo:hi]) for lo, hi in zip([0, *ends[:-1]], ends))


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner of two vocabularies, loaded once."""
    key = (path_a, path_b)
    if key not in _LOADED:
        _LOADED[key] = Aligner(path_a, path_b)
    return _LOADED[key]


def _runs(texts: list[str | None], limit: int):
    """(start, stop) runs of texts of about ``limit`` bytes, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        here = len(t.encode("utf-8", "surrogatepass")) if t else 0
        if size and size + here > limit:
            yield start, i, size
            start, size = i, 0
        size += here
    if start < len(texts):
        yield start, len(texts), size


# ---- over a corpus --------------------------------------------------------------------------

PER_DOC = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def _blocks(docs: DataFrame, path_a: str, path_b: str, block_bytes: int) -> DataFrame:
    """Rows of documents ``(block, doc_id, ..., at, n)`` and of a block's pairs
    ``(block, pairs, counts)``, told apart by ``pairs``.

    ``at`` and ``n`` are the places of a document's distinct pairs in the
    block's ``pairs`` and their numbers, as little-endian 32-bit integers.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "at", "n",
             "pairs", "counts"]

    def run(batches):
        align = aligner(path_a, path_b).align
        block = TaskContext.get().partitionId() << 33
        size, held, kind = 0, [], None

        def emit():
            lengths = [len(p) for *_, p in held]
            flat = np.concatenate([p for *_, p in held])
            place, pairs = pd.factorize(flat)
            total = np.bincount(place, minlength=len(pairs))
            rows = []
            lo = 0
            for (doc_id, n_a, n_b, n_groups, digest, _), k in zip(held, lengths):
                at, n = np.unique(place[lo:lo + k], return_counts=True)
                rows.append((doc_id, n_a, n_b, n_groups, k, digest, at.astype("<u4").tobytes(),
                             n.astype("<u4").tobytes()))
                lo += k
            cols = list(zip(*rows))
            m = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * m, pa.int64()), pa.array(cols[0], kind),
                 *[pa.array(c, pa.int64()) for c in cols[1:5]], pa.array(cols[5], pa.string()),
                 *[pa.array(c, pa.binary()) for c in cols[6:]],
                 pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, pa.list_(pa.int64()))], names)
            if len(pairs):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.nulls(1, kind), *[pa.nulls(1, pa.int64())] * 4,
                     pa.nulls(1, pa.string()), *[pa.nulls(1, pa.binary())] * 2,
                     pa.array([pairs], pa.list_(pa.int64())),
                     pa.array([total], pa.list_(pa.int64()))], names)

        for batch in batches:
            kind = batch.schema.field(0).type
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi, n_bytes in _runs(texts, ENCODE_BYTES):
                if held and size + n_bytes > block_bytes:
                    yield from emit()
                    held, size, block = [], 0, block + 1
                held += [(i, *found) for i, found in zip(ids[lo:hi], align(texts[lo:hi]))]
                size += n_bytes
        if held:
            yield from emit()

    schema = (f"block bigint, doc_id {id_type}, {PER_DOC}, at binary, n binary, "
              "pairs array<bigint>, counts array<bigint>")
    return docs.mapInArrow(run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(pair, count, best)``: links of the corpus that hold the pair, and
    whether no pair with the same second id has more."""
    each = (blocks.where("pairs is not null")
            .select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
            .select(F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n")))
    return each.groupBy("pair").agg(F.sum("n").alias("count"))


def _scored(rows: DataFrame, replies: DataFrame, id_type: str) -> DataFrame:
    """Per document ``n_best`` and ``count_sum`` from its block's replies."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        place = np.asarray(right["place"].combine_chunks())
        count = np.zeros(len(place), np.int64)
        best = np.zeros(len(place), np.int64)
        count[place] = right["count"].to_numpy()
        best[place] = right["best"].to_numpy()
        n_best, count_sum = [], []
        for at, n in zip(left["at"].to_pylist(), left["n"].to_pylist()):
            at, n = np.frombuffer(at, "<u4"), np.frombuffer(n, "<u4").astype(np.int64)
            n_best.append(int((best[at] * n).sum()))
            count_sum.append(int((count[at] * n).sum()))
        own = {c: left[c] for c in ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]}
        own |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table({c: own[c] for c in names})

    return rows.groupBy("block").cogroup(replies.groupBy("of")).applyInArrow(
        run, f"doc_id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
             "n_best bigint, count_sum bigint, groups_sha256 string")


def alignment(docs: DataFrame, path_a: str, path_b: str, *, block_bytes: int = BLOCK_BYTES,
              id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row."""
    ship(docs.sparkSession)
    scratch = scratch or Scratch(docs.sparkSession)
    rows = documents(docs, id_col, text_col)
    blocks = scratch.keep(_blocks(rows, path_a, path_b, block_bytes), "blocks")
    counts = scratch.keep(pair_counts(blocks), "pairs")
    second = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = counts.groupBy(second.alias("b")).agg(F.max("count").alias("top"))
    marked = counts.join(highest, second == F.col("b")).select(
        "pair", "count", (F.col("count") == F.col("top")).cast("int").alias("best"))
    asked = (blocks.where("pairs is not null")
             .select("block", F.posexplode("pairs").alias("place", "pair")))
    replies = asked.join(marked, "pair").select(F.col("block").alias("of"), "place", "count", "best")
    found = blocks.where("pairs is null").drop("pairs", "counts")
    return _scored(found, replies, rows.schema["doc_id"].dataType.simpleString())
