"""Exact token ids of whole texts through batch encoding of their pieces.

The byte-level BPE splits a text into pre-tokens before merging, and a space
between two characters that are no white space always begins a new one. Such
spaces are the safe boundaries: cutting there and encoding the parts gives
the ids of the whole. A text becomes its space-separated parts; the parts not
seen before in this worker are encoded in one batch by the library, the rest
come from a table of bounded size. Long texts thereby never reach the encoder
whole. Parts that touch other white space (double spaces, a space beside a
line break, a space at either end) are joined with their neighbours first.

Most new parts are one word, or a word with ASCII punctuation after it. The
border between letters and punctuation is a pre-token border too, so those go
to the library's BPE model directly as one pre-token (its bytes written in the
model's alphabet), which saves the tokenizer's bookkeeping around it; their
punctuation and all other parts take the full path.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from struct import pack

MAX_KEPT = 600_000      # parts a worker remembers; the table is emptied beyond
MAX_KEPT_CHARS = 64     # longer parts are encoded each time

# ASCII punctuation without the apostrophe, which may begin a contraction
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LATIN = 0x250           # letters below this have long been letters in every Unicode table

_TABLES: dict = {}


def _byte_alphabet() -> dict[int, str]:
    """Code point -> how the byte-level model writes its UTF-8 bytes.

    Printable ASCII and Latin-1 bytes stand for themselves, the other bytes
    for the code points from 256 on, in order.
    """
    itself = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    letter = [chr(b if b in itself else next(other)) for b in range(256)]
    return {cp: "".join(letter[b] for b in chr(cp).encode()) for cp in range(LATIN)}


_ALPHABET = _byte_alphabet()


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _id_bytes(ids: list[int]) -> bytes:
    return pack(f"<{len(ids)}I", *ids)


class Pieces:
    """Encodes texts of one vocabulary; ``value`` maps ids to what is kept."""

    def __init__(self, path: str, value: Callable, join: Callable):
        self.tokenizer = _load(path)
        self.model = self.tokenizer.model
        self.tails: dict[str, list[int]] = {"": []}
        self.value, self.join = value, join
        self.inner: dict[str, object] = {}   # part -> value of " " + part
        self.first: dict[str, object] = {}   # part at the start of a text

    def _learn(self, table: dict, parts: Iterable[str], prefix: str) -> dict:
        """Values of unseen parts; None for parts that must be joined first."""
        extra, good = {}, []
        lead = prefix.translate(_ALPHABET)
        for p in parts:
            if not p or p[0].isspace() or p[-1].isspace():
                table[p] = None
                continue
            word = p.rstrip(TAIL)
            if len(p) <= MAX_KEPT_CHARS and word.isalpha() and (word.isascii() or max(word) < chr(LATIN)):
                ids = [t.id for t in self.model.tokenize(lead + word.translate(_ALPHABET))]
                table[p] = self.value(ids + self._tail(p[len(word):]))
            else:
                good.append(p)
        for at in range(0, len(good), 20_000):
            block = good[at:at + 20_000]
            for p, e in zip(block, self.tokenizer.encode_batch_fast(
                    [prefix + p for p in block], add_special_tokens=False)):
                (table if len(p) <= MAX_KEPT_CHARS else extra)[p] = self.value(e.ids)
        return extra

    def with_space(self, parts: list[str]) -> list:
        """The value of a space and each part, looked up nowhere and kept nowhere."""
        found: dict[str, object] = {}
        found |= self._learn(found, parts, " ")
        loose = [p for p in parts if found[p] is None]
        found |= zip(loose, [self.value(e.ids) for e in self.tokenizer.encode_batch_fast(
            [" " + p for p in loose], add_special_tokens=False)])
        return [found[p] for p in parts]

    def _tail(self, tail: str) -> list[int]:
        """Ids of punctuation that follows a letter."""
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails = {"": []}
            self.tails[tail] = self.tokenizer.encode(tail, add_special_tokens=False).ids
        return self.tails[tail]

    def _joined(self, parts: list[str]) -> list[str]:
        """Encodable strings: parts whose boundary is unsafe are put together."""
        out, last = [parts[0]], parts[0]
        for p in parts[1:]:
            if not p or not last or p[0].isspace() or last[-1].isspace():
                out[-1] += " " + p
            else:
                out.append(" " + p)
            last = p
        return out

    def encode(self, batch: list[str]) -> list:
        """One joined value per text."""
        if len(self.inner) > MAX_KEPT:
            self.inner.clear()
        if len(self.first) > MAX_KEPT:
            self.first.clear()
        split = [t.split(" ") for t in batch]
        out: list = [None] * len(split)
        later = []
        first, inner = self.first, self.inner
        new_first, new_inner = set(), set()
        for i, s in enumerate(split):
            try:
                out[i] = self._whole(s, first, inner)
            except KeyError:           # parts not seen before
                later.append(i)
                new_inner.update([p for p in s[1:] if p not in inner])
                if s[0] not in first:
                    new_first.add(s[0])
        extra = self._learn(inner, new_inner, " ")
        if extra:
            inner = {**inner, **extra}
        extra = self._learn(first, new_first, "")
        if extra:
            first = {**first, **extra}
        for i in later:
            out[i] = self._whole(split[i], first, inner)
        return out

    def _whole(self, s: list[str], first: dict, inner: dict):
        parts = iter(s)
        values = [first[next(parts)]]
        values += map(inner.__getitem__, parts)
        try:
            return self.join(values)
        except TypeError:              # a part that must be joined first
            whole = self._joined(s) if s != [""] else []
            return self.join([self.value(e.ids) for e in self.tokenizer.encode_batch_fast(
                whole, add_special_tokens=False)])


def counter(path: str) -> Pieces:
    """Token counts per text."""
    key = ("count", path)
    if key not in _TABLES:
        _TABLES[key] = Pieces(path, len, sum)
    return _TABLES[key]


def encoder(path: str) -> Pieces:
    """Token ids per text, as little-endian unsigned 32-bit bytes."""
    key = ("ids", path)
    if key not in _TABLES:
        _TABLES[key] = Pieces(path, _id_bytes, b"".join)
    return _TABLES[key]


def byte_blocks(batch: list[str], limit: int):
    """(start, stop) runs of at most ``limit`` characters, one text at least."""
    start = size = 0
    for i, t in enumerate(batch):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(batch):
        yield start, len(batch)
