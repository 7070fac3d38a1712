"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1; a letter n-gram is the product
of its letters' vectors, each permuted (rolled) by its place; a text is the sum
(bundle) of its n-grams; a language is the sum of its training documents'
vectors of length one. A text gets the language whose prototype has the
largest cosine with it.

Letters: a-z have vectors of their own, all other letters share a fixed number
of vectors by code point; everything else is a word gap, runs of which count
once. Texts are lower-cased. Prototypes are summed per task, then per (language,
place) in Spark; only ``languages x dimensions`` sums reach the driver. Texts
are handled in segments, so memory does not follow the longest text.

Rows: null text and text without a letter give ``und`` with score 0; rows with
a null language are not learned from; repeated rows count each; equal cosines
go to the first language in order; without training rows every text is
``und``; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import columns, ship

DIMENSIONS = 1024
NGRAM = 3
SHARED = 37                 # vectors for letters other than a-z
SEED = 8
SEGMENT = 50_000            # letters handled at once for one text
BLOCK_TEXTS, BLOCK_LETTERS = 64, 400_000
UNKNOWN = "und"

_LETTERS = 1 + 26 + SHARED
_MADE: dict = {}


def letter_codes() -> np.ndarray:
    """Code point -> letter number; 0 for what is no letter."""
    if "codes" not in _MADE:
        table = np.zeros(sys.maxunicode + 1, np.uint8)
        for cp in range(128, sys.maxunicode + 1):
            if unicodedata.category(chr(cp))[0] == "L":
                table[cp] = 27 + (cp * 2654435761 >> 7) % SHARED
        for i in range(26):
            table[97 + i] = table[65 + i] = 1 + i
        _MADE["codes"] = table
    return _MADE["codes"]


def letter_vectors(dimensions: int, ngram: int) -> list[np.ndarray]:
    """The letters' vectors, permuted for each place of an n-gram."""
    key = (dimensions, ngram)
    if key not in _MADE:
        rng = np.random.default_rng(SEED)
        base = rng.choice(np.array([-1, 1], np.int8), (_LETTERS, dimensions))
        _MADE[key] = [np.roll(base, ngram - 1 - place, axis=1) for place in range(ngram)]
    return _MADE[key]


def segments(text: str | None, ngram: int) -> Iterator[np.ndarray]:
    """n-gram numbers of a text, in pieces of bounded size; none without a letter."""
    codes = letter_codes()
    tail = np.zeros(1, np.uint8)       # a text begins after a gap
    text = (text or "").lower()
    if not text:
        return
    for at in range(0, len(text), SEGMENT):
        part = codes[np.frombuffer(text[at:at + SEGMENT].encode("utf-32-le", "surrogatepass"), "<u4")]
        if at + SEGMENT >= len(text):
            part = np.r_[part, np.zeros(1, np.uint8)]
        part = np.r_[tail, part]
        part = part[np.r_[True, (part[1:] != 0) | (part[:-1] != 0)]]
        if len(part) >= ngram:
            n = len(part) - ngram + 1
            number = np.zeros(n, np.int64)
            for place in range(ngram):
                number = number * _LETTERS + part[place:place + n]
            if part.any():
                yield number
            tail = part[n:]
        else:
            tail = part


def vectors(texts: list[str | None], dimensions: int, ngram: int) -> np.ndarray:
    """One bundled vector per text, zero for texts without a letter."""
    out = np.zeros((len(texts), dimensions), np.float32)
    tables = letter_vectors(dimensions, ngram)

    def flush(rows: list[int], grams: list[np.ndarray]) -> None:
        if not rows:
            return
        seen, where = np.unique(np.concatenate(grams), return_inverse=True)
        row = np.repeat(np.arange(len(rows)), [len(g) for g in grams])
        counts = np.bincount(row * len(seen) + where, minlength=len(rows) * len(seen)).reshape(
            len(rows), len(seen)).astype(np.float32)
        bound = np.ones((len(seen), dimensions), np.int8)
        rest = seen
        for place in range(ngram - 1, -1, -1):
            bound *= tables[place][rest % _LETTERS]
            rest = rest // _LETTERS
        np.add.at(out, rows, counts @ bound.astype(np.float32))

    rows: list[int] = []
    grams: list[np.ndarray] = []
    size = 0
    for i, text in enumerate(texts):
        for g in segments(text, ngram):
            if rows and (len(rows) >= BLOCK_TEXTS or size + len(g) > BLOCK_LETTERS):
                flush(rows, grams)
                rows, grams, size = [], [], 0
            rows.append(i)
            grams.append(g)
            size += len(g)
    flush(rows, grams)
    return out


def prototypes(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
               dimensions: int = DIMENSIONS, ngram: int = NGRAM) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes of length one."""
    ship(docs.sparkSession)
    rows = columns(docs, lang=F.col(f"`{lang_col}`").cast("string"), text=text_col).where(
        "lang is not null and text is not null")

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            v = vectors(b.column(1).to_pylist(), dimensions, ngram)
            length = np.sqrt((v * v).sum(axis=1, keepdims=True))
            v = np.divide(v, length, out=v, where=length > 0)
            langs = np.array(b.column(0).to_pylist(), object)
            for lang in set(langs):
                sums[lang] = sums.get(lang, 0) + v[langs == lang].sum(axis=0, dtype=np.float64)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(range(dimensions), pa.int32()),
                 pa.array(total, pa.float64())], ["lang", "place", "value"])

    found = (rows.mapInArrow(bundle, "lang string, place int, value double")
             .groupBy("lang", "place").agg(F.sum("value").alias("value")).collect())
    langs = sorted({r["lang"] for r in found})
    number = {lang: i for i, lang in enumerate(langs)}
    out = np.zeros((len(langs), dimensions))
    for r in found:
        out[number[r["lang"]], r["place"]] = r["value"]
    length = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return langs, np.divide(out, length, out=out, where=length > 0)


def language_id(docs: DataFrame, model: tuple[list[str], np.ndarray], *, id_col: str = "doc_id",
                text_col: str = "text", ngram: int = NGRAM) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row; score is the cosine, 0 at least."""
    ship(docs.sparkSession)
    langs, profile = model
    profile = profile.astype(np.float32)
    dimensions = profile.shape[1]
    rows = columns(docs, doc_id=id_col, text=text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            v = vectors(b.column(1).to_pylist(), dimensions, ngram)
            length = np.sqrt((v * v).sum(axis=1))
            some = length > 0
            if langs:
                cosine = v @ profile.T / np.where(some, length, 1)[:, None]
                best = cosine.argmax(axis=1)
                score = np.where(some, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0.0)
                name = [langs[i] if s else UNKNOWN for i, s in zip(best, some)]
            else:
                name, score = [UNKNOWN] * len(v), np.zeros(len(v))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(name, pa.string()), pa.array(score.astype(np.float64))],
                ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
