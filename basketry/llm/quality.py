"""Quality classifier: gated-attention multiple-instance learning.

A document is a bag of passages (its UTF-8 bytes in runs of ``PASSAGE``), all
of which are encoded: shares of byte classes, a hashed byte-pair histogram and
measures of repetition go through a learned layer. Gated attention
(``w . (tanh(V h) * sigmoid(U h))``, softmax over the passages of a document)
weights the passage encodings, and a logistic output scores their weighted sum.
Only document labels are given; which passages matter is learned.

The network is fitted on a bounded sample of labelled rows, ``FIT_DOCS``
documents in the order of a hash of the id, fewer if those before have
``FIT_PASSAGES`` passages together; the driver trains on the encodings of all
passages of a document that is in the sample. Scoring takes every passage of every document: passages are
encoded in runs and the attention softmax is accumulated over the runs, so
memory does not follow the longest text.

Rows: null text counts as empty; an empty text is one empty passage and gets a
score like any other; repeated rows are scored each, but only one row of an id
(the smallest by a hash of its text) is fitted on; if an id has several
labels the lowest counts, null labels are ignored; without labels every score
is 0.5, with one label value only every score is near it; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import Scratch, columns, documents, ship

PASSAGE = 512
RUN = 512                    # passages encoded at once
FIT_DOCS = 6000
FIT_PASSAGES = 200_000       # of all documents fitted on
HIDDEN, GATE = 32, 16
EPOCHS, BATCH, RATE, DECAY = 30, 64, 3e-3, 1e-4
THRESHOLD = 0.3

_CLASSES = 16
_PAIRS = 128
_FOURS = 256
FEATURES = _CLASSES + _PAIRS + 5


def _class_table() -> np.ndarray:
    table = np.full(256, 15, np.uint8)                 # other ASCII
    table[128:] = 14
    for group, number in ((range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2),
                          (b" ", 3), (b"\n\r", 4), (b".", 5), (b",;:", 6), (b"!?", 7), (b"#", 8),
                          (b"%", 8), (b"$&", 9), (b"*", 10), (b"|", 11), (b"\"'-", 12), (b"()[]{}<>/\\=_", 13)):
        for c in group:
            table[c] = number
    return table


_CLASS = _class_table()


def encode(data: bytes, first: int, last: int) -> np.ndarray:
    """Features of passages ``first .. last`` (exclusive) of a text."""
    part = np.frombuffer(data, np.uint8)[first * PASSAGE:last * PASSAGE]
    n = last - first
    out = np.zeros((n, FEATURES), np.float32)
    size = np.full(n, PASSAGE)
    size[-1] = len(part) - (n - 1) * PASSAGE
    at = np.arange(len(part)) // PASSAGE
    total = np.maximum(size, 1)[:, None]
    out[:, :_CLASSES] = np.bincount(at * _CLASSES + _CLASS[part], minlength=n * _CLASSES).reshape(
        n, _CLASSES) / total
    wide = part.astype(np.int64)
    if len(part) > 1:
        pair = (wide[:-1] * 31 + wide[1:] * 7) % _PAIRS
        counts = np.bincount(at[:-1] * _PAIRS + pair, minlength=n * _PAIRS).reshape(n, _PAIRS) / total
        out[:, _CLASSES:_CLASSES + _PAIRS] = np.sqrt(counts)
        out[:, -5] = (counts * counts).sum(axis=1) * 10
    if len(part) > 4:
        four = (wide[:-3] + wide[1:-2] * 263 + wide[2:-1] * 69169 + wide[3:] * 18191447) % 65521 % _FOURS
        seen = np.bincount(at[:-3] * _FOURS + four, minlength=n * _FOURS).reshape(n, _FOURS) > 0
        expected = _FOURS * -np.expm1(-np.maximum(size, 1) / _FOURS)
        out[:, -4] = seen.sum(axis=1) / expected
    out[:, -3] = np.log1p(size)
    out[:, -2] = np.log1p(len(data))
    out[:, -1] = 1.0 if len(data) <= PASSAGE else 0.0
    return out


def n_passages(data: bytes) -> int:
    return max(1, -(-len(data) // PASSAGE))


# ---- the network ------------------------------------------------------------------

def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """Weights of the encoder, the gated attention and the output."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: dict[str, np.ndarray]):
        self.mean, self.scale, self.w = mean, scale, weights

    def passages(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encodings and attention logits."""
        w = self.w
        h = np.tanh((x - self.mean) / self.scale @ w["W"] + w["b"])
        return h, np.tanh(h @ w["V"]) * _sigmoid(h @ w["U"]) @ w["a"]

    def score(self, text: str | None) -> float:
        """Attention over all passages, accumulated run by run."""
        data = (text or "").encode("utf-8", "surrogatepass")
        n = n_passages(data)
        top, mass, rep = -np.inf, 0.0, 0.0
        for first in range(0, n, RUN):
            h, g = self.passages(encode(data, first, min(n, first + RUN)))
            new = max(top, float(g.max()))
            e = np.exp(g - new)
            keep = np.exp(top - new)
            rep = rep * keep + e @ h
            mass = mass * keep + e.sum()
            top = new
        return float(_sigmoid(rep / mass @ self.w["c"] + self.w["d"][0]))


def fit(bags: list[np.ndarray], labels: np.ndarray, *, epochs: int = EPOCHS, seed: int = 6) -> Model:
    """Adam on the logistic loss over bags of passage features."""
    rng = np.random.default_rng(seed)
    allx = np.concatenate(bags)
    mean, scale = allx.mean(axis=0), allx.std(axis=0) + 1e-2
    y = labels.astype(np.float64)
    base = np.clip(y.mean(), 0.01, 0.99)

    def normal(*shape):
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    w = {"W": normal(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": normal(HIDDEN, GATE),
         "U": normal(HIDDEN, GATE), "a": normal(GATE), "c": np.zeros(HIDDEN),
         "d": np.array([np.log(base / (1 - base))])}
    m = {k: np.zeros_like(v) for k, v in w.items()}
    s = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    bags = [(b - mean) / scale for b in bags]
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            x = np.concatenate([bags[i] for i in pick])
            size = np.array([len(bags[i]) for i in pick])
            start = np.r_[0, np.cumsum(size)[:-1]]
            seg = np.repeat(np.arange(len(pick)), size)
            h = np.tanh(x @ w["W"] + w["b"])
            t, u = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
            g = t * u @ w["a"]
            e = np.exp(g - np.maximum.reduceat(g, start)[seg])
            att = e / np.add.reduceat(e, start)[seg]
            z = np.add.reduceat(att[:, None] * h, start)
            p = _sigmoid(z @ w["c"] + w["d"][0])
            do = (p - y[pick]) / len(pick)
            dz = do[:, None] * w["c"]
            da = (h * dz[seg]).sum(axis=1)
            dg = att * (da - np.add.reduceat(att * da, start)[seg])
            dt, du = dg[:, None] * w["a"] * u * (1 - t * t), dg[:, None] * w["a"] * t * u * (1 - u)
            dh = (att[:, None] * dz[seg] + dt @ w["V"].T + du @ w["U"].T) * (1 - h * h)
            grad = {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ du,
                    "a": (t * u).T @ dg, "c": z.T @ do, "d": np.array([do.sum()])}
            step += 1
            rate = RATE * (1 - 0.9 * epoch / epochs)
            for k in w:
                m[k] += 0.1 * (grad[k] - m[k])
                s[k] += 0.001 * (grad[k] ** 2 - s[k])
                w[k] -= rate * (m[k] / (1 - 0.9 ** step) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
                                + DECAY * w[k])
    return Model(mean, scale, w)


# ---- Spark ------------------------------------------------------------------------

def train(docs: DataFrame, labels: DataFrame, *, fit_docs: int = FIT_DOCS,
          fit_passages: int = FIT_PASSAGES, id_col: str = "doc_id", text_col: str = "text",
          label_id_col: str = "doc_id", label_col: str = "quality",
          scratch: Scratch | None = None) -> Model | None:
    """Fit on the first ``fit_docs`` labelled documents by a hash of the id, or as
    many as have ``fit_passages`` passages together at most; each with all its
    passages, so one that has more by itself is not fitted on (it is scored).

    ``labels`` must hold training rows only. None if there are none.
    """
    ship(docs.sparkSession)
    marked = (columns(labels, doc_id=label_id_col, y=F.col(f"`{label_col}`").cast("int"))
              .where("doc_id is not null and y in (0, 1)")
              .groupBy("doc_id").agg(F.min("y").alias("y"))
              .join(documents(docs, id_col, text_col).select("doc_id").distinct(), "doc_id", "left_semi")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs))
    # at most fit_docs ids; the scan of the texts keeps only theirs, one row of each
    text = F.coalesce("text", F.lit(""))
    sample = (documents(docs, id_col, text_col).join(F.broadcast(marked), "doc_id").groupBy("doc_id", "y")
              .agg(F.min(F.struct(F.xxhash64(text).alias("h"), text.alias("text"))).alias("one"))
              .select("doc_id", "y", "one.text"))
    sample = (scratch or Scratch(docs.sparkSession)).keep(sample, "fit-sample")
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    size = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / PASSAGE))
    # a document that would pass the bound stays out, whole, and so does one over it by itself
    first = (sample.select("doc_id", size.alias("n")).where(F.col("n") <= fit_passages)
             .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .where(F.col("before") + F.col("n") <= fit_passages).select("doc_id"))
    sample = sample.join(F.broadcast(first), "doc_id")     # at most fit_docs ids again

    def features(batches):
        for b in batches:
            out = []
            for text in b.column(2).to_pylist():
                data = (text or "").encode("utf-8", "surrogatepass")
                n = n_passages(data)
                out.append(b"".join(encode(data, lo, min(n, lo + RUN)).astype(np.float32).tobytes()
                                    for lo in range(0, n, RUN)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())],
                                             ["doc_id", "y", "bag"])

    id_type = sample.schema["doc_id"].dataType.simpleString()
    rows = sorted(sample.mapInArrow(features, f"doc_id {id_type}, y int, bag binary").collect(),
                  key=lambda r: (r["doc_id"], bytes(r["bag"])))
    if not rows:
        return None
    bags = [np.frombuffer(bytes(r["bag"]), np.float32).reshape(-1, FEATURES).astype(np.float64) for r in rows]
    return fit(bags, np.array([r["y"] for r in rows]))


def quality_scores(docs: DataFrame, model: Model | None, *, threshold: float = THRESHOLD,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` of every row; ``predicted`` is ``score >= threshold``."""
    ship(docs.sparkSession)
    rows = documents(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            score = [0.5 if model is None else model.score(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(score, pa.float64()),
                 pa.array([int(s >= threshold) for s in score], pa.int32())],
                ["doc_id", "score", "predicted"])

    return rows.mapInArrow(run, f"doc_id {id_type}, score double, predicted int")


def quality_filter(docs: DataFrame, model: Model | None, *, threshold: float = THRESHOLD,
                   text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, all columns as they are."""
    if model is None:
        return docs
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            keep = [model.score(t) >= threshold for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
