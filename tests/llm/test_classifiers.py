from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import language_id as hd
from basketry.llm import quality
from basketry.llm.language_id import language_id, prototypes
from basketry.llm.quality import FEATURES, encode, n_passages, quality_filter, quality_scores, train


# ---- language ID -----------------------------------------------------------------

def slow_vector(text, d=64, n=3):
    table = hd.letter_vectors(d, n)
    codes = hd.letter_codes()
    seq = [0]
    for c in (text or "").lower():
        x = int(codes[ord(c)])
        if x or seq[-1]:
            seq.append(x)
    if seq[-1]:
        seq.append(0)
    out = np.zeros(d)
    if not any(seq):
        return out
    for i in range(len(seq) - n + 1):
        v = np.ones(d)
        for place in range(n):
            v = v * table[place][seq[i + place]]
        out += v
    return out


TEXTS = ["the cat sat", "Der Hund, läuft -- schnell!", "", None, "12 34", "é", "a", "ab", "日本語 テキスト x" * 3,
         "le chat  est\nlà " * 50]


@pytest.mark.parametrize("segment", [50_000, 7, 1])
def test_vectors_equal_the_definition(segment, monkeypatch):
    monkeypatch.setattr(hd, "SEGMENT", segment)
    got = hd.vectors(TEXTS, 64, 3)
    for v, t in zip(got, TEXTS):
        assert v.tolist() == slow_vector(t).tolist()


def language_rows(seed, n):
    rng = np.random.default_rng(seed)
    syllables = {"aa": ["th", "ing", "and", "er", "of"], "bb": ["sch", "ein", "ung", "ä", "der"],
                 "cc": ["eau", "ê", "tion", "le", "ou"]}
    rows = []
    for i in range(n):
        lang = ["aa", "bb", "cc"][i % 3]
        words = ["".join(rng.choice(syllables[lang], 3)) for _ in range(30)]
        rows.append((i, " ".join(words), lang, "x"))
    return rows


def test_language_id(spark):
    rows = language_rows(1, 300) + [(500, None, "aa", "x"), (501, "12 ?!", "bb", "x"), (502, "", None, "x"),
                                    (503, "thing " * 40_000, None, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lang_pred string")
    model = prototypes(df.where("doc_id < 200 or doc_id >= 500"))
    assert model[0] == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in language_id(df, model).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    assert [(got[i].lang_pred, got[i].score) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert got[503].lang_pred == "aa"
    assert all(got[i].lang_pred == lang for i, _, lang, _ in rows[200:300])
    nothing = prototypes(df.limit(0))
    assert {r.lang_pred for r in language_id(df, nothing).collect()} == {"und"}
    assert language_id(df.limit(0), model).count() == 0


# ---- quality ------------------------------------------------------------------------

def quality_rows(seed, n):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(["th", "er", "on", "ly"], 3)) for _ in range(int(rng.integers(20, 400)))]
        bad = i % 4 == 0
        text = (" ".join(w.upper() + "!!" for w in words) if bad else " ".join(words) + ".")
        rows.append((i, text, 0 if bad else 1))
    return rows


def test_features_do_not_depend_on_the_run():
    data = ("Abc, déf! " * 300).encode()
    n = n_passages(data)
    whole = encode(data, 0, n)
    assert whole.shape == (n, FEATURES) and n > 5
    for i in range(n):
        assert np.allclose(encode(data, i, i + 1)[0], whole[i], atol=0.02)
    assert encode(b"", 0, 1).shape == (1, FEATURES) and np.isfinite(encode(b"", 0, 1)).all()


def test_score_accumulates_over_runs(monkeypatch):
    rows = quality_rows(2, 80)
    model = quality.fit([encode(t.encode(), 0, n_passages(t.encode())).astype(float) for _, t, _ in rows],
                        np.array([y for _, _, y in rows]), epochs=3)
    long = " ".join(t for _, t, _ in rows)
    whole = model.score(long)
    data = long.encode()
    monkeypatch.setattr(quality, "RUN", n_passages(data) + 1)
    assert model.score(long) == pytest.approx(whole, abs=0.02)
    h, g = model.passages(encode(data, 0, n_passages(data)))
    a = np.exp(g - g.max())
    want = 1 / (1 + np.exp(-((a @ h) / a.sum() @ model.w["c"] + model.w["d"][0])))
    assert model.score(long) == pytest.approx(float(want))


def test_fit_lowers_the_loss():
    rows = quality_rows(3, 200)
    bags = [encode(t.encode(), 0, n_passages(t.encode())).astype(float) for _, t, _ in rows]
    y = np.array([v for _, _, v in rows])

    def loss(epochs):
        model = quality.fit(bags, y, epochs=epochs)
        p = np.array([model.score(t) for _, t, _ in rows])
        return -np.mean(y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))

    assert loss(60) < 0.1 * loss(0)


def test_quality_on_held_out_rows(spark):
    rows = quality_rows(1, 500) + [(900, None, None), (901, "", None), (902, "THE!! " * 30_000, None)]
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows], "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows[:400]] + [(1, None, 0), (7777, 1, 0)],
                                   "doc_id bigint, quality int, text int")
    model = train(docs, labels)
    got = {r.doc_id: r for r in quality_scores(docs, model).collect()}
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    right = sum(got[i].predicted == y for i, _, y in rows[400:500])
    assert right >= 98 and got[902].predicted == 0
    kept = quality_filter(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}
    assert quality_scores(docs.limit(0), model).count() == 0


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert train(docs, labels) is None
    assert [(r.score, r.predicted) for r in quality_scores(docs, None).collect()] == [(0.5, 1)] * 2
    assert quality_filter(docs, None).count() == 2
    one = train(docs, spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, quality int"))
    assert all(r.score > 0.9 for r in quality_scores(docs, one).collect())


def test_quality_never_reads_labels_when_scoring(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string").withColumn("quality", F.lit(0))
    assert quality_scores(docs, None).columns == ["doc_id", "score", "predicted"]


def fitted(monkeypatch):
    """The bags that ``train`` passes to the fit."""
    seen = []
    monkeypatch.setattr(quality, "fit", lambda bags, labels: seen.append([len(b) for b in bags]))
    return seen


def test_quality_is_fitted_on_one_row_of_an_id(spark, monkeypatch):
    seen = fitted(monkeypatch)
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(300)] + [(2, "b"), (3, None), (3, None)],
                                 "doc_id bigint, text string")
    train(docs, spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id bigint, quality int"))
    assert seen == [[1, 1, 1]]


def test_quality_is_fitted_on_every_passage_of_a_document(spark, monkeypatch):
    seen = fitted(monkeypatch)
    docs = spark.createDataFrame([(i, "x" * (512 * 600 + 1)) for i in range(4)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id bigint, quality int")
    train(docs, labels)
    train(docs, labels, fit_passages=1202)
    train(docs, labels, fit_passages=1201)
    assert seen == [[601] * 4, [601] * 2, [601]]


def test_quality_fit_never_passes_its_bound(spark, monkeypatch):
    """One labelled text larger than the bound is not fitted on; the others are."""
    seen = fitted(monkeypatch)
    docs = spark.createDataFrame([(i, "x" * (512 * (1000 if i == 3 else 2))) for i in range(8)],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id bigint, quality int")
    train(docs, labels, fit_passages=100)
    assert seen == [[2] * 7]
    train(docs, labels, fit_passages=5)
    assert seen[1] == [2, 2]
    assert train(docs, labels, fit_passages=1) is None and len(seen) == 2
