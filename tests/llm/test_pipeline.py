"""The pipeline against brute-force versions of its stages, and the SQL queries."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np
import pytest
from test_decontamination import brute as brute_leaks
from test_line_dedup import brute as brute_lines
from test_simhash import classes, close, slow_fingerprint
from test_tokens import check_pieces

import __spark_entry__ as entry
import corpus_pipeline
from basketry.llm import queries as Q
from basketry.llm.common import crc_mod
from basketry.llm.quality import train
from basketry.session import Workspace

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF0001}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF0001)
    want = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """A small corpus with every kind of case, as files."""
    rng = np.random.default_rng(12)
    words = ["".join(rng.choice(["th", "er", "on", "ly", "st"], 2)) for _ in range(400)]

    def text(n):
        return " ".join(rng.choice(words, n))

    shared = [text(60) for _ in range(3)]
    items = [(i, text(30)) for i in range(5)]
    docs, labels = [], []
    for i in range(160):
        t = "\n".join(text(int(rng.integers(30, 80))) for _ in range(3))
        bad = i % 5 == 0
        if bad:
            t = " ".join(w.upper() + "!!" for w in t.split())
        elif i % 7 == 0:
            t += "\n" + shared[i % 3]
        elif i % 11 == 0:
            t += " " + " ".join(items[i % 5][1].split()[3:20])
        docs.append((i, t, "en", f"s{i % 17}", len(t)))
        labels.append((i, 0 if bad else 1, 0))
    for i in range(40):
        source = docs[1 + 5 * (i % 12)]
        t = source[1] if i % 2 else source[1].replace(" ", "  ", 1).upper().lower()
        docs.append((200 + i, t, "en", "s1", len(t)))
    docs += [(300, None, None, None, None), (301, "", "en", "s2", 0), (302, "w " * 5000, "en", "s3", 10000)]
    folder = str(tmp_path_factory.mktemp("sf"))
    for name, rows, schema in (
            ("documents", docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
            ("labels", labels, "doc_id bigint, quality int, toxic int"),
            ("benchmark", items, "item_id bigint, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_stages_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    start = rows_of(docs)

    out = stage("quality classifier")(spark, docs, sf)
    assert out.columns == docs.columns
    model = train(docs, spark.read.parquet(f"{sf}/labels.parquet").where(crc_mod("doc_id", 5) != 0))
    kept = rows_of(out)
    assert set(kept) == {i for i, r in start.items() if model.score(r.text) >= 0.3}
    assert all(kept[i] == start[i] for i in kept)
    clean = [i for i in range(160) if i % 5]
    assert set(clean) <= set(kept) and not set(range(0, 160, 5)) & set(kept)

    docs = spark.createDataFrame(list(kept.values()), docs.schema)
    out = stage("line dedup")(spark, docs, sf)
    assert out.schema.names == docs.schema.names
    want = {i: t for i, _, _, t in brute_lines([(r.doc_id, r.text, r.source) for r in kept.values()], 10)}
    lined = rows_of(out)
    assert {i: r.text for i, r in lined.items()} == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in lined.values())

    docs = spark.createDataFrame(list(lined.values()), docs.schema)
    single = rows_of(stage("SimHash near-dedup")(spark, docs, sf))
    ordered = sorted(lined)
    label = classes([slow_fingerprint(lined[i].text) for i in ordered], close)
    assert set(single) == {ordered[x] for x in set(label)}
    assert all(single[i] == lined[i] for i in single)

    docs = spark.createDataFrame(list(single.values()), docs.schema)
    free = rows_of(stage("benchmark decontamination")(spark, docs, sf))
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaks = {r[0]: r[-1] for r in brute_leaks([(i, r.text) for i, r in single.items()], items)}
    assert set(free) == {i for i in single if not leaks[i]} and any(leaks.values())

    ids = sorted(free)
    place = {d: n for n, d in enumerate(ids)}
    docs = spark.createDataFrame([(place[i], free[i].text) for i in ids], "doc_id bigint, text string")
    check_pieces(stage("packing")(spark, docs, sf).collect(), [free[i].text for i in ids])
    whole = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in whole} == set(ids)


def test_stages_on_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        out = f(spark, docs, sf)
        assert out.count() == 0


def test_rows_that_share_an_id_or_have_none_are_judged_each(spark, sf):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").collect()]
    rng = np.random.default_rng(5)
    own = [" ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(60)) for _ in range(6)]

    def left(name, rows):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string")
        out = stage(name)(spark, docs, sf)
        assert out.schema.names == docs.schema.names
        return sorted(((r.doc_id, r.text, r.row) for r in out.collect()), key=str)

    leak = own[0] + " " + items[0][1]
    assert left("benchmark decontamination", [
        (None, leak, "a"), (None, own[1], "b"), (None, own[2], "c"),
        (7, leak, "d"), (7, own[3], "e"), (8, own[4], "f")]) == sorted(
        [(None, own[1], "b"), (None, own[2], "c"), (7, own[3], "e"), (8, own[4], "f")], key=str)
    got = left("SimHash near-dedup", [
        (1, own[0], "x"), (None, own[0], "y"), (None, own[1], "b"),   # a null is near an id
        (2, own[2], "c"), (3, own[2], "z"), (3, own[3], "d"),         # 3 is a copy once only
        (4, own[4], "e"), (4, own[4], "e"),                           # the smallest id repeated
        (None, own[5], "f"), (None, own[5], "f")])                    # copies without ids
    assert got == sorted([(1, own[0], "x"), (None, own[1], "b"), (2, own[2], "c"), (3, own[3], "d"),
                          (4, own[4], "e"), (None, own[5], "f")], key=str)


def test_every_operator_has_a_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and corpus_pipeline.ORACLE_SQL is None


def test_a_run_leaves_its_last_stage_only(spark):
    made = len(Workspace.made)
    pieces = corpus_pipeline.run(spark, SF0001)
    assert pieces.count() > 0
    left = Workspace.made[made:]
    assert len(left) == 1 and os.listdir(left[0].replace("file:", "")) == ["benchmark-decontamination"]
