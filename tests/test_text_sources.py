"""Text scans: header rule, positional fields, empty inputs (T12, T13, T19)."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from basketry.operators import category_counts
from basketry.sources import (
    first_line,
    read_entities_text,
    read_measurements_text,
    write_entities_text,
    write_measurements_text,
)


def _write(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_header_copies_dropped_quotes_kept(spark, ws):
    path = ws.location("measurements")
    _write(spark, path, ["tid,item,value",
                         '"p1",1,2000000',
                         "TID,ITEM,VALUE",
                         "p2,2,3"])
    rows = sorted(tuple(r) for r in read_measurements_text(spark, path).collect())
    assert rows == [('"p1"', 1, 2000000.0), ("p2", 2, 3.0)]


def test_empty_fifth_field_has_no_category(spark, ws):
    m_path, meta = ws.location("measurements"), ws.location("meta")
    _write(spark, m_path, ["a,b,c", "p1,1,2000000", "p2,1,2000000"])
    _write(spark, meta, ["id,x,y,z,diseases", "p1,a,b,c,", "p2,a,b,c,leukemia"])
    ents = read_entities_text(spark, meta)
    counts = {r.category: r.n for r in category_counts(
        read_measurements_text(spark, m_path), ents).collect()}
    assert counts == {"leukemia": 1}


def test_header_only_files_give_empty_frames(spark, ws):
    m_path, meta = ws.location("measurements"), ws.location("meta")
    _write(spark, m_path, ["tid,item,value"])
    _write(spark, meta, ["id,age,gender,postcode,diseases"])
    m = read_measurements_text(spark, m_path)
    e = read_entities_text(spark, meta)
    assert m.count() == 0 and e.count() == 0
    assert m.schema["value"].dataType == T.FloatType()
    assert category_counts(m, e).count() == 0


def test_malformed_value_raises(spark, ws):
    path = ws.location("measurements")
    _write(spark, path, ["h,h,h", "p1,1,abc"])
    with pytest.raises(PySparkException):
        read_measurements_text(spark, path).collect()


def test_writer_roundtrip_multi_file(spark, ws):
    m = spark.createDataFrame([(f"p{i}", i % 7, float(i) * 1000.5) for i in range(200)],
                              "tid string, item int, value double").repartition(4)
    path = ws.location("measurements")
    write_measurements_text(m, path)
    assert first_line(spark, path) == "tid,item,value"
    back = read_measurements_text(spark, path)
    assert back.count() == 200
    got = sorted((r.tid, r.item, r.value) for r in back.collect())
    want = sorted((r.tid, r.item, float(T.FloatType().fromInternal(r.value)))
                  for r in m.collect())
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]


def test_entities_writer_roundtrip(spark, ws):
    e = spark.createDataFrame([("p1", ["leukemia", "x"]), ("p2", ["lymphoma"])],
                              "tid string, categories array<string>")
    path = ws.location("meta")
    write_entities_text(e, path)
    back = sorted((r.tid, tuple(r.categories)) for r in read_entities_text(spark, path).collect())
    assert back == [("p1", ("leukemia", "x")), ("p2", ("lymphoma",))]


def test_short_entity_header_is_fine(spark, ws):
    # the header has fewer than 5 fields; it is dropped before any parsing
    m_path, meta = ws.location("measurements"), ws.location("meta")
    _write(spark, m_path, ["a,b,c", "p1,1,2000000"])
    _write(spark, meta, ["id,diseases", "p1,a,b,c,leukemia"])
    e = read_entities_text(spark, meta)
    counts = {r.category: r.n for r in category_counts(read_measurements_text(spark, m_path),
                                                       e).collect()}
    assert counts == {"leukemia": 1}


def test_leading_zero_items_are_one_item(spark, ws):
    path = ws.location("measurements")
    _write(spark, path, ["h,h,h", "p1,01,5", "p1,1,6", "p2,10,7"])
    items = sorted(r.item for r in read_measurements_text(spark, path).collect())
    assert items == [1, 1, 10]
    text_items = sorted(r.item for r in read_measurements_text(
        spark, path, item_type=T.StringType()).collect())
    assert text_items == ["01", "1", "10"]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("line", ["p2,x,2e6", "p3,7", "p4,8,abc", ""])
def test_malformed_lines_raise_whatever_the_ansi_setting(spark, ws, ansi, line):
    path = ws.location("measurements")
    _write(spark, path, ["h,h,h", "p1,1,5", line])
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            read_measurements_text(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_path_with_spaces_and_globs(spark, ws):
    path = ws.location("my data/run %41")
    _write(spark, path, ["h,h,h", "p1,1,5", "H,H,H"])
    assert [tuple(r) for r in read_measurements_text(spark, path).collect()] == [("p1", 1, 5.0)]


def test_many_empty_leading_files(spark, ws):
    import os

    path = ws.location("many")
    os.makedirs(path.replace("file:", ""))
    for i in range(300):
        open(f"{path.replace('file:', '')}/a{i:04d}.txt", "w").close()
    with open(f"{path.replace('file:', '')}/b [1].txt", "w") as f:
        f.write("h,h,h\np1,1,5\n")
    assert first_line(spark, path) == "h,h,h"
    assert read_measurements_text(spark, path).count() == 1
    empty = ws.location("empty")
    os.makedirs(empty.replace("file:", ""))
    open(f"{empty.replace('file:', '')}/a.txt", "w").close()
    assert first_line(spark, empty) is None
