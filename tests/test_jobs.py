"""End-to-end text jobs: inputs written from the fixture tables, reports read back."""

from __future__ import annotations

import brute
from conftest import SF0001
from pyspark.sql import functions as F

from basketry.plans import category_count_job, itemset_job, rule_job
from basketry.plans import tables as fx
from basketry.sources import write_entities_text, write_measurements_text


def _lines(path):
    """Report lines in file-name order (the sinks' total order)."""
    import glob
    import os
    local = path.replace("file:", "")
    out = []
    for f in sorted(glob.glob(os.path.join(local, "part-*"))):
        with open(f) as fh:
            out.extend(fh.read().splitlines())
    return out


def _inputs(spark, ws):
    geo, meta = ws.location("measurements"), ws.location("meta")
    write_measurements_text(fx.fb_measurements(spark, SF0001), geo)
    write_entities_text(fx.fb_entities(spark, SF0001), meta)
    return geo, meta


def test_three_jobs_chain(spark, ws):
    geo, meta = _inputs(spark, ws)
    out1, out2, out3 = ws.location("one"), ws.location("two"), ws.location("three")
    category_count_job(spark, geo, meta, out1, cutoff=fx.FB_CUTOFF,
                       substring="ING", names=("household",))
    lines1 = _lines(out1)
    cats = dict((x.split("\t")[0], int(x.split("\t")[1])) for x in lines1)
    assert set(cats) == {"BUILDING", "HOUSEHOLD"}

    mined = itemset_job(spark, geo, meta, out2, min_support=fx.FB_MIN_SUPPORT,
                        max_size=3, cutoff=fx.FB_CUTOFF,
                        categories=fx.FB_CATEGORIES, distinct=False).mining
    report = _lines(out2)
    supports = [int(x.split("\t")[0]) for x in report]
    assert supports == sorted(supports, reverse=True) and len(set(supports)) == len(supports)
    listed = sum(len(x.split("\t")) - 1 for x in report)
    assert listed == mined.itemsets.count()

    rules = rule_job(spark, out2, out3, min_confidence=fx.FB_MIN_CONFIDENCE)
    lines3 = _lines(out3)
    assert len(lines3) == rules.count() > 0
    confs = [float(x.split("\t")[2]) for x in lines3]
    assert confs == sorted(confs, reverse=True)
    freq = {tuple(r["items"]): r["support"] for r in mined.itemsets.collect()}
    want = brute.rules(freq, fx.FB_MIN_CONFIDENCE)
    got = {(tuple(int(x) for x in a.split(" ")), tuple(int(x) for x in c.split(" "))): float(v)
           for a, c, v in (x.split("\t") for x in lines3)}
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) <= 1e-6 * max(1.0, want[k]) for k in want)


def test_category_job_matches_parquet_path(spark, ws):
    geo, meta = _inputs(spark, ws)
    out = ws.location("one")
    counts = category_count_job(spark, geo, meta, out, cutoff=fx.FB_CUTOFF,
                                substring="ING", names=())
    direct = (fx.fb_measurements(spark, SF0001)
              .where(F.col("value").cast("float") > F.lit(fx.FB_CUTOFF).cast("float"))
              .join(fx.fb_entities(spark, SF0001), "tid")
              .select(F.explode("categories").alias("category"))
              .where(F.col("category").contains("ING"))
              .groupBy("category").count())
    assert {r.category: r.n for r in counts.collect()} == \
        {r.category: r["count"] for r in direct.collect()}
