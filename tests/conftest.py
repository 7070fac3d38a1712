from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry.session import Workspace, checkpoint_root, local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, "basketry-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # sets a local folder only if the session has none
    yield s
    s.stop()


@pytest.fixture()
def ws(spark):
    return Workspace(spark)


def measurements(spark, rows, value_type="double"):
    """rows: (tid, item, value)."""
    return spark.createDataFrame(rows, f"tid string, item int, value {value_type}")


def entities(spark, rows):
    """rows: (tid, 'space separated categories')."""
    df = spark.createDataFrame(rows, "tid string, attr string")
    from pyspark.sql import functions as F
    return df.select("tid", F.split("attr", " ", -1).alias("categories"))


def tx_frame(spark, rows):
    """rows: (tid, item, m)."""
    return spark.createDataFrame(rows, "tid string, item int, m bigint")
