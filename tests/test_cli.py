"""The command line drives the same three jobs."""

from __future__ import annotations

import pytest
from conftest import SF0001

from basketry.__main__ import main
from basketry.plans import tables as fx
from basketry.session import Workspace
from basketry.sources import write_entities_text, write_measurements_text


def test_cli_runs_the_three_jobs(spark, ws):
    m, e = ws.location("measurements"), ws.location("entities")
    write_measurements_text(fx.fb_measurements(spark, SF0001), m)
    write_entities_text(fx.fb_entities(spark, SF0001), e)
    one, two, three = ws.location("one"), ws.location("two"), ws.location("three")
    assert main(["category-count", m, e, one, "--cutoff", "50000",
                 "--substring", "ING", "--names", "household"], spark) == 0
    assert main(["itemsets", m, e, two, "--min-support", "0.2", "--max-size", "3",
                 "--cutoff", "50000", "--categories", "BUILDING", "MACHINERY",
                 "--single-file"], spark) == 0
    made = list(Workspace.made)
    assert main(["rules", two, three, "--min-confidence", "0.6"], spark) == 0
    four, five, sets = ws.location("four"), ws.location("five"), ws.location("sets")
    assert main(["itemsets", m, e, four, "--min-support", "0.2", "--max-size", "3",
                 "--cutoff", "50000", "--categories", "BUILDING", "MACHINERY",
                 "--item-type", "string", "--table", sets], spark) == 0
    assert main(["rules", sets, five, "--from-table"], spark) == 0
    assert Workspace.made == made     # nothing intermediate is left
    assert spark.read.text(five).count() > 0
    assert {r.value.split("\t")[0] for r in spark.read.text(one).collect()} == \
        {"BUILDING", "HOUSEHOLD"}
    assert len(spark.read.text(two).inputFiles()) == 1
    assert spark.read.text(three).count() > 0


def test_cli_rejects_missing_arguments(spark):
    with pytest.raises(SystemExit):
        main(["itemsets", "only-one-path"], spark)
