"""The entry module without what only the training-data operators need."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(*missing: str) -> tuple[list[str], list[str]]:
    code = ("import sys\n" + "".join(f"sys.modules[{m!r}] = None\n" for m in missing)
            + "import __spark_entry__ as e\nprint(*e.queries())\nprint(*e.oracle_sql())\n")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    names, sql = out.stdout.strip("\n").split("\n")
    return names.split(), sql.split()


@pytest.mark.parametrize("missing", ["public_tokenizers", "basketry.llm", "xxhash"])
def test_other_queries_stay(missing):
    names, sql = _names(missing, *["corpus_pipeline"] * (missing == "basketry.llm"))
    from basketry.plans import queries as Q

    assert set(Q.QUERIES) <= set(names) and set(sql) <= set(names)
    assert not [n for n in names if n.startswith("op") and n[2:3].isdigit()] and "pipeline" not in names


def test_operators_stay_without_the_pipeline():
    if not os.path.isdir(os.path.join(ROOT, "basketry", "llm")):
        pytest.skip("the training-data operators are not there")
    names, _ = _names("corpus_pipeline")
    assert "op1_simhash_near_dedup" in names and "pipeline" not in names
