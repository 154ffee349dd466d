"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    if not os.path.isdir(FOLDER):
        pytest.skip("no benchmark tables here")
    return compare.oracle(FOLDER)


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(entry._CASES))
def test_query(spark, oracle, name, capsys):
    df = entry.queries()[name](spark, FOLDER)
    df.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    verdict, _, _ = compare.compare(spark, oracle, name, FOLDER, df)
    assert verdict.startswith(("ok", "rows only"))
