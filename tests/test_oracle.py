"""Every registered query against its DuckDB oracle at sf0.01 (the driver's check)."""

import os
import sys

import pytest

import __spark_entry__ as E
from clicklens import registry

from paths import ROOT, SF01, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import compare  # noqa: E402


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["task_id", "category_id", "click_count", "order_count", "pay_count"]
    assert SF001 in E.SMOKE_DIR


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_matches_oracle(spark, name):
    res = compare(spark, SF01, [name], verbose=False)[name]
    assert res[0] in ("match", "rows-only"), res
    if res[0] == "rows-only":
        assert res[1] > 0
