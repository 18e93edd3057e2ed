"""Driver contract: the flagship runs on sf0.001 and every oracle has a query."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="test data not present")
def test_entry_runs_with_stable_schema(spark):
    a = entry.entry(spark)
    b = entry.entry(spark)
    assert a.schema == b.schema
    assert a.columns == ["segment", "day", "value", "variable", "change", "pct"]
    assert a.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 90


def test_no_exercise_keys_use_reserved_prefixes():
    from sheetmill.exercises import QUERIES

    assert not [k for k in QUERIES if k.lower().startswith("op")]
