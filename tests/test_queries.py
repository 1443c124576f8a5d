"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_registered_queries_match_oracle(spark):
    from oracle_check import compare
    results = list(compare(spark, SF))
    failed = [(n, m) for n, s, m in results if s == "FAIL"]
    assert not failed, failed
    assert sum(s == "OK" for _, s, _ in results) >= 50


def test_entry_contract(spark):
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert df.columns[0] == "pace_rank" and df.count() > 0
