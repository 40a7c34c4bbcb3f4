"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the same check the driver runs at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() >= 0
    assert "request_id" in df.columns


def test_every_query_has_an_oracle():
    from boardlake.plans import queries as Q

    assert set(Q.spark_queries()) == set(Q.oracle_queries())


def test_all_queries_match_oracle(spark):
    from parity import compare

    from boardlake.plans import queries as Q

    results = compare(spark, SF, names=sorted(Q.spark_queries()), verbose=False)
    bad = {k: v for k, v in results.items() if v[0] != "match"}
    assert not bad, bad
