"""Every registered query against its DuckDB oracle (sf0.001), and the merge fixture counts."""

import pytest

from helpers import SF0001, SF001


def test_all_queries_match_oracle(spark):
    from tools.oracle_check import compare

    res = compare(spark, SF0001)
    bad = {k: v for k, v in res.items() if v.get("match") is False or v.get("type_mismatch")}
    assert not bad, bad
    assert all(v.get("spark_rows", 0) > 0 for v in res.values())


def test_merge_fixture_counts_sf001(spark):
    import __spark_entry__ as e

    got = {r.action: r.key_count for r in e.queries()["merge_action_counts"](spark, SF001).collect()}
    assert got == {"delete": 1362, "ignore": 7075, "insert": 13905, "keep": 12798, "update": 2800}


@pytest.mark.parametrize("name", ["gold_daily"])
def test_entry_runs(spark, name):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "fecha"
