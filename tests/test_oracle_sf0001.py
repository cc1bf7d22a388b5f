"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os

import pytest

SF = "/root/testdata/sf0.001"


def _names():
    from ledgerlens.plans import registry
    return sorted(registry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    import __spark_entry__ as E
    from tools.oracle_check import compare, duck
    sql = E.oracle_sql().get(name)
    res = compare(spark, SF, name, E.queries()[name], sql, duck(SF))
    if sql is None:
        assert res["rows"] >= 0
    else:
        assert res["cols_match"], res
        assert res["match"], res


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    from ledgerlens.plans import registry
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(E.queries())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert len(df.columns) == 33
    assert df.count() > 0
