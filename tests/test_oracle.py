"""Every SQL-backed query against its oracle on the smallest tables."""

import pytest
from oracle_check import compare

from saltmarsh.plans import ORACLE, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(key, spark, small, con):
    got = QUERIES[key](spark, small).toArrow()
    assert compare(got, con.execute(ORACLE[key]).to_arrow_table()) == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
