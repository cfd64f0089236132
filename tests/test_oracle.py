"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from oracle import compare

SF = "/root/testdata/sf0.01"
ORACLES = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    (s_cols, s_rows), (d_cols, d_rows) = compare(spark, SF, E.queries()[name], ORACLES[name])
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
