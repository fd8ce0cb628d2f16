"""Every registered query against its SQL, on the smallest tables."""

import pytest

import oracle
from catalogue import CHECKS, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    if name in CHECKS:
        assert oracle.compare(df, FOLDER, CHECKS[name]) == []
    else:
        assert df.columns and df.count() > 0
