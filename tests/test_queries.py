"""Every registered query against its SQL, on whole (small) tables."""

import pytest

import compare
from mailflow.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert compare.difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    result = entry.entry(spark)
    assert result.columns == ["email_format", "file_count", "percentage"]
    assert abs(sum(r.percentage for r in result.collect()) - 100) < 0.1
