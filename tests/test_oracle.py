"""Every registered query against its SQL oracle."""

import pytest

from __spark_entry__ import entry
from checks import ORACLES, QUERIES
from compare import difference


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, con, ORACLES[name]) is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_returns_rows(spark):
    df = entry(spark)
    assert df.columns == ["c", "k", "src_load_ts", "batch_id", "etl_load_ts", "etl_updt_ts"]
    assert df.count() > 0
