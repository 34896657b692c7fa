import pytest
from oracle import compare

from lexatlas.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    compare(spark, sf_dir, catalogue.QUERIES[name], catalogue.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert catalogue.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
