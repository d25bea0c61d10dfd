import pytest

from limes.plans import queries
from tests.oracle import duck, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_duckdb(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, SF)) == duck(queries.ORACLES[name], SF)


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1


def test_every_statement_has_a_query():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
