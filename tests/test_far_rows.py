"""Queries over the lattice's rows far up, as larger tables have them, against their statements."""

import pytest
from pyspark.sql import functions as F

from limes.plans.queries import ORACLES, QUERIES
from tests.oracle import duck, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def far(spark, tmp_path_factory):
    """Three blocks' rows of cells, some 1,200,000 units up."""
    path = tmp_path_factory.mktemp("far")
    customers = spark.read.parquet(f"{SF}/customer.parquet")
    shape = dict(customers.dtypes)
    spark.range(300_000, 300_450).select(F.col("id").cast(shape["c_custkey"]).alias("c_custkey")).coalesce(1).write.parquet(f"{path}/customer.parquet")
    return str(path)


@pytest.mark.parametrize("name", ["polygon_outcomes", "country_report"])
def test_nodes_far_up(spark, far, name):
    assert spark_rows(QUERIES[name](spark, far)) == duck(ORACLES[name].replace("FROM customer", f"FROM '{far}/customer.parquet/*.parquet'"), SF)
