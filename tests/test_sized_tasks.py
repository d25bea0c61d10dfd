"""Tasks hold a bounded number of rows, whatever the session's shuffle partitions."""

import pytest

import __spark_entry__
from limes import session

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["member_types", "gap_candidates"])
def test_partitions_grow_with_the_rows(spark, monkeypatch, name):
    query = __spark_entry__.queries()[name]
    whole = query(spark, SF)
    monkeypatch.setattr(session, "ROWS_PER_TASK", 500)
    made = query(spark, SF)
    assert made.rdd.getNumPartitions() >= spark.read.parquet(f"{SF}/lineitem.parquet").count() / 500 > 4
    assert sorted(map(repr, made.collect())) == sorted(map(repr, whole.collect()))


def test_nodes_of_relations_are_dealt_by_their_number(spark, monkeypatch):
    query = __spark_entry__.queries()["element_coverage"]
    whole = query(spark, SF)
    monkeypatch.setattr(session, "ROWS_PER_TASK", 500)
    made = query(spark, SF)
    assert "RepartitionByExpression [id" in made._jdf.queryExecution().optimizedPlan().toString() and "BroadcastExchange" not in made._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, made.collect())) == sorted(map(repr, whole.collect()))


def test_cells_of_rings_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 500)
    made = __spark_entry__.queries()["ring_validity"](spark, SF)
    assert "], 48" in made._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["endpoint_degrees", "member_coverage", "relation_report"])
def test_ways_are_not_broadcast(spark, name):
    assert "BroadcastExchange" not in __spark_entry__.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
