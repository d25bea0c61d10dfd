import pathlib
import re

import pytest

from limes.plans import queries

SF = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).parents[1]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["point_lookup", "parent_inference", "nearest_feature", "quantized_lookup", "ring_validity", "scope_filter"])
def test_no_pairing_of_everything(spark, name):
    text = plan(queries.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_semi_join_and_pruned_columns(spark):
    text = plan(queries.QUERIES["used_ways"](spark, SF))
    assert "LeftSemi" in text
    columns = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert columns and all("l_comment" not in c and "p_name" not in c for c in columns)


def test_predicates_reach_the_scan(spark):
    from limes.plans.fixtures import fixture

    text = plan(fixture(spark, SF, "fx_ways").filter("id > 100"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(p_partkey,100\)", text)


def test_nothing_outside_imports_the_text_operators():
    for path in (ROOT / "limes").rglob("*.py"):
        if "llm" not in path.parts:
            assert "limes.llm" not in path.read_text()
