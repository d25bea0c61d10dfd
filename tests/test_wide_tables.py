"""Written tables that grow with the input are not broadcast for the small size of their files."""

from pyspark.sql import functions as F

from limes.session import written, written_wide


def test_regular_rows_are_not_broadcast(spark):
    rows = spark.range(200_000).select(F.col("id"), F.lit(1).alias("x"), F.lit("outer").alias("role"))
    plan = lambda df: df.groupBy("id").agg(F.max("role").alias("r")).join(df, "id")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan(written(rows, "small"))
    assert "BroadcastHashJoin" not in plan(written_wide(rows, "wide")) and "SortMergeJoin" in plan(written_wide(rows, "wide"))
