"""Joins of op5's postings, whose size Spark tells from the nodes, one row for 20 of them."""

from pyspark.sql import functions as F

from pressmill.llm import lsh_forest as lf


def test_postings_are_never_broadcast(spark, tmp_path):
    nodes = spark.range(40).select(
        F.col("id").cast("string").alias("node"),
        F.transform(F.sequence(F.lit(0), F.lit(19)), lambda t: (F.col("id") % (t + 2)).cast("int")).alias("keys"),
    )
    nodes.write.parquet(f"{tmp_path}/nodes")
    work = lf._work(spark.read.parquet(f"{tmp_path}/nodes"), 20, 10)
    plan = work._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    met = work.filter("tree = 0").select("node").distinct().count()
    assert met == 40
