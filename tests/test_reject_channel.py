"""Observed counters and the reject channel."""

from pyspark.sql import functions as F
import pytest

from pressmill.operators import quality as ql
from pressmill.plans import run_queries, runs


def _rows(spark, n):
    return spark.range(n).select(F.col("id").alias("ord"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("url"))


def _reason():
    return F.when(F.col("url").isNull(), "empty").when(F.col("ord") > 90, "late")


@pytest.mark.parametrize("n", [0, 1, 100])
def test_both_sides_and_the_counts(spark, n):
    kept, rejected, counts = ql.split_rows(_rows(spark, n), _reason(), ["empty", "late", "never"])
    tagged = _rows(spark, n).withColumn("reason", _reason())
    assert sorted(kept.collect()) == sorted(tagged.filter("reason is null").drop("reason").collect())
    assert sorted(map(str, rejected.collect())) == sorted(map(str, tagged.filter("reason is not null").collect()))
    want = {r.reason: r["count"] for r in tagged.groupBy("reason").count().collect()}
    assert {r.reason: r.n for r in counts.collect()} == {
        "kept": want.get(None, 0), "empty": want.get("empty", 0), "late": want.get("late", 0), "never": 0
    }


def test_the_input_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    rows = _rows(spark, 50).mapInPandas(count, "ord long, url string")
    kept, rejected, counts = ql.split_rows(rows, _reason(), ["empty", "late"])
    assert kept.count() + rejected.count() == 50 and counts.count() == 3
    assert seen.value == 50


def test_each_side_reads_its_own_folder(spark):
    kept, rejected, _ = ql.split_rows(_rows(spark, 30), _reason(), ["empty"])
    for side in (kept, rejected):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(outcome" in plan


def test_collect_counters_come_from_the_writes(spark, folder, monkeypatch):
    """No job counts rows after the writes: the figures are literals by then."""
    stats = run_queries.collect_stats(spark, folder)
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" not in plan.replace("LocalRelation", "") and "Join" not in plan
    assert stats.count() == 1 and runs.Counters is ql.Counters
