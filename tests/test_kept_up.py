"""Counts kept up by batch, and windows by dynamic partition pruning."""

from pyspark.sql import functions as F
import pytest

from pressmill.operators import windows as wn
from pressmill.operators.batch_counts import BatchCounts
from pressmill.operators.periods import PeriodStore
from pressmill.session import work_path


def _rows(spark, low, high, topic="t"):
    return spark.range(low, high).select(
        F.col("id").alias("ord"), F.col("id").cast("string").alias("url"), F.lit(topic).alias("topic")
    )


def _counts(store):
    return BatchCounts(store, "n", ["topic"], n=F.count(F.lit(1)), total=F.sum("ord"))


def _sorted(df):
    return sorted(map(tuple, df.collect()))


def _scanned(store):
    return _sorted(store.read_open().groupBy("topic").agg(F.count(F.lit(1)), F.sum("ord")))


def test_counts_equal_a_scan_after_each_append(spark):
    store = PeriodStore(spark, work_path(spark, "period"))
    assert _counts(store).current() is None
    for low, high, topic in ((0, 30, "a"), (20, 50, "a"), (0, 10, "b"), (60, 60, "b")):
        store.append(_rows(spark, low, high, topic))
        assert _sorted(_counts(store).current()) == _scanned(store)
    assert all("/rows/" not in f for f in _counts(store).current().inputFiles())


def test_a_replayed_batch_is_counted_again(spark):
    store = PeriodStore(spark, work_path(spark, "period"))
    store.append(_rows(spark, 0, 30), batch=0, writer="w")
    store.append(_rows(spark, 0, 40), batch=1, writer="w")
    assert _sorted(_counts(store).current()) == [("t", 40, sum(range(40)))]
    store.append(_rows(spark, 0, 45), batch=1, writer="w")
    assert _sorted(_counts(store).current()) == [("t", 45, sum(range(45)))] == _scanned(store)


def test_a_replaced_or_closed_period_starts_anew(spark):
    store = PeriodStore(spark, work_path(spark, "period"))
    store.append(_rows(spark, 0, 30))
    _counts(store).current()
    store.replace(store.read_open().filter("ord < 5"))
    assert _sorted(_counts(store).current()) == [("t", 5, 10)]
    store.close("p")
    assert _counts(store).current() is None


@pytest.fixture(scope="module")
def day_table(spark):
    path = work_path(spark, "days")
    rows = spark.range(400).select(
        "id", F.concat(F.lit("s"), F.col("id") % 4).alias("source"), F.expr("date_sub(date'2024-03-31', int(id div 4))").alias("day")
    )
    rows.repartition("source", "day").write.partitionBy("source", "day").parquet(path)
    return path


def _files_read(plan):
    leaves = plan.collectLeaves()
    for leaf in map(leaves.apply, range(leaves.size())):
        if "Stage" in leaf.getClass().getSimpleName():  # a stage of an adaptive plan
            yield from _files_read(leaf.plan())
        elif leaf.metrics().contains("numFiles"):
            yield leaf.metrics().get("numFiles").get().value()


def test_windows_prune_partitions(spark, day_table):
    windows = spark.createDataFrame([("s0", 3), ("s1", 1), ("s2", 0), ("none", 2)], "source string, days int")
    today = F.lit("2024-03-30").cast("date")
    got = wn.in_window_table(spark.read.parquet(day_table), windows, today)
    rows = _sorted(got.select("source", F.col("day").cast("string")))
    assert rows == [("s0", f"2024-03-{d}") for d in (28, 29, 30)] + [("s1", "2024-03-30")]
    plan = got._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    plan.execute().count()
    # Each partition column is pruned on its own: two sources by three days, of 400 files.
    assert list(_files_read(plan.executedPlan()))[0] == 6
