"""The key index of a period: what it reads, and that rows stay those of a full scan."""

import pytest
from pyspark.sql import functions as F

from pressmill.operators import key_index as ki
from pressmill.operators.dedupe import append_new_only
from pressmill.operators.periods import BATCH_COLUMN, PeriodStore
from pressmill.session import work_path


def _rows(spark, low, high):
    return spark.range(low, high).select(
        F.col("id").alias("ord"), F.format_string("http://s/%d", F.col("id") % 4000).alias("url"), F.lit("t").alias("topic")
    )


def _scan(df):
    """Files and rows the scan of an executed plan has read."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaf = plan.collectLeaves().head()
    return [leaf.metrics().get(name).get().value() for name in ("numFiles", "numOutputRows")]


@pytest.fixture(scope="module")
def index(spark):
    index = ki.KeyIndex(spark, work_path(spark, "keys"))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ki, "PER_BUCKET", 20)
        index.add("b0", _rows(spark, 0, 1000), "url", "topic")  # 64 buckets
        index.add("b1", _rows(spark, 1000, 4000), "url", "topic")  # 256 buckets
    return index


def _probe(spark, low, high):
    return ki.hashed(ki.keyed(_rows(spark, low, high), "url", "topic"))


@pytest.mark.parametrize("low,high", [(10, 13), (3999, 4002), (1_000_000_001, 1_000_000_004)])
def test_few_keys_read_their_buckets_only(spark, index, low, high):
    files, _ = _scan(index.candidates(_probe(spark, low, high), ["b0", "b1"]))
    assert files <= 2 * (high - low)  # of some 320
    assert len(index.held(_probe(spark, low, high), ["b0", "b1"]).collect()) == high - low


def test_bloom_filters_spare_row_groups(spark, index):
    unknown = spark.range(40).select(F.concat(F.lit("http://new/"), "id").alias("_url"), F.lit("t").alias("_topic"))
    probe = ki.hashed(unknown)
    touched = ki._touched([r.bucket for r in probe.select(ki._bucket(ki.MAX_BUCKETS).alias("bucket")).collect()])
    stored = spark.read.parquet(index.root).filter(touched).count()
    files, rows = _scan(index.candidates(probe, ["b0", "b1"]))
    assert files > 40 and rows < stored / 5
    assert index.held(probe, ["b0", "b1"]).count() == 0


def test_many_keys_are_compared_by_bucket(spark, index, monkeypatch):
    monkeypatch.setattr(ki, "PROBES", 5)
    got = index.held(_probe(spark, 0, 6000), ["b0"])
    assert got.count() == 1000
    assert index.held(_probe(spark, 0, 6000), []).count() == 0


def test_appends_give_the_rows_of_a_full_scan(spark):
    store = PeriodStore(spark, work_path(spark, "period"))
    want = None
    for low, high in ((0, 900), (500, 1500), (3990, 4300), (8000, 8100)):
        batch = _rows(spark, low, high)
        want = append_new_only(want, batch)
        got = store.append(batch)
    assert sorted(got.drop(BATCH_COLUMN).collect()) == sorted(want.collect())


def test_missing_and_stale_index_entries_are_made_again(spark):
    store = PeriodStore(spark, work_path(spark, "period"))
    store.append(_rows(spark, 0, 50), batch=0, writer="w")
    index = ki.KeyIndex(spark, f"{store.root}/derived/g000000/keys-url-topic")
    index.drop("b000000000.w.0")
    assert store.append(_rows(spark, 40, 60), batch=1, writer="w").count() == 60
    assert index.has("b000000000.w.0")
    # A replayed batch is compared with those before it, not with itself.
    assert store.append(_rows(spark, 40, 70), batch=1, writer="w").count() == 70
    assert store.append(_rows(spark, 0, 70)).count() == 70
    assert store.compact().count() == 70
    assert store.append(_rows(spark, 60, 80)).count() == 80


def test_an_empty_batch_and_an_empty_period(spark):
    store = PeriodStore(spark, work_path(spark, "period"))
    assert store.append(_rows(spark, 0, 0)).count() == 0
    assert store.append(_rows(spark, 0, 3)).count() == 3
    assert store.append(_rows(spark, 0, 0)).count() == 3
