"""Physical plans of the operators that must hold at scale."""

import io
from contextlib import redirect_stdout

import pytest

from pressmill.plans.catalog import QUERIES
from pressmill.session import spread

# Queries whose body runs jobs are checked by their own tests.
LAZY = sorted(
    set(QUERIES)
    - {n for n in QUERIES if n.startswith(("stream_", "scan_", "semantic_", "dedupe_greedy"))}
    - {
        "similar_pairs", "similar_pairs_cut", "enrich_run", "rank_run", "collect_run", "collect_stats", "embed_texts", "curate_run", "score_rows", "upsert_day", "retention_trim",
        "write_period_table", "append_indexed", "counts_by_batch", "window_table", "reject_channel", "reject_counts", "close_period", "export_flat",
    }
)


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_products_and_no_python_rows(name, spark, folder):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


@pytest.mark.parametrize("name", ["first_by_url", "candidate_topk", "rank_top_reserve", "topic_digest"])
def test_rank_filters_are_group_limits_below_the_shuffle(name, spark, folder):
    assert plan(QUERIES[name](spark, folder)).count("WindowGroupLimit") >= 2


def test_global_topk_keeps_no_full_sort(spark, folder):
    assert "TakeOrderedAndProject" in plan(QUERIES["global_topk"](spark, folder))


def test_columns_are_pruned(spark, folder):
    text = plan(QUERIES["counts_by_source_topic"](spark, folder))
    assert "ReadSchema: struct<lang:string,source:string>" in text


def test_one_scan_for_all_profiles(spark, folder):
    text = plan(QUERIES["profile_fanout"](spark, folder))
    assert text.count("Scan parquet") <= 2 and "Join" not in text and "hashpartitioning" not in text


def test_only_small_scans_are_spread(spark, folder):
    scan = spark.read.parquet(f"{folder}/documents.parquet")
    cores = spark.sparkContext.defaultParallelism
    assert spread(scan).rdd.getNumPartitions() == cores
    many = scan.repartition(cores + 1)
    assert spread(many) is many
