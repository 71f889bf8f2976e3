"""Cache documents staged as a table: the rows of the folders, without a file per site."""

from pathlib import Path

from pyspark.sql import functions as F

from pressmill.sources import day_cache as dc

ITEM = ["source", "topic", "day", "pos", "url", "title", "text"]


def _articles(spark, sites):
    rows = spark.range(sites * 6).withColumn("site", F.floor(F.col("id") / 6))
    source = F.concat(F.lit("src-"), F.col("site").cast("string"))
    return rows.select(
        F.col("id").alias("ord"),
        F.when(F.col("site") == 3, F.lit(None)).when(F.col("site") == 4, "").otherwise(source).alias("source"),
        F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("topic"),
        F.col("site").alias("chunk"),
        F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")).alias("day"),
        F.lit("days").alias("root"),
        F.concat(F.lit("u"), "id").alias("url"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise('a "title"\twith\nlines').alias("title"),
        F.lit("ü").alias("text"),
    )


def test_table_gives_the_rows_of_the_folders(spark):
    rows = _articles(spark, 12)
    got = []
    for as_table in (False, True):
        path = dc.stage_documents(rows, spark, as_table)
        docs = dc.read_documents(spark, path, one_per_line=True)
        got.append(sorted(map(str, dc.scan_articles(docs).select(ITEM).collect())))
        few = dc.read_documents(spark, path, True, sources=["src-1", "src-2"], topics=["en"])
        assert {(r.source, r.topic) for r in few.collect()} == {("src-1", "en"), ("src-2", "en")}
    assert len(got[0]) == 72 and got[0] == got[1]


def test_sites_share_files(spark):
    path = dc.stage_documents(_articles(spark, 150), spark, as_table=True)
    files = list(Path(path.removeprefix("file:")).rglob("part-*"))
    assert dc.read_documents(spark, path, one_per_line=True).count() == 300
    assert 0 < len(files) <= 8


def test_the_daily_run_has_no_file_per_site(spark, folder, monkeypatch):
    from pressmill.plans import run_queries as rq

    paths = []
    stage = dc.stage_documents
    monkeypatch.setattr(dc, "stage_documents", lambda *a, **k: paths.append(stage(*a, **k)) or paths[-1])
    kept = rq.export_run(spark, folder)
    sites = kept.select("source", "topic").distinct().count()
    files = list(Path(paths[0].removeprefix("file:")).rglob("part-*"))
    assert 0 < len(files) < sites
