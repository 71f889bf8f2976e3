"""The export moves each text once: staged in one shuffle, chosen by keys, looked up at the end."""

from pyspark.sql import functions as F

from pressmill.operators import dedupe as dd
from pressmill.operators import periods as pr
from pressmill.plans import runs
from pressmill.session import work_path
from pressmill.sources import day_cache as dc

TODAY = "2024-03-10"


def _articles(spark):
    rows = spark.range(240).withColumn("day", F.concat(F.lit("2024-03-0"), (F.col("id") % 3 + 7).cast("string")))
    return rows.select(
        F.col("id").alias("ord"),
        F.concat(F.lit("src-"), (F.col("id") % 4).cast("string")).alias("source"),
        F.when(F.col("id") % 5 == 0, "en").otherwise("de").alias("topic"),
        F.floor(F.col("id") / 60).alias("chunk"),
        "day",
        F.col("day").alias("date"),
        F.lit("days").alias("root"),
        F.when(F.col("id") % 11 == 0, "").otherwise(F.concat(F.lit("u"), (F.col("id") % 40).cast("string"))).alias("url"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("t"), (F.col("id") % 50).cast("string"))).alias("title"),
        F.concat(F.lit("text "), "id").alias("text"),
        F.lit("k").alias("matched_keyword"),
    )


def _documents(spark):
    path = dc.stage_documents(_articles(spark), spark, as_table=True)
    return dc.read_documents(spark, path, one_per_line=True)


def test_staging_shuffles_once(spark):
    articles = _articles(spark)
    group = work_path(spark, "one shuffle")
    spark.sparkContext.setJobGroup(group, "staging")
    try:
        path = dc.stage_documents(articles, spark, as_table=True)
    finally:
        spark.sparkContext.setJobGroup("", "")
    # A job per shuffle, and the writing one.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 2
    got = dc.scan_articles(dc.read_documents(spark, path, one_per_line=True))
    names = ["source", "topic", "day", "url", F.coalesce("title", F.lit("-")), "text"]
    assert sorted(got.select(names).collect()) == sorted(articles.select(names).collect())
    # Positions count a day's items in the order of the articles.
    rows = got.select("line", "day", "pos", F.substring("text", 6, 9).cast("int").alias("id")).collect()
    days = {}
    for r in sorted(rows, key=lambda r: r.pos):
        days.setdefault((r.line, r.day), []).append((r.pos, r.id))
    assert all([p for p, _ in held] == list(range(len(held))) for held in days.values())
    assert all(held == sorted(held, key=lambda h: h[1]) for held in days.values())


def test_keys_choose_and_texts_are_looked_up(spark, monkeypatch):
    asked = []
    unseen = pr.unseen_rows
    monkeypatch.setattr(pr, "unseen_rows", lambda incoming, *a: asked.append(incoming.columns) or unseen(incoming, *a))
    docs, today = _documents(spark), F.lit(TODAY).cast("date")
    store = pr.PeriodStore(spark, work_path(spark, "period"))
    got = runs.export_run(docs, store, None, ["en", "de"], 5, today, sources=(), topics=())
    assert "text" not in asked[0]

    # What the whole rows give, in turn: unique per topic and source, then each (url, topic) once.
    kept = runs.cached_articles(docs, None, ["en", "de"], 5, today, sources=())
    want, taken = [], set()
    for r in kept.orderBy("ord").collect():
        if r.url == "" or (r.url, r.topic) not in taken:
            taken.add((r.url, r.topic))
            want.append((r.url, r.topic, r.title, r.text, r.source))
    names = ["url", "topic", "title", "text", "source"]
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want) and len(want) > 20
    assert got.columns == ["ord", "news_date", "title", "text", "url", "source", "topic", "keywords", pr.BATCH_COLUMN]
    before = got.filter("url <> ''").count()
    again = runs.export_run(docs, store, None, ["en", "de"], 5, today, sources=(), topics=())
    assert again.filter("url <> ''").count() == before


def test_a_round_reads_settled_rows(spark, monkeypatch):
    read = {}
    write = dd.written

    def watched(df, name):
        read.setdefault(name, df.inputFiles())
        return write(df, name)

    rows = _articles(spark)
    rows.write.parquet(path := work_path(spark, "articles"))
    monkeypatch.setattr(dd, "written", watched)
    dd.dedupe_greedy(spark.read.parquet(path), ["topic"]).collect()
    assert read["greedy_round"] and all("greedy_pending" in f for f in read["greedy_round"])
