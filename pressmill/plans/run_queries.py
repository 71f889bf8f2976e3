"""Queries of the three daily runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressmill.operators.periods import PeriodStore
from pressmill.plans import runs
from pressmill.operators.similarity import hashed_vectors
from pressmill.plans.dedupe_queries import hashed_cosines
from pressmill.plans.ranking_queries import ALL_TOPICS
from pressmill.plans.registry import query
from pressmill.plans.standins import ART, PACKS, VERDICTS, articles
from pressmill.schema import Topic
from pressmill.session import work_path
from pressmill.sources import day_cache as dc

_TODAY = "2024-01-28"

# Every 600 ids are a site of their own, so a cache document stays small. The sites grow
# with the rows, so the documents are kept as a table: a folder each would be a file each.
_CACHED = (
    ART
    + f""", held AS (
  SELECT ord, title, url, topic, source || '-' || (ord // 600) AS site, news_date,
    row_number() OVER (ORDER BY news_date DESC, ord) AS place FROM art WHERE news_date >= DATE '{_TODAY}' - 20),
  p0 AS (SELECT *, nullif(url, '') AS u, nullif(title, '') AS t FROM held)"""
)


def _kept_sql() -> str:
    """CTEs up to ``kept``: the rows of the open period."""
    ctes = [_CACHED]
    for n in range(8):
        ctes.append(
            f"""k{n} AS (SELECT * FROM p{n}
      QUALIFY (u IS NULL OR place = min(place) OVER (PARTITION BY site, topic, u))
        AND (t IS NULL OR place = min(place) OVER (PARTITION BY site, topic, t)))"""
        )
        ctes.append(
            f"""p{n + 1} AS (SELECT * FROM p{n} p WHERE ord NOT IN (SELECT ord FROM k{n})
      AND NOT EXISTS (SELECT 1 FROM k{n} k WHERE k.site = p.site AND k.topic = p.topic AND k.u = p.u)
      AND NOT EXISTS (SELECT 1 FROM k{n} k WHERE k.site = p.site AND k.topic = p.topic AND k.t = p.t))"""
        )
    every = " UNION ALL ".join(f"SELECT * FROM k{n}" for n in range(8))
    # The append takes each (url, topic) once, in the order of the run: site, day, id.
    kept = f"""SELECT * FROM ({every})
      QUALIFY url = '' OR row_number() OVER (PARTITION BY url, topic ORDER BY site, news_date DESC, ord) = 1"""
    return f"""{', '.join(ctes)}, kept AS ({kept})"""


def _export_sql() -> str:
    return f"""WITH {_kept_sql()}
      SELECT strftime(news_date, '%d.%m.%Y') AS news_date, title, url, site AS source,
        CASE topic WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' ELSE 'Spanish' END AS topic,
        'k' || (ord % 3) AS keywords FROM kept"""


def _period(spark, d):
    art = articles(spark, d)
    chunk = F.floor(F.col("ord") / 600)
    rows = art.withColumns(
        {
            "source": F.concat_ws("-", "source", chunk.cast("string")),
            "chunk": chunk,
            "day": F.col("news_date").cast("string"),
            "date": F.col("news_date").cast("string"),
            "root": F.lit("days"),
            "matched_keyword": F.concat(F.lit("k"), (F.col("ord") % 3).cast("string")),
        }
    )
    docs = dc.read_documents(spark, dc.stage_documents(rows, spark, as_table=True), one_per_line=True)
    store = PeriodStore(spark, work_path(spark, "period"))
    topics = [t.id for t in ALL_TOPICS]
    today = F.lit(_TODAY).cast("date")
    runs.export_run(docs, store, None, topics, 20, today, sources=(), topics=ALL_TOPICS)
    return store


@query("export_run", _export_sql())
def export_run(spark, d):
    """Day caches to the open period: scan, window, dedupe, project, append."""
    return _period(spark, d).read_open().select("news_date", "title", "url", "source", "topic", "keywords")


# An exported row names its topic by the title.
_NAMED = tuple(Topic(t.id, t.title, (t.title, *t.aliases)) for t in ALL_TOPICS)


# A reply scores its url's number; urls that end in 7 always fail.
def _score_replies(prompts):
    failing = [p for p in prompts if p.endswith("7")]
    if failing:
        raise RuntimeError(f"refused {failing[0]}")
    return [f'{{"score": {int(p.rpartition("/")[2]) * 4}, "summary": "s"}}' for p in prompts]


_ENRICHED = f"""WITH RECURSIVE {_kept_sql()},
    marked AS (SELECT *, CASE WHEN url LIKE '%7' THEN 0 ELSE CAST(split_part(url, '/', 2) AS INTEGER) * 4 END AS score,
      row_number() OVER (ORDER BY list_position(['en', 'de', 'fr', 'es'], topic), site, news_date DESC, ord) AS id FROM kept),
    rows AS (SELECT id, topic AS scope, title AS text FROM marked),
    {hashed_cosines("rows", 64)},
    links AS (SELECT l, r FROM cosines WHERE cosine >= 0.995),
    reach(id, other) AS (SELECT l, r FROM links UNION SELECT r, l FROM links
      UNION SELECT reach.id, CASE WHEN links.l = reach.other THEN links.r ELSE links.l END
      FROM reach JOIN links ON reach.other IN (links.l, links.r)),
    beaten AS (SELECT DISTINCT a.id FROM reach JOIN marked a ON a.id = reach.id JOIN marked b ON b.id = reach.other
      WHERE (b.score, -b.id) > (a.score, -a.id)),
    enriched AS (SELECT * FROM marked WHERE id NOT IN (SELECT id FROM beaten))"""


def _enriched(spark, d):
    store = _period(spark, d)

    def embed(rows):
        return hashed_vectors(rows, "row_id", "title", 64)

    return runs.enrich_run(
        store, work_path(spark, "scores"), _score_replies, F.col("url"), embed, _NAMED, threshold=0.995, waves=2
    )


@query(
    "enrich_run",
    _ENRICHED
    + """ SELECT url, title, topic AS topic_id, score, url NOT LIKE '%7' AND score >= 60 AS is_candidate,
      url LIKE '%7' AS failed FROM enriched""",
)
def enrich_run(spark, d):
    """Score the period with a scorer that refuses some rows, drop semantic copies."""
    failed = F.col("reason").contains("refused")
    return _enriched(spark, d).select(
        "url", "title", "topic_id", "score", "is_candidate", F.coalesce(failed, F.lit(False)).alias("failed")
    )


@query(
    "rank_run",
    _ENRICHED
    + """, places AS (SELECT id, row_number() OVER (PARTITION BY topic ORDER BY score DESC, id) AS pos
      FROM enriched WHERE score >= 60)
    SELECT url, topic AS topic_id, CASE WHEN pos <= 15 THEN CAST(pos AS INTEGER) END AS top_rank,
      coalesce(pos <= 10, false) AS is_top FROM enriched LEFT JOIN places USING (id)""",
)
def rank_run(spark, d):
    ranked = runs.rank_run(_enriched(spark, d), topics=_NAMED)
    return ranked.select("url", "topic_id", "top_rank", "is_top")


def _collect_sql() -> str:
    ctes = [
        VERDICTS
        + f""", held AS (SELECT source, 'alpha' AS topic, news_date AS day, ord FROM art WHERE ord % 7 = 0),
    work AS (SELECT * FROM art WHERE news_date > DATE '{_TODAY}' - 20 AND news_date <= DATE '{_TODAY}'
      AND (news_date > DATE '{_TODAY}' - 5 OR (source, news_date) NOT IN (SELECT (source, day) FROM held))),
    chosen AS (SELECT w.ord, w.source, w.url, w.title, w.news_date AS day, v.profile AS topic
      FROM work w JOIN verdicts v ON v.ord = w.ord WHERE v.kept),
    p0 AS (SELECT *, nullif(url, '') AS u, nullif(trim(title), '') AS t FROM chosen)"""
    ]
    for n in range(8):
        ctes.append(
            f"""k{n} AS (SELECT * FROM p{n}
      QUALIFY (u IS NULL OR ord = min(ord) OVER (PARTITION BY topic, u))
        AND (t IS NULL OR ord = min(ord) OVER (PARTITION BY topic, t)))"""
        )
        ctes.append(
            f"""p{n + 1} AS (SELECT * FROM p{n} p WHERE (topic, ord) NOT IN (SELECT (topic, ord) FROM k{n})
      AND NOT EXISTS (SELECT 1 FROM k{n} k WHERE k.topic = p.topic AND k.u = p.u)
      AND NOT EXISTS (SELECT 1 FROM k{n} k WHERE k.topic = p.topic AND k.t = p.t))"""
        )
    every = " UNION ALL ".join(f"SELECT * FROM k{n}" for n in range(8))
    return f"WITH {', '.join(ctes)}, kept AS ({every})"


def _collected(spark, d):
    raw = articles(spark, d).withColumn("day", F.col("news_date")).drop("topic", "news_date")
    path = work_path(spark, "day_table")
    before = raw.filter("ord % 7 = 0").withColumn("topic", F.lit("alpha"))
    dc.upsert_days(before.withColumns({"matched_keyword": F.lit("old"), "n_hits": F.lit(0)}), path)
    stats = runs.collect_run(raw, list(PACKS), path, 20, 5, F.lit(_TODAY).cast("date"))
    return spark.read.parquet(path), stats


@query(
    "collect_run",
    _collect_sql()
    + f""" SELECT source, topic, day, count(*) AS n, CAST(sum(ord) AS BIGINT) AS ords FROM (
      SELECT source, topic, day, ord FROM kept
      UNION ALL SELECT source, topic, day, ord FROM held WHERE day > DATE '{_TODAY}' - 20
        AND (day <= DATE '{_TODAY}' - 5 OR day > DATE '{_TODAY}')) GROUP BY ALL""",
)
def collect_run(spark, d):
    """Raw articles to the day table: plan, fan out, dedupe per topic, store, trim."""
    table, _ = _collected(spark, d)
    return table.groupBy("source", "topic", "day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ord").alias("ords")
    )


@query(
    "collect_stats",
    _collect_sql()
    + """ SELECT (SELECT count(*) FROM work) AS n_articles,
      (SELECT count(*) FROM work) - (SELECT count(DISTINCT ord) FROM chosen) AS n_filtered,
      (SELECT count(*) FROM chosen) - (SELECT count(*) FROM kept) AS n_duplicates,
      (SELECT count(*) FROM kept) AS n_kept, (SELECT count(*) FROM kept WHERE t IS NULL) AS n_without_title""",
)
def collect_stats(spark, d):
    """The counters of a collect run."""
    _, stats = _collected(spark, d)
    return stats
