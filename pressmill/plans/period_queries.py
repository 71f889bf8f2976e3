"""Queries of periods, day plans and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressmill.functions.dates import format_news_date
from pressmill.operators import batch_counts as bc
from pressmill.operators import periods as pr
from pressmill.operators import windows as wn
from pressmill.plans.dedupe_queries import APPEND, period_halves
from pressmill.plans.registry import query
from pressmill.plans.standins import ART, articles, table
from pressmill.session import work_path
from pressmill.sources import day_cache as dc
from pressmill.streaming import ingest as st
from pressmill.streaming.versions import refresh_changed


def _bare_url():
    return F.regexp_replace("url", "^ ?/ ?$|/$", "")


@query(
    "write_period_table",
    f"""WITH {APPEND} SELECT ord, url, topic, origin FROM held
    QUALIFY row_number() OVER (PARTITION BY url, topic ORDER BY ord) = 1
    UNION ALL SELECT ord, url, topic, origin FROM fresh""",
)
def write_period_table(spark, d):
    """Two batches into an open period; the second is written twice."""
    held, incoming = period_halves(spark, d)
    store = pr.PeriodStore(spark, work_path(spark, "period"))
    store.append(held)
    store.append(incoming, batch=1)
    return store.append(incoming, batch=1).select("ord", _bare_url().alias("url"), "topic", "origin")


_APPENDED = ART + """, inc AS (SELECT ord, CASE WHEN ord % 23 = 0 THEN '' ELSE url END AS url, source, topic,
      CASE WHEN ord % 3 > 0 THEN ord % 3 - 1 WHEN topic = 'fr' THEN 3 ELSE 2 END AS batch FROM art),
    held AS (SELECT ord, url, source, topic, CAST(batch AS INTEGER) AS batch FROM inc
    QUALIFY url = '' OR row_number() OVER (PARTITION BY url, topic ORDER BY batch, ord) = 1)"""


def _appended(spark, d):
    """A store after four appends, each looked up in the key index of those before it."""
    url = F.when(F.col("ord") % 23 == 0, " / ").otherwise(F.concat("url", F.lit("/")))
    art = articles(spark, d).select("ord", url.alias("url"), "source", "topic", "title")
    third = F.col("ord") % 3
    batch = F.when(third > 0, third - 1).when(F.col("topic") == "fr", 3).otherwise(2)
    store = pr.PeriodStore(spark, work_path(spark, "period"))
    for n in range(4):
        yield store, store.append(art.filter(batch == n), batch=n)


@query("append_indexed", f"WITH {_APPENDED} SELECT ord, url, topic, batch FROM held")
def append_indexed(spark, d):
    *_, (_, rows) = _appended(spark, d)
    return rows.select("ord", _bare_url().alias("url"), "topic", F.col(pr.BATCH_COLUMN).alias("batch"))


@query(
    "counts_by_batch",
    f"WITH {_APPENDED} SELECT source, topic, count(*) AS n, count(*) FILTER (url = '') AS n_without_url FROM held GROUP BY ALL",
)
def counts_by_batch(spark, d):
    """Counts per source and topic, kept up with each append and added up from the batches."""
    no_url = F.count_if(_bare_url() == "")
    for store, _ in _appended(spark, d):
        counts = bc.BatchCounts(store, "by_topic", ["source", "topic"], n=F.count(F.lit(1)), n_without_url=no_url)
        out = counts.current()
    return out


@query(
    "close_period",
    f"""WITH {APPEND}, taken AS (SELECT 'first' AS period_id, ord, url, topic FROM held
      UNION ALL SELECT 'second', ord, url, topic FROM inc)
    SELECT period_id, count(*) AS n, CAST(sum(ord) AS BIGINT) AS ord_sum FROM (SELECT * FROM taken
      QUALIFY url = '' OR row_number() OVER (PARTITION BY period_id, url, topic ORDER BY ord) = 1) GROUP BY 1""",
)
def close_period(spark, d):
    """A period closed twice, then a second one; nothing carries over."""
    held, incoming = period_halves(spark, d)
    store = pr.PeriodStore(spark, work_path(spark, "period"))
    store.append(held)
    store.close("first")
    store.close("first again")
    store.append(incoming)
    store.close("second")
    return store.read_archive().groupBy("period_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ord").alias("ord_sum")
    )


@query(
    "export_flat",
    f"""WITH {ART} SELECT strftime(news_date, '%d.%m.%Y') AS news_date, CASE WHEN title <> '' THEN title END AS title, url, topic,
      CAST(ord AS VARCHAR) AS extra FROM art""",
)
def export_flat(spark, d):
    rows = articles(spark, d).select(
        F.col("ord").alias("extra"),
        "url",
        "title",
        "topic",
        format_news_date(F.col("news_date")).alias("news_date"),
        F.lit(1).alias("_audit_flag"),
        F.lit(2).alias("audit_flag"),
    )
    path = work_path(spark, "export")
    pr.export_flat(rows, path, ["news_date", "title", "url", "topic"])
    return spark.read.option("header", True).option("escape", '"').csv(path)


@query(
    "period_bounds",
    """SELECT DATE '1992-03-01' AS date_from, CAST(max(CAST(o_orderdate AS DATE)) AS DATE) AS date_to
    FROM orders WHERE o_orderkey % 3 <> 2""",
)
def period_bounds(spark, d):
    day = F.to_date("o_orderdate")
    text = (
        F.when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "dd.MM.yyyy"))
        .when(F.col("o_orderkey") % 3 == 1, F.date_format(day, "yyyy/MM/dd"))
        .otherwise("1 января 2099")
    )
    return pr.period_bounds(table(spark, d, "orders").select(text.alias("t")), F.col("t"), "1992-05-05", "1992-03-01")


@query(
    "period_line",
    """SELECT 'Результат отработки парсера с ' || strftime(min(o_orderdate), '%d.%m.%Y') || ' по ' ||
      strftime(max(o_orderdate), '%d.%m.%Y') || '.' AS line FROM orders""",
)
def period_line(spark, d):
    text = F.date_format("o_orderdate", "d.M.yyyy")
    span = pr.news_span(table(spark, d, "orders").select(text.alias("t")), F.col("t"))
    return span.select(pr.period_line(F.col("date_from"), F.col("date_to")).alias("line"))


@query(
    "group_by_day",
    "SELECT CAST(ts AS DATE) AS day, count(*) AS n_articles, min(event_id) AS first_ord, max(event_id) AS last_ord FROM events GROUP BY 1",
)
def group_by_day(spark, d):
    return wn.group_by_day(table(spark, d, "events"), F.to_date("ts"), F.col("event_id"))


@query(
    "retention_trim",
    """SELECT event_type AS source, CAST(ts AS DATE) AS day, count(*) AS n FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-16' AND DATE '2024-01-25' GROUP BY ALL""",
)
def retention_trim(spark, d):
    """A day-partitioned table trimmed to a window, then read in full."""
    path = work_path(spark, "days")
    rows = table(spark, d, "events").select(F.col("event_type").alias("source"), F.to_date("ts").alias("day"), "event_id")
    rows.hint("rebalance", "source", "day").write.partitionBy("source", "day").parquet(path)
    today = F.lit("2024-01-25").cast("date")
    dc.trim_days(spark, path, ["source", "day"], F.col("day").between(F.date_sub(today, 9), today))
    return spark.read.parquet(path).groupBy("source", "day").agg(F.count(F.lit(1)).alias("n"))


@query(
    "window_table",
    """WITH s AS (SELECT event_type AS source, count(*) % 7 + 3 AS days FROM events GROUP BY 1)
    SELECT source, CAST(ts AS DATE) AS day, count(*) AS n FROM events JOIN s ON event_type = source
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-25' - CAST(days - 1 AS INTEGER) AND DATE '2024-01-25' GROUP BY ALL""",
)
def window_table(spark, d):
    """Each source's own window, read from a day table by dynamic partition pruning."""
    path = work_path(spark, "days")
    events = table(spark, d, "events")
    rows = events.select(F.col("event_type").alias("source"), F.to_date("ts").alias("day"), "event_id")
    rows.hint("rebalance", "source", "day").write.partitionBy("source", "day").parquet(path)
    windows = events.groupBy(F.col("event_type").alias("source")).agg((F.count(F.lit(1)) % 7 + 3).alias("days"))
    kept = wn.in_window_table(spark.read.parquet(path), windows, F.lit("2024-01-25").cast("date"))
    return kept.groupBy("source", "day").agg(F.count(F.lit(1)).alias("n"))


@query(
    "refresh_plan",
    """WITH r AS (SELECT s.source, CAST(DATE '2024-02-02' - CAST(age AS INTEGER) AS DATE) AS day, age FROM
      (SELECT DISTINCT event_type AS source FROM events) s, range(0, 30) t(age)),
    c AS (SELECT DISTINCT event_type AS source, CAST(ts AS DATE) AS day FROM events WHERE event_id % 50 < 40 AND day(ts) % 4 <> 0)
    SELECT r.source, r.day, c.day IS NOT NULL AS cached, c.day IS NULL OR age < 5 AS process
    FROM r LEFT JOIN c ON r.source = c.source AND r.day = c.day""",
)
def refresh_plan(spark, d):
    events = table(spark, d, "events").select(F.col("event_type").alias("source"), F.to_date("ts").alias("day"), "event_id")
    span = wn.day_range(events.select("source").distinct(), 30, F.lit("2024-02-02").cast("date"))
    cached = events.filter((F.col("event_id") % 50 < 40) & (F.dayofmonth("day") % 4 != 0))
    return wn.refresh_plan(span, cached, 5)


def _run(job):
    job.awaitTermination()


@query(
    "stream_ingest_append",
    f"""WITH {ART} SELECT url, topic, count(*) AS n FROM (SELECT DISTINCT url, topic FROM art WHERE ord % 23 <> 0)
    GROUP BY ALL UNION ALL SELECT '' AS url, topic, count(*) FROM art WHERE ord % 23 = 0 GROUP BY topic""",
)
def stream_ingest_append(spark, d):
    """Articles landing in three lots with repeats, taken in as a stream."""
    rows = articles(spark, d).select(
        "ord", F.when(F.col("ord") % 23 == 0, "").otherwise(F.col("url")).alias("url"), "topic", "title"
    )
    landing, root = work_path(spark, "landing"), work_path(spark, "period")
    store = pr.PeriodStore(spark, root)
    for lot in range(3):
        rows.filter(F.col("ord") % 3 == lot).write.mode("append").parquet(landing)
        source = st.landed(spark, landing, rows.schema)
        _run(st.ingest_append(source, store, root + "/checkpoint"))
    return store.read_open().groupBy("url", "topic").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stream_dedupe",
    "SELECT DISTINCT user_id, event_type FROM events",
)
def stream_dedupe(spark, d):
    """First arrival per key within the run window."""
    events = table(spark, d, "events").select("user_id", "event_type", "ts")
    landing, out = work_path(spark, "landing"), work_path(spark, "deduped")
    events.write.parquet(landing)
    stream = st.dedupe_stream(st.landed(spark, landing, events.schema), ["user_id", "event_type"], "ts", "40 days")
    _run(st.to_table(stream, out, out + "_checkpoint"))
    return spark.read.schema(stream.schema).parquet(out).select("user_id", "event_type")


_REFRESHED = """WITH e AS (SELECT event_type AS source, CAST(ts AS DATE) AS day, event_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
    s AS (SELECT *, CASE WHEN event_id % 3 = 0 AND day > DATE '2024-01-30' - 10 THEN cents + 1 ELSE cents END AS now FROM e WHERE source <> 'error')
    SELECT source, day, count(*) AS n, CAST(sum(now) AS BIGINT) AS cents FROM s GROUP BY ALL
    UNION ALL SELECT source, day, count(*), CAST(sum(cents) AS BIGINT) FROM e WHERE source = 'error' GROUP BY ALL"""


def _refreshed(spark, d, refresh):
    rows = table(spark, d, "events").select(
        F.col("event_type").alias("source"),
        F.lit("all").alias("topic"),
        F.to_date("ts").alias("day"),
        "event_id",
        F.round(F.col("value") * 100).cast("long").alias("cents"),
        F.lit(0).alias("version"),
    )
    landing, out = work_path(spark, "landing"), work_path(spark, "days")
    lots = (
        rows.filter("source <> 'error'"),
        rows.filter("source <> 'error' and event_id % 3 = 0")
        .withColumns({"cents": F.col("cents") + 1, "version": F.lit(1)})
        .unionByName(rows.filter("source = 'error'")),
    )
    for lot in lots:
        lot.write.mode("append").parquet(landing)
        source = st.landed(spark, landing, rows.schema)
        _run(refresh(source, out))
    held = spark.read.schema(rows.schema).parquet(out)
    return held.groupBy("source", "day").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


@query(
    "stream_late_refresh",
    _REFRESHED,
)
def stream_late_refresh(spark, d):
    """Days land, then edited rows for all of them and one source that came late."""

    def refresh(source, out):
        return st.late_refresh(source, out, ["source", "event_id"], "version", out + "_checkpoint", 10)

    return _refreshed(spark, d, refresh)


@query(
    "stream_refresh_changed",
    _REFRESHED,
)
def stream_refresh_changed(spark, d):
    """The same rows with the newest versions held as state."""

    def refresh(source, out):
        return refresh_changed(source, out, ["source", "event_id"], "version", out + "_checkpoint", 10)

    return _refreshed(spark, d, refresh)


@query(
    "stream_daily_counts",
    "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def stream_daily_counts(spark, d):
    """Counts per day; a last row far ahead moves the watermark past all days."""
    events = table(spark, d, "events").select("ts", "event_type")
    landing, out = work_path(spark, "landing"), work_path(spark, "counts")
    marker = events.agg(F.max("ts").alias("ts")).select(
        (F.col("ts") + F.expr("interval 30 days")).alias("ts"), F.lit("end").alias("event_type")
    )
    for lot in (events, marker):
        lot.write.mode("append").parquet(landing)
        stream = st.daily_counts(st.landed(spark, landing, events.schema), "ts", ["event_type"])
        _run(st.to_table(stream, out, out + "_checkpoint"))
    return spark.read.schema(stream.schema).parquet(out).filter("event_type <> 'end'")
