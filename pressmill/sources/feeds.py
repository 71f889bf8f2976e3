"""RSS feeds, sitemaps and paged JSON feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pressmill.functions.dates import parse_source_date
from pressmill.functions.text import normalize_whitespace, resolve_url


def read_feed_documents(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """``(file, body)``, a row per feed document."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(path, wholetext=not one_per_line)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))
    )


def _parsed(body: str, schema: str) -> Column:
    """A document parsed as XML, once; text that is not XML gives nulls."""
    return F.inline_outer(F.array(F.from_xml(body, schema, {"mode": "PERMISSIVE"})))


def rss_items(docs: DataFrame, base_url: str, feed: str = "file") -> DataFrame:
    """Dated items of all feeds, one per URL.

    Items without title, link or readable date are dropped. A URL found more
    than once keeps its first place in (feed, position) order.
    """
    item = "struct<title:string,link:string,pubDate:string,description:string>"
    parsed = (
        docs.select(F.col(feed).alias("feed"), _parsed("body", f"channel struct<item:array<{item}>>"))
        .select("feed", F.posexplode("channel.item").alias("pos", "one"))
        .select("feed", "pos", "one.*")
    )
    items = parsed.select(
        "feed",
        "pos",
        normalize_whitespace(F.col("title")).alias("title"),
        normalize_whitespace(F.col("link")).alias("link"),
        parse_source_date(F.col("pubDate"), "mail").alias("news_date"),
        normalize_whitespace(F.col("description")).alias("description"),
    ).filter((F.col("title") != "") & (F.col("link") != "") & F.col("news_date").isNotNull())
    placed = items.withColumn("url", resolve_url(F.col("link"), base_url)).drop("link")
    first = Window.partitionBy("url").orderBy("feed", "pos")
    return placed.withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n")


def sitemap_urls(docs: DataFrame, start_date: Column, pattern: str = r"/news/[0-9]+/$") -> DataFrame:
    """``(url, lastmod)`` of the article URLs changed since ``start_date``.

    A URL without a readable ``lastmod`` is kept.
    """
    parsed = (
        docs.select(_parsed("body", "url array<struct<loc:string,lastmod:string>>"))
        .select(F.explode("url").alias("one"))
        .select("one.*")
    )
    return (
        parsed.select(
            F.col("loc").alias("url"),
            parse_source_date(F.col("lastmod"), "iso_prefix").alias("lastmod"),
        )
        .filter(F.col("url").rlike(pattern))
        .filter(F.col("lastmod").isNull() | (F.col("lastmod") >= start_date))
    )


_API_PAGE = (
    "items array<struct<title:string,url:string,publishDateT:bigint>>,"
    "moreExists boolean,endCursor string"
)


def read_api_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_API_PAGE).json(path)


def api_items(pages: DataFrame, start_date: Column) -> DataFrame:
    """``(title, url, news_date)`` of the items published since ``start_date``."""
    since = F.unix_timestamp(start_date.cast("timestamp"))
    published = F.coalesce(F.col("item.publishDateT"), F.lit(0))
    return (
        pages.select(F.explode("items").alias("item"))
        .filter(published >= since)
        .select(
            F.coalesce("item.title", F.lit("")).alias("title"),
            F.coalesce("item.url", F.lit("")).alias("url"),
            F.to_date(F.timestamp_seconds(published)).alias("news_date"),
        )
    )
