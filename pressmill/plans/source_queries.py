"""Queries of the sources: day caches, feeds, pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressmill.operators import articles as ar
from pressmill.plans.registry import query
from pressmill.plans.standins import ART, articles, table
from pressmill.session import work_path
from pressmill.sources import cache_ranges as cr
from pressmill.sources import day_cache as dc
from pressmill.sources import feeds as fd
from pressmill.sources import pages as pg

# One cache document holds the 30 articles of a source in 600 ids, by topic.
CACHED = (
    ART
    + """, cached AS (
  SELECT *, CASE WHEN source = 'src19' THEN 'consultant' ELSE source END AS src, ord // 600 AS chunk,
    CAST(DATE '2024-01-01' + CAST((ord // 20) % 10 AS INTEGER) AS VARCHAR) AS day FROM art)"""
)


def _cache_documents(spark, d, sources=None, topics=None):
    """documents as day caches: one review-rooted source, one topic in the older shape."""
    art = articles(spark, d)
    slot = F.floor(F.col("ord") / 20)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (slot % 10).cast("int")).cast("string")
    src = F.when(F.col("source") == "src19", "consultant").otherwise(F.col("source"))
    rows = art.select(
        "ord",
        src.alias("source"),
        "topic",
        F.floor(F.col("ord") / 600).alias("chunk"),
        day.alias("day"),
        F.when(src == "consultant", "reviews").otherwise("days").alias("root"),
        "url",
        "title",
        "text",
        day.alias("date"),
    )
    path = dc.stage_documents(rows, spark)
    return dc.read_documents(spark, path, True, sources, topics)


@query(
    "scan_day_cache",
    f"""WITH {CACHED} SELECT src AS source, topic, day,
      CAST(row_number() OVER (PARTITION BY src, topic, chunk, day ORDER BY ord) - 1 AS INTEGER) AS pos,
      url, title, md5(text) AS text_md5 FROM cached""",
)
def scan_day_cache(spark, d):
    out = dc.scan_articles(_cache_documents(spark, d))
    return out.select("source", "topic", "day", "pos", "url", "title", F.md5("text").alias("text_md5"))


@query(
    "scan_cache_ranges",
    f"""WITH {ART} SELECT source, topic, CAST(DATE '2000-01-01' + CAST((ord // 20) % 36500 AS INTEGER) AS VARCHAR) AS day,
      CAST(row_number() OVER (PARTITION BY source, topic, (ord // 20) % 36500 ORDER BY ord) - 1 AS INTEGER) AS pos,
      url, title, md5(text) AS text_md5 FROM art""",
)
def scan_cache_ranges(spark, d):
    """documents as one indented cache document per source and topic, read by ranges."""
    day = F.date_add(F.lit("2000-01-01").cast("date"), (F.floor(F.col("ord") / 20) % 36500).cast("int"))
    rows = articles(spark, d).withColumn("day", day.cast("string"))
    path = dc.stage_indented(rows, spark)
    out = dc.entry_articles(cr.scan_entries(spark, path))
    return out.select("source", "topic", "day", "pos", "url", "title", F.md5("text").alias("text_md5"))


@query(
    "scan_corrupt_tolerant",
    f"""WITH {CACHED}, docs AS (SELECT src, topic, chunk, count(*) AS n FROM cached GROUP BY ALL),
    marked AS (SELECT *, topic = 'fr' OR (topic = 'de' AND src <> 'consultant') AS broken FROM docs)
    SELECT src AS source, topic, count(*) AS n_documents, count(*) FILTER (broken) AS n_broken,
      CAST(sum(CASE WHEN broken THEN 0 ELSE n END) AS BIGINT) AS n_articles FROM marked GROUP BY ALL""",
)
def scan_corrupt_tolerant(spark, d):
    docs = _cache_documents(spark, d)
    # French documents are cut off, German ones have their day root renamed.
    body = (
        F.when(F.col("topic") == "fr", F.substring("body", 1, 200))
        .when(F.col("topic") == "de", F.replace("body", F.lit('{"days":'), F.lit('{"pages":')))
        .otherwise(F.col("body"))
    )
    parsed = dc.parse_documents(docs.withColumn("body", body))
    counted = F.aggregate(
        F.map_values("days"),
        F.lit(0).cast("long"),
        lambda n, e: n + F.coalesce(F.size(e["items"]), F.lit(0)),
    )
    return parsed.groupBy("source", "topic").agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.count_if("broken").alias("n_broken"),
        F.sum(counted).alias("n_articles"),
    )


@query(
    "scan_all_sources",
    f"""WITH {CACHED} SELECT topic, src AS source, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM cached
    WHERE topic IN ('en', 'es', 'de') GROUP BY ALL""",
)
def scan_all_sources(spark, d):
    sources = [f"src{n}" for n in range(19)] + ["consultant"]
    topics = ["en", "es", "de"]
    out = dc.scan_all(_cache_documents(spark, d, sources, topics), sources, topics)
    return out.groupBy("topic", "source").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text").cast("long")).alias("n_chars")
    )


@query(
    "upsert_day",
    """SELECT event_type AS source, CAST(ts AS DATE) AS day, count(*) AS n,
      CAST(sum(CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' AND event_type <> 'view' THEN 2 ELSE 1 END
        * CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, 'processed' AS status
    FROM events GROUP BY ALL""",
)
def upsert_day(spark, d):
    path = work_path(spark, "days")
    rows = table(spark, d, "events").select(
        F.col("event_type").alias("source"),
        F.lit("all").alias("topic"),
        F.to_date("ts").alias("day"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
    )
    dc.upsert_days(rows, path)
    again = rows.filter("day >= date '2024-01-20' and source <> 'view'")
    dc.upsert_days(again.withColumn("cents", F.col("cents") * 2), path)
    held = spark.read.parquet(path)
    return held.groupBy("source", "day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"), F.max("status").alias("status")
    )


def _joined_documents(items, group, item, head, tail):
    """Bounded groups of items as one document each, in item order."""
    listed = F.array_sort(F.collect_list(F.struct(F.col("page_id"), item.alias("x"))))
    body = F.array_join(F.transform(listed, lambda r: r["x"]), "")
    return items.groupBy(group.alias("g")).agg(body.alias("b")).select(
        F.concat(head, F.col("b"), F.lit(tail)).alias("value")
    )


_TITLE = "<title>([^<]*)</title>"


def _escaped(text):
    return F.replace(text, F.lit("&"), F.lit("&amp;"))


@query(
    "scan_rss_items",
    rf"""WITH p AS (SELECT page_id, url, page_id // 50 AS feed, page_id % 11 = 4 AS blank, page_id % 10 = 3 AS undated,
      trim(regexp_replace(regexp_extract(html, '{_TITLE}', 1), '\s+', ' ', 'g')) AS title,
      trim(regexp_replace(html, '\s+', ' ', 'g')) AS html,
      CAST(DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER) AS DATE) AS news_date FROM pages),
    i AS (SELECT page_id, feed, url, title, html, news_date FROM p WHERE NOT blank AND title <> '' AND NOT undated
      UNION ALL SELECT page_id, feed + 1, url, 'Again ' || title, html, news_date FROM p WHERE NOT undated)
    SELECT url, title, news_date, sha256(html) AS description_sha256 FROM i
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY feed, page_id) = 1""",
)
def scan_rss_items(spark, d):
    """The given pages as items of two feeds, with their url, title and whole html."""
    pages = table(spark, d, "pages")
    key = F.col("page_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 28).cast("int"))
    stamp = F.when(key % 10 == 3, "some day").otherwise(F.date_format(day, "E, dd MMM yyyy '08:00:00 +0300'"))
    own = F.concat(F.lit("  "), F.regexp_extract("html", _TITLE, 1))
    both = F.array(
        F.struct(F.floor(key / 50).alias("feed"), F.when(key % 11 == 4, " ").otherwise(own).alias("title")),
        F.struct((F.floor(key / 50) + 1).alias("feed"), F.concat(F.lit("Again "), own).alias("title")),
    )
    items = pages.select("page_id", "url", "html", F.inline(both))

    def raw(text):
        return F.concat(F.lit("<![CDATA["), F.replace(text, F.lit("]]>"), F.lit("]]]]><![CDATA[>")), F.lit("]]>"))

    item = F.concat(
        F.lit("<item><title>"), raw(F.col("title")), F.lit("</title><link> "), _escaped(F.col("url")),
        F.lit(" </link><pubDate>"), stamp, F.lit("</pubDate><description>"), raw(F.col("html")),
        F.lit("</description></item>"),
    )
    head = F.concat(F.lit('<rss id="'), F.lpad(F.col("g").cast("string"), 12, "0"), F.lit('"><channel>'))
    path = work_path(spark, "rss")
    # A document a line: line breaks within are white space.
    docs = _joined_documents(items, F.col("feed"), item, head, "</channel></rss>")
    docs.select(F.regexp_replace("value", "[\r\n]", " ")).write.text(path)
    docs = fd.read_feed_documents(spark, path, one_per_line=True)
    docs = docs.withColumn("feed", F.regexp_extract("body", '<rss id="([0-9]+)"', 1))
    found = fd.rss_items(docs, "https://site.example", feed="feed")
    return found.select("url", "title", "news_date", F.sha2("description", 256).alias("description_sha256"))


_ARTICLE_URL = "/[a-z]{2}/[0-9]+$"


@query(
    "scan_sitemap",
    f"""SELECT url, CASE WHEN page_id % 5 <> 0 THEN CAST(DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER) AS DATE) END AS lastmod
    FROM pages WHERE regexp_matches(url, '{_ARTICLE_URL}') AND (page_id % 5 = 0 OR page_id % 28 >= 14)""",
)
def scan_sitemap(spark, d):
    """The given urls as sitemaps; those with a query are no articles."""
    pages = table(spark, d, "pages")
    key = F.col("page_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 28).cast("int"))
    stamp = F.when(key % 5 == 0, "").otherwise(
        F.concat(F.lit("<lastmod>"), F.date_format(day, "yyyy-MM-dd'T'10:00:00+03:00"), F.lit("</lastmod>"))
    )
    item = F.concat(F.lit("<url><loc>"), _escaped(F.col("url")), F.lit("</loc>"), stamp, F.lit("</url>"))
    path = work_path(spark, "sitemap")
    head = F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">')
    _joined_documents(pages, F.floor(key / 50), item, head, "</urlset>").write.text(path)
    docs = fd.read_feed_documents(spark, path, one_per_line=True)
    return fd.sitemap_urls(docs, F.lit("2024-01-15").cast("date"), _ARTICLE_URL)


@query(
    "scan_api_feed",
    """SELECT 'Event ' || event_id AS title, '/e/' || event_id AS url, CAST(ts AS DATE) AS news_date
    FROM events WHERE ts >= DATE '2024-01-12'""",
)
def scan_api_feed(spark, d):
    key = F.col("event_id").cast("string")
    item = F.struct(
        F.concat(F.lit("Event "), key).alias("title"),
        F.concat(F.lit("/e/"), key).alias("url"),
        F.unix_timestamp("ts").alias("publishDateT"),
    )
    pages = (
        table(spark, d, "events")
        .groupBy(F.floor(F.col("event_id") / 20).alias("g"))
        .agg(F.collect_list(item).alias("items"))
        .select("items", F.lit(True).alias("moreExists"), F.col("g").cast("string").alias("endCursor"))
    )
    path = work_path(spark, "api")
    pages.write.json(path)
    return fd.api_items(fd.read_api_pages(spark, path), F.lit("2024-01-12").cast("date"))


_UNESCAPE = "replace(replace(regexp_replace({x}, '&amp;?', '&', 'g'), '&quot;', '\"'), '&copy;', '©')"
_CLEAN_P = (
    "trim(regexp_replace(" + _UNESCAPE.format(x="regexp_replace(x, '<[^>]*>', ' ', 'g')") + ", '\\s+', ' ', 'g'))"
)
_PARAGRAPHS = f"""p AS (SELECT page_id, url, html, regexp_extract(html, '<h1>(.*?)</h1>', 1, 's') AS h1,
    string_split(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '<p>')[2:] AS parts FROM pages),
  q AS (SELECT page_id, url, h1, [{_CLEAN_P} FOR x IN parts] AS ps FROM p)"""


@query(
    "extract_page_articles",
    f"""WITH {_PARAGRAPHS} SELECT page_id, trim({_UNESCAPE.format(x="h1")}) AS title,
      CAST(length(array_to_string([x FOR x IN ps IF x <> ''], chr(10))) AS BIGINT) AS n,
      md5(array_to_string([x FOR x IN ps IF x <> ''], chr(10))) AS text_md5 FROM q""",
)
def extract_page_articles(spark, d):
    out = pg.extract_articles(table(spark, d, "pages", heavy=True), pg.PROFILES["minfin"], "page_id")
    return out.select("page_id", "title", F.length("text").cast("long").alias("n"), F.md5("text").alias("text_md5"))


@query(
    "extract_page_links",
    """WITH a AS (SELECT page_id, url, regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>', '', 'g'),
        '<a href="[^"]*">[^<]*</a>') AS raws FROM pages),
    u AS (SELECT page_id, url, unnest(raws) AS raw, generate_subscripts(raws, 1) - 1 AS pos FROM a),
    h AS (SELECT *, regexp_extract(raw, 'href="([^"]*)"', 1) AS href, regexp_extract(raw, '>([^<]*)<', 1) AS anchor FROM u)
    SELECT page_id, CAST(pos AS INTEGER) AS pos, replace(anchor, '&amp;', '&') AS anchor,
      CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || href ELSE href END AS link,
      regexp_matches(string_split(trim(href, '/'), '/')[-1], '^[0-9]+$') AS is_article FROM h""",
)
def extract_page_links(spark, d):
    links = pg.extract_links(table(spark, d, "pages"), F.col("url"))
    return links.select("page_id", "pos", "anchor", "link", "is_article")


_H1 = f"trim({_UNESCAPE.format(x='h1')})"


@query(
    "html_profiles",
    f"""WITH {_PARAGRAPHS}, b AS (SELECT page_id, [x FOR x IN ps IF x <> ''] AS ps FROM q)
    SELECT page_id, 'banki' AS profile, md5(array_to_string(ps, chr(10))) AS text_md5 FROM b
    UNION ALL SELECT page_id, 'minfin', md5(array_to_string(ps, chr(10))) FROM b
    UNION ALL SELECT page_id, 'palata', md5(trim({_H1} || ' ' || array_to_string(b.ps, ' '))) FROM b JOIN q USING (page_id)""",
)
def html_profiles(spark, d):
    pages = table(spark, d, "pages", heavy=True)
    out = None
    for name in ("banki", "minfin", "palata"):
        part = pg.extract_articles(pages, pg.PROFILES[name], "page_id").select(
            "page_id", F.lit(name).alias("profile"), F.md5("text").alias("text_md5")
        )
        out = part if out is None else out.unionByName(part)
    return out


_CLEAN = "replace(replace({0}, '&quot;', '\"'), '&amp;', '&')"
# The page's own heading and its plain paragraphs, put into each site's containers.
_SITE_PARTS = f"""s AS (SELECT page_id, url,
    [trim({_CLEAN.format("x")}) FOR x IN regexp_extract_all(html, '<p>([^<&]*(?:&(?:amp|quot);[^<&]*)*)</p>', 1)] AS every FROM pages),
  t AS (SELECT page_id, url, [x FOR x IN every IF length(x) > 10] AS ps, CAST(DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER) AS DATE) AS day FROM s)"""
_SITE_BOXES = {
    "interfax": ("<article itemprop='articleBody'>", "<p>", "</article>", "chr(10)"),
    "nalog": ("<div class='text_block'>", "<p>", "</div>", "' '"),
    "kommersant": ("<div class='article_text_wrapper'>", "<p class='doc__text'>", "</div>", "chr(10) || chr(10)"),
    "garant": ("<div class='clearfix'>", "<p>", "</div>", "chr(10) || chr(10)"),
    "rbc": ("<div class='article__text'>", "<p>", "</div>", "' '"),
}
_SITE_DATES = {
    "interfax": "<meta itemprop='datePublished' content='{}'>",
    "garant": "<time datetime='{}T10:00:00'>x</time>",
}


@query(
    "site_profiles",
    f"WITH {_SITE_PARTS} "
    + " UNION ALL ".join(
        f"""SELECT page_id, '{name}' AS profile, {"CAST(day AS VARCHAR)" if name in _SITE_DATES else "''"} AS date,
      md5(array_to_string(ps, {join})) AS text_md5 FROM t"""
        for name, (_, _, _, join) in _SITE_BOXES.items()
    )
    + " UNION ALL SELECT page_id, 'kommersant meta', '', md5('named ' || page_id) FROM t",
)
def site_profiles(spark, d):
    """The given pages' paragraphs as the sites wrap them, with their dates."""
    pages = table(spark, d, "pages", heavy=True)
    long = _long_paragraphs()
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 28).cast("int")).cast("string")
    out = None
    for name, (start, mark, end, _) in _SITE_BOXES.items():
        lines = F.array_join(F.transform(long, lambda x: F.concat(F.lit(mark), x, F.lit("</p>"))), "")
        head, tail = _SITE_DATES.get(name, "{}").split("{}")
        date = F.concat(F.lit(head), day, F.lit(tail)) if name in _SITE_DATES else F.lit("")
        html = F.concat(F.lit("<html><body>"), date, F.lit(start), lines, F.lit(end), F.lit("<p>outside the text</p>"))
        part = _profile(pages.select("page_id", html.alias("html")), name, name)
        out = part if out is None else out.unionByName(part)
    named = F.concat(
        F.lit("<meta property='og:description' content='other'><meta name='description' content='named "),
        F.col("page_id").cast("string"),
        F.lit("'>"),
    )
    return out.unionByName(_profile(pages.select("page_id", named.alias("html")), "kommersant", "kommersant meta"))


def _long_paragraphs():
    """Plain paragraphs of more than ten characters, as they stand in the page."""
    inner = F.regexp_extract_all("html", F.lit("<p>([^<&]*(?:&(?:amp|quot);[^<&]*)*)</p>"), F.lit(1))

    def shown(x):
        return F.trim(F.replace(F.replace(x, F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&")))

    return F.filter(inner, lambda x: F.length(shown(x)) > 10)


def _profile(pages, profile, name):
    return pg.extract_articles(pages, pg.PROFILES[profile], "page_id").select(
        "page_id", F.lit(name).alias("profile"), "date", F.md5("text").alias("text_md5")
    )


@query(
    "review_pages",
    f"""WITH {_SITE_PARTS} SELECT page_id, 'ФИНАНСЫ. БЮДЖЕТ' AS category, '/doc/' || page_id AS href,
      'A title that is long enough to be kept ' || page_id AS title, md5(coalesce(ps[1], '')) AS text_md5 FROM t WHERE len(ps) > 0""",
)
def review_pages(spark, d):
    """Review pages with one kept category, built from the given pages."""
    long = _long_paragraphs()
    key = F.col("page_id").cast("string")
    html = F.concat(
        F.lit("<h3>Финансы. Бюджет</h3><p><a href='/doc/"), key, F.lit("'>A document whose name is longer than thirty characters</a></p><p><strong>A title that is long enough to be kept "),
        key, F.lit("</strong></p><p>"), F.get(long, F.lit(0)),
        F.lit("</p><h3>Прочее</h3><p><a href='/doc/x'>Another document whose name is longer than that</a></p><p><strong>A title of a category that is left out</strong></p><p>no</p>"),
    )
    pages = table(spark, d, "pages", heavy=True).select("page_id", html.alias("html")).filter("html is not null")
    found = pg.review_entries(pages, pg.REVIEW_CATEGORIES, "/doc/", "page_id")
    return found.select("page_id", "category", "href", "title", F.md5("text").alias("text_md5"))


@query(
    "title_link_match",
    """WITH a AS (SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS raws, url FROM pages),
    u AS (SELECT page_id, url, unnest(raws) AS raw, generate_subscripts(raws, 1) - 1 AS pos FROM a),
    h AS (SELECT page_id, url, pos, regexp_extract(raw, 'href="([^"]*)"', 1) AS href,
      replace(regexp_extract(raw, '>([^<]*)<', 1), '&amp;', '&') AS anchor FROM u),
    f AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY page_id, anchor ORDER BY pos) = 1)
    SELECT page_id AS page, anchor AS title, pos AS ord,
      CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || href ELSE href END AS link
    FROM f WHERE anchor <> '' AND pos % 3 <> 1""",
)
def title_link_match(spark, d):
    links = pg.extract_links(table(spark, d, "pages"), F.col("url")).withColumnRenamed("page_id", "page")
    first = links.groupBy("page", "anchor").agg(F.min("pos").cast("long").alias("ord"))
    title = F.concat(F.lit(" "), "anchor")
    shown = F.array(
        F.struct(F.col("ord").alias("ord"), title.alias("title")),
        F.struct((F.col("ord") + 1000).alias("ord"), F.concat(title, F.lit(" unmatched")).alias("title")),
        F.struct((F.col("ord") + 1).alias("ord"), title.alias("title")),
    )
    listing = first.filter("ord % 3 <> 1").select("page", F.explode(shown).alias("x")).select("page", "x.*")
    return ar.title_link_match(listing, links)
