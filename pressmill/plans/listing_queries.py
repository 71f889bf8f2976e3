"""Queries of the listing pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressmill.functions.dates import MONTHS
from pressmill.plans.registry import query
from pressmill.plans.standins import table
from pressmill.sources import listings as ls

_SITE = "https://site.example"

# Five entries per page; entry i of page p carries the number 5 p + i.
ENTRIES = """entries AS (
  SELECT page_id, i, page_id * 5 + i AS n, CAST(DATE '2024-01-01' + CAST((page_id + i) % 28 AS INTEGER) AS DATE) AS day
  FROM pages, range(0, 5) t(i))"""


def _listing_pages(spark, d, entry):
    """pages as listing pages; ``entry`` renders number and day of an entry."""
    first = F.lit("2024-01-01").cast("date")
    cards = F.transform(
        F.sequence(F.lit(0), F.lit(4)),
        lambda i: entry(
            (F.col("page_id") * 5 + i).cast("string"),
            F.date_add(first, ((F.col("page_id") + i) % 28).cast("int")),
        ),
    )
    return table(spark, d, "pages").select("page_id", F.array_join(cards, "\n").alias("html"))


def _russian(day):
    names = F.array(*[F.lit(m) for m in MONTHS])
    return F.concat_ws(" ", F.dayofmonth(day).cast("string"), F.element_at(names, F.month(day)), F.year(day).cast("string"))


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _palata(n, day):
    return _text(
        '<div class="news-item big"><div class="card-body"><a class="link" title=" T  ', n, '" href="/news/', n,
        '/">short</a></div><div class="card-footer"><span class="text-primary">', _russian(day), "</span></div></div>",
    )


def _nalog(n, day):
    return _text(
        '<div class="news-block__text"><div class="news__time">', F.date_format(day, "dd.MM.yyyy"),
        ' 10:15</div><div class="news-block__name"><a href="/news/', n, '/">T ', n, "</a></div></div>",
        '<div class="news-block__text"><div class="news__time">soon</div></div>',
    )


def _minfin(n, day):
    return _text(
        "<li>", F.date_format(day, "dd.MM.yy"), ' <a href="/ru/press-center/?id=', n, '">T <b>', n, "</b></a></li>",
        '<li>01.01.2024 <a href="/other/">no</a></li><li>undated <a href="/ru/press-center/">no</a></li>',
    )


@query(
    "listing_items",
    f"""WITH {ENTRIES} SELECT 'palata' AS profile, page_id, 'T ' || n AS title, '{_SITE}/news/' || n || '/' AS url, day AS news_date FROM entries
    UNION ALL SELECT 'nalog', page_id, 'T ' || n, '{_SITE}/news/' || n || '/', day FROM entries
    UNION ALL SELECT 'minfin', page_id, 'T ' || n, '{_SITE}/ru/press-center/?id=' || n, day FROM entries""",
)
def listing_items(spark, d):
    out = None
    for name, entry in (("palata", _palata), ("nalog", _nalog), ("minfin", _minfin)):
        items = ls.listing_items(_listing_pages(spark, d, entry), ls.LISTINGS[name], _SITE, "page_id")
        part = items.select(F.lit(name).alias("profile"), "page_id", "title", "url", "news_date")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "timed_listing",
    f"""WITH {ENTRIES} SELECT page_id AS page, day, 'T «' || n || '» — x' AS title, '{_SITE}/news/lenta/?id=' || n AS url
    FROM entries WHERE n % 4 <> 1""",
)
def timed_listing(spark, d):
    """Dates, times and titles in the text, with references; some titles have no link."""

    def entry(n, day):
        href = F.when(n.cast("long") % 4 == 1, "/elsewhere/").otherwise("/news/lenta/?id=")
        return _text(
            "<div>", F.date_format(day, "dd.MM.yyyy"), '</div><p>10:30</p><a href="', href, n, '">T  &laquo;', n,
            "&raquo; &#8212; x</a><p>99.99.2024</p><p>11:00</p><p>ignored</p>",
        )

    return ls.timed_listing(_listing_pages(spark, d, entry), _SITE, "page_id")


@query(
    "review_links",
    f"""WITH {ENTRIES} SELECT DISTINCT '{_SITE}/law/review/fed/fw' || day || '.html' AS url, day FROM entries WHERE day >= DATE '2024-01-10'""",
)
def review_links(spark, d):
    def entry(n, day):
        return _text(
            '<a href="/law/review/fed/fw', day.cast("string"), '.html">', n, '</a><a href="/law/review/fed/fwx.html">x</a>',
            '<a href="/law/review/fed/fw', day.cast("string"), '.pdf">y</a>',
        )

    return ls.review_links(_listing_pages(spark, d, entry), _SITE, F.lit("2024-01-10").cast("date"))
