"""Listing pages: dated titles with their links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pressmill.functions.dates import parse_source_date
from pressmill.functions.text import normalize_whitespace, resolve_url
from pressmill.operators.articles import title_link_match
from pressmill.sources import markup
from pressmill.sources.pages import extract_links, read_pages


@dataclass(frozen=True)
class ListingProfile:
    """Where an entry, its link and its date are found."""

    card: str
    date_style: str
    # Empty when the card itself is the link.
    link: str = ""
    # Empty when the date stands in the text around the card.
    date: str = ""
    keep: tuple[str, ...] = ()
    link_title: bool = False
    close_paragraphs: bool = True


# The listing markup of the sites.
LISTINGS = {
    "minfin": ListingProfile("a[href]", "short_dotted", keep=("/ru/press-center/", "id_4=")),
    "nalog": ListingProfile(
        "div.news-block__text",
        "long_dotted",
        link="div.news-block__name a",
        date="div.news__time",
        close_paragraphs=False,
    ),
    "palata": ListingProfile(
        "div.news-item",
        "named_month",
        link=".card-body a.link",
        date=".card-footer span.text-primary",
        link_title=True,
    ),
}


def listing_items(pages: DataFrame, profile: ListingProfile, base_url: str, id_col: str, html_col: str = "html") -> DataFrame:
    """``(id, pos, title, url, news_date)`` of the dated entries with a link."""

    def entry(card: markup.Element):
        link = card.find(profile.link) if profile.link else card
        around = card.find(profile.date) if profile.date else card.parent
        if link is None or around is None:
            return None
        href = link.attrs.get("href", "").strip()
        if profile.keep and not any(part in href for part in profile.keep):
            return None
        sep = "" if profile.link else " "
        title = link.attrs.get("title", "").strip() if profile.link_title else ""
        return href, title or link.text(sep), around.text("" if profile.date else " ")

    def read(html: str) -> list[tuple]:
        cards = markup.parse(html, profile.close_paragraphs).find_all(profile.card)
        return [(pos, *found) for pos, found in enumerate(map(entry, cards)) if found]

    columns = {"pos": "long", "href": "string", "title": "string", "raw_date": "string"}
    found = read_pages(pages, id_col, html_col, read, columns)
    return found.select(
        id_col,
        "pos",
        normalize_whitespace(F.col("title")).alias("title"),
        resolve_url(F.col("href"), base_url).alias("url"),
        parse_source_date(F.col("raw_date"), profile.date_style).alias("news_date"),
    ).filter("title <> '' and url <> '' and news_date is not null")


def page_lines(pages: DataFrame, id_col: str, html_col: str = "html") -> DataFrame:
    """``(id, lines)``: the visible text of a page as an array of lines."""

    def read(html: str) -> list[tuple]:
        texts = markup.parse(html).strings()
        return [([line for text in texts for line in map(str.strip, text.splitlines()) if line],)]

    return read_pages(pages, id_col, html_col, read, {"lines": "array<string>"})


def timed_entries(lines: Column) -> Column:
    """``array<struct<pos,day,title>>`` from lines of dates, times and titles.

    A date line sets the day, a time line under a day announces the title on the
    next line. The state runs inside the row.
    """
    state = "struct<day:date,awaits:boolean,pos:int,kept:array<struct<pos:int,day:date,title:string>>>"

    def step(acc: Column, line: Column) -> Column:
        is_title = acc["awaits"]
        is_date = ~is_title & line.rlike(r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$")
        day = F.when(is_date, F.try_to_date(line, "dd.MM.yyyy")).otherwise(acc["day"])
        is_time = ~is_title & day.isNotNull() & line.rlike(r"^[0-9]{2}:[0-9]{2}$")
        entry = F.struct(acc["pos"].alias("pos"), acc["day"].alias("day"), normalize_whitespace(line).alias("title"))
        kept = F.when(is_title, F.concat(acc["kept"], F.array(entry))).otherwise(acc["kept"])
        return F.struct(day.alias("day"), is_time.alias("awaits"), (acc["pos"] + 1).alias("pos"), kept.alias("kept"))

    start = F.from_json(F.lit('{"awaits":false,"pos":0,"kept":[]}'), state)
    return F.aggregate(lines, start, step, lambda acc: acc["kept"])


def timed_listing(pages: DataFrame, base_url: str, id_col: str, mark: str = "/news/lenta/") -> DataFrame:
    """``(page, day, title, url)``: timed entries with the link of the same text."""
    entries = page_lines(pages, id_col).select(
        F.col(id_col).alias("page"), F.explode_outer(timed_entries(F.col("lines"))).alias("e")
    )
    listing = entries.filter("e is not null").select("page", F.col("e.pos").alias("ord"), "e.day", "e.title")
    links = extract_links(pages.select(F.col(id_col).alias("page"), "html"), base_url, (mark,))
    return title_link_match(listing, links).select("page", "day", "title", F.col("link").alias("url"))


def review_links(pages: DataFrame, base_url: str, since: Column, mark: str = "/law/review/fed/fw") -> DataFrame:
    """``(url, day)`` of the review issues since a day, each once."""
    links = extract_links(pages.select("html"), base_url, (mark,)).filter(F.col("href").endswith(".html"))
    day = F.try_to_date(F.regexp_extract("href", r"fw([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), "yyyy-MM-dd")
    return links.select(F.col("link").alias("url"), day.alias("day")).filter(F.col("day") >= since).distinct()
