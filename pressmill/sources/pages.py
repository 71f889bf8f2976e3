"""Raw pages to articles and links.

What to read from a page is data (``PageProfile``); one generic reader applies
it to Arrow batches of pages, so Spark spreads the pages over tasks and nothing
crosses from one page to another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
import datetime
from html import unescape as html_unescape
import json
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from pressmill.functions.text import normalize_whitespace, resolve_url
from pressmill.sources import markup


@dataclass(frozen=True)
class Body:
    """One way to get the text: pieces inside the first matching container."""

    within: str = ""
    pieces: str = ""
    piece_sep: str = " "
    join: str = "\n"
    longer_than: int = 0
    attribute: str = ""
    drop: str = ""
    # A container that is present settles the matter even if it is empty.
    settles: bool = False


@dataclass(frozen=True)
class PageProfile:
    bodies: tuple[Body, ...]
    title: str = "h1"
    # ``selector@attribute`` entries; ``ld+json`` reads datePublished.
    dates: tuple[str, ...] = ()
    # False keeps the nesting of unclosed paragraphs as written.
    close_paragraphs: bool = True
    squeeze: bool = False


def _ways(selectors: tuple[str, ...], **how) -> tuple[Body, ...]:
    return tuple(Body(within=s, **how) for s in selectors)


_ANY = Body(pieces="p")

# Where each site keeps its article.
PROFILES = {
    "banki": PageProfile(
        (Body("article", "p", settles=True), Body("main", "p", settles=True), _ANY), squeeze=True
    ),
    "cbr": PageProfile(
        (Body("article", "p", settles=True), Body("main", "p", settles=True), _ANY), squeeze=True
    ),
    "minfin": PageProfile(
        _ways(
            ("article", ".news-detail", ".press-detail", ".content", ".b-detail", "main"),
            pieces="p",
        )
        + (_ANY,),
        squeeze=True,
    ),
    "nalog": PageProfile(
        _ways(
            (
                "div.text_block",
                "div.page-content__center",
                "div.news-detail__text",
                "div.article-text",
                "div.news-text",
                "div.content-text",
                "article",
            ),
            pieces="p",
            piece_sep="",
            join=" ",
        ),
        close_paragraphs=False,
    ),
    "interfax": PageProfile(
        (Body("article[itemprop='articleBody']", drop="script, style, aside", piece_sep="\n"),),
        dates=("meta[itemprop='datePublished']@content",),
        close_paragraphs=False,
    ),
    "kommersant": PageProfile(
        (
            Body(".article_text_wrapper", "p.doc__text", join="\n\n", longer_than=5),
            *(
                way
                for box in (".doc__body", "[itemprop='articleBody']", ".b-article__text")
                for way in (
                    Body(
                        box,
                        "p, h2, h3, li",
                        join="\n\n",
                        longer_than=10,
                        drop=".incut, .doc__authors, .doc__tags, .doc__share, script, style, "
                        ".adv, [class*='advert'], [class*='banner']",
                    ),
                    Body(box, piece_sep="\n", settles=True),
                )
            ),
            Body("meta[name='description']", attribute="content"),
            Body("meta[property='og:description']", attribute="content"),
        ),
        close_paragraphs=False,
    ),
    "garant": PageProfile(
        (Body(pieces=".clearfix ul, .clearfix p", piece_sep="", join="\n\n"),),
        dates=("time[datetime]@datetime", "ld+json"),
    ),
    "palata": PageProfile(
        (Body("div.article__content", settles=True), Body("article", settles=True), Body()),
        title="a.link@title",
        squeeze=True,
    ),
    "rbc": PageProfile(
        (
            Body("div.article__text", "p", piece_sep="", join=" "),
            Body(pieces="p.paragraph", piece_sep="", join=" "),
            Body("span.js-article-pro-anons-text", piece_sep=""),
        ),
        close_paragraphs=False,
    ),
}


def _squeezed(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


def _body_text(root: markup.Element, profile: PageProfile) -> str:
    for way in profile.bodies:
        box = root.find(way.within) if way.within else root
        if box is None:
            continue
        if way.attribute:
            found = box.attrs.get(way.attribute, "").strip()
        else:
            if way.drop:
                box.drop(way.drop)
            if way.pieces:
                held = [
                    (p.text(way.piece_sep), p.text()) for p in box.find_all(way.pieces)
                ]
                texts = [t for t, bare in held if len(bare) > way.longer_than]
                if profile.squeeze:
                    texts = [t for t in map(_squeezed, texts) if t]
                found = way.join.join(texts)
            else:
                found = box.text(way.piece_sep)
                found = _squeezed(found) if profile.squeeze else found
        if found or way.settles:
            return found
    return ""


def _title(root: markup.Element, selector: str) -> str:
    path, _, attribute = selector.partition("@")
    el = root.find(path)
    if el is None:
        return ""
    return (el.attrs.get(attribute, "").strip() if attribute else "") or el.text()


def _iso_day(raw: str) -> str:
    try:
        return datetime.datetime.fromisoformat(raw).date().isoformat()
    except ValueError:
        return ""


def _date(root: markup.Element, profile: PageProfile) -> str:
    for way in profile.dates:
        if way == "ld+json":
            el = root.find("script[type='application/ld+json']")
            raw = "".join(n for n in el.nodes if isinstance(n, str)) if el else ""
            try:
                data = json.loads(raw)
            except ValueError:
                continue
            day = _iso_day(str(data.get("datePublished") or "")[:19]) if isinstance(data, dict) else ""
        else:
            path, _, attribute = way.partition("@")
            el = root.find(path)
            raw = el.attrs.get(attribute, "") if el else ""
            day = raw if path.startswith("meta") else _iso_day(raw)
        if day:
            return day
    return ""


# Pages read before their rows are handed on; an Arrow batch has thousands of pages.
PAGES_AT_ONCE = 64
_KINDS = {"string": pa.string(), "long": pa.int64(), "array<string>": pa.list_(pa.string())}


def _read_batches(
    batches: Iterator[pa.RecordBatch], read: Callable[[str], list[tuple]], columns: dict[str, str]
) -> Iterator[pa.RecordBatch]:
    """The key of a page before each row of ``read(html)``, for batches of keys and pages."""
    for batch in batches:
        schema = pa.schema([batch.schema.field(0), *(pa.field(n, _KINDS[k]) for n, k in columns.items())])
        for at in range(0, batch.num_rows, PAGES_AT_ONCE):
            part = batch.slice(at, PAGES_AT_ONCE)
            keyed = zip(part.column(0).to_pylist(), part.column(1).to_pylist())
            rows = [(key, *row) for key, html in keyed for row in read(html)]
            cells = zip(*rows) if rows else [()] * len(schema)
            arrays = [pa.array(cell, field.type) for cell, field in zip(cells, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def read_pages(
    pages: DataFrame, id_col: str, html_col: str, read: Callable[[str], list[tuple]], columns: dict[str, str]
) -> DataFrame:
    """``id`` and ``columns`` (name to Spark type) of each row of ``read(html)``.

    Few pages at a time become Python strings and trees, so a worker's memory does not
    grow with the rows of a batch.
    """
    id_type = pages.schema[id_col].dataType.simpleString()
    kept = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    return pages.select(id_col, html_col).mapInArrow(
        lambda batches: _read_batches(batches, read, columns), f"{id_col} {id_type}, {kept}"
    )


def extract_articles(pages: DataFrame, profile: PageProfile, id_col: str, html_col: str = "html") -> DataFrame:
    """``(id, title, date, text)`` of each page; ``""`` where nothing is found."""

    def read(html: str) -> list[tuple]:
        root = markup.parse(html, profile.close_paragraphs)
        # The title first: reading the body may drop elements.
        return [(_title(root, profile.title), _date(root, profile), _body_text(root, profile))]

    return read_pages(pages, id_col, html_col, read, {"title": "string", "date": "string", "text": "string"})


def review_entries(
    pages: DataFrame, categories: tuple[str, ...], link_mark: str, id_col: str, html_col: str = "html", min_title: int = 30
) -> DataFrame:
    """``(id, pos, category, href, title, text)`` of review pages.

    A heading naming a category opens it, any other ``h3`` closes it. Under an
    open category each element with a marked link starts an entry, whose text
    is what follows up to the next heading, rule or marked link.
    """
    id_type = pages.schema[id_col].dataType.simpleString()
    upper = tuple(c.upper() for c in categories)

    def marked(el: markup.Element):
        link = el.find("a[href]")
        return link if link is not None and link_mark in link.attrs["href"] else None

    def following(el: markup.Element):
        siblings = [n for n in el.parent.nodes if isinstance(n, markup.Element)]
        for near in siblings[siblings.index(el) + 1 :]:
            if near.tag in ("h3", "hr") or marked(near) is not None:
                return
            if near.text():
                yield near

    def entry(el: markup.Element) -> tuple[str, str]:
        near = list(following(el))
        if near and near[0].find("strong") is not None:
            return near[0].text(), "\n".join(n.text() for n in near[1:])
        lines = [n.text() for n in near]
        return (lines[0], "\n".join(lines[1:])) if lines else ("", "")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, html in zip(batch[id_col], batch[html_col]):
                category = ""
                for el in markup.parse(html, close_paragraphs=False).find_all("h3, p"):
                    heading = el.text().upper()
                    strong = el.tag == "p" and el.find("strong") is not None
                    if el.tag == "h3" or (strong and heading in upper):
                        named = heading if heading in upper else next((c for c in upper if c in heading), "")
                        category = named or ("" if el.tag == "h3" else category)
                    link = marked(el)
                    if category and link is not None and len(link.text()) > min_title:
                        rows.append((key, len(rows), category, link.attrs["href"], *entry(el)))
            yield pd.DataFrame(rows, columns=[id_col, "pos", "category", "href", "title", "text"])

    return pages.select(id_col, html_col).mapInPandas(
        read,
        f"{id_col} {id_type}, pos long, category string, href string, title string, text string",
    )


# Headings of the review pages whose entries are kept.
REVIEW_CATEGORIES = (
    "НАЛОГИ, СБОРЫ И ДРУГИЕ ОБЯЗАТЕЛЬНЫЕ ПЛАТЕЖИ",
    "ВНЕШНЕЭКОНОМИЧЕСКАЯ ДЕЯТЕЛЬНОСТЬ. ТАМОЖЕННОЕ ДЕЛО",
    "ФИНАНСЫ. БЮДЖЕТ",
    "БАНКОВСКОЕ ДЕЛО",
    "АНТИКРИЗИСНЫЕ МЕРЫ",
)

_ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*(?:"[^"]*"|'[^']*')[^>]*>.*?</a\s*>"""
_HREF = r"""(?is)^<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)')"""
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"


@F.pandas_udf(StringType())
def unescape(values: pd.Series) -> pd.Series:
    """All character references, named and numeric, as HTML reads them."""
    return values.map(html_unescape, na_action="ignore")


def extract_links(
    pages: DataFrame,
    base_url: str | Column,
    keep: tuple[str, ...] = (),
    html_col: str = "html",
) -> DataFrame:
    """A row per link: the page's columns, ``pos``, ``href``, ``anchor``, ``link``.

    ``keep`` are parts of which one must occur in the link. ``is_article`` tells
    whether the last path step is a number.
    """
    rest = [c for c in pages.columns if c != html_col]
    visible = F.regexp_replace(html_col, _HIDDEN, "")
    found = pages.select(
        *rest, F.posexplode(F.regexp_extract_all(visible, F.lit(_ANCHOR), F.lit(0))).alias("pos", "raw")
    )
    href = F.concat(F.regexp_extract("raw", _HREF, 1), F.regexp_extract("raw", _HREF, 2))
    anchor = F.regexp_replace("raw", r"(?s)<[^>]*>", " ")
    links = found.select(
        *rest,
        "pos",
        unescape(href).alias("href"),
        normalize_whitespace(unescape(anchor)).alias("anchor"),
    )
    if keep:
        wanted = F.lit(False)
        for part in keep:
            wanted = wanted | F.col("href").contains(part)
        links = links.filter(wanted)
    tail = F.element_at(F.split(F.regexp_replace("href", "^/+|/+$", ""), "/"), -1)
    return links.withColumn("link", resolve_url(F.col("href"), base_url)).withColumn(
        "is_article", tail.rlike("^[0-9]+$")
    )
