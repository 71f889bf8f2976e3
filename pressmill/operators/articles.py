"""Row shaping and article filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressmill.functions import text as tx
from pressmill.functions.dates import format_news_date
from pressmill.schema import SOURCES, TOPICS, Source, Topic


def normalize_articles(items: DataFrame) -> DataFrame:
    """Unify source shapes; other columns (lineage, order) pass through.

    ``date`` and ``matched_keyword`` fall back when empty, the other fields only
    when missing.
    """

    def col(name: str) -> Column:
        return F.col(name) if name in items.columns else F.lit(None).cast("string")

    shaped = {
        "url": tx.text_or_empty(col("url")),
        "title": tx.text_or_empty(col("title")),
        "date": tx.falsy_fallback(col("date"), col("review_date")),
        "text": tx.text_or_empty(col("text")),
        "matched_keyword": tx.falsy_fallback(col("matched_keyword"), col("category")),
    }
    rest = [c for c in items.columns if c not in (*shaped, "review_date", "category")]
    return items.select(*rest, *[c.alias(n) for n, c in shaped.items()])


def _lookup(key: Column, table: dict[str, str]) -> Column:
    """Value of a small fixed dimension, null when unmapped; no join needed."""
    if not table:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def alias_table(topics: tuple[Topic, ...] = TOPICS) -> dict[str, str]:
    names = {t.id: t.id for t in topics}
    for topic in topics:
        names.update({alias: topic.id for alias in topic.aliases})
    return names


def normalize_topic(name: Column, topics: tuple[Topic, ...] = TOPICS) -> Column:
    """Topic id of an id or alias; an unknown name passes through trimmed."""
    bare = tx.strip(tx.text_or_empty(name))
    return F.coalesce(_lookup(bare, alias_table(topics)), bare)


def normalize_topic_by_table(df: DataFrame, name: str, aliases: DataFrame, out: str = "topic_id") -> DataFrame:
    """As ``normalize_topic`` with the ``(alias, topic_id)`` pairs in a table.

    No broadcast is forced: the planner broadcasts the table if it is small.
    """
    bare = df.withColumn("_name", tx.strip(tx.text_or_empty(F.col(name))))
    table = aliases.select(F.col("alias").alias("_name"), F.col("topic_id").alias("_id")).dropDuplicates(["_name"])
    return (
        bare.join(table, "_name", "left")
        .withColumn(out, F.coalesce("_id", "_name"))
        .drop("_id", "_name")
    )


def project_export(
    articles: DataFrame,
    sources: tuple[Source, ...] = SOURCES,
    topics: tuple[Topic, ...] = TOPICS,
) -> DataFrame:
    """The seven export columns; ``ord`` is kept when present.

    Labels and titles fall back to the id when unmapped.
    """
    label = F.coalesce(_lookup(F.col("source"), {s.id: s.label for s in sources}), F.col("source"))
    title = F.coalesce(_lookup(F.col("topic"), {t.id: t.title for t in topics}), F.col("topic"))
    keep = ["ord"] if "ord" in articles.columns else []
    return articles.select(
        *keep,
        format_news_date(F.col("date")).alias("news_date"),
        "title",
        "text",
        "url",
        label.alias("source"),
        title.alias("topic"),
        F.col("matched_keyword").alias("keywords"),
    )


def incomplete_reason(sources: tuple[Source, ...] = SOURCES) -> Column:
    """Why a row is dropped, null for a complete row.

    Needs ``source, url, title, text, date``. Text is required only for the
    sources whose policy says so.
    """
    strict = [s.id for s in sources if s.needs_text]

    def empty(name: str) -> Column:
        return tx.strip(tx.text_or_empty(F.col(name))) == ""

    return (
        F.when(empty("url"), "empty_url")
        .when(F.col("source").isin(strict) & (tx.text_or_empty(F.col("text")) == ""), "empty_text")
        .when(empty("date"), "empty_date")
        .when(empty("title"), "empty_title")
    )


def drop_incomplete(articles: DataFrame, sources: tuple[Source, ...] = SOURCES) -> DataFrame:
    return articles.filter(incomplete_reason(sources).isNull())


def reject_rows(articles: DataFrame, sources: tuple[Source, ...] = SOURCES) -> DataFrame:
    """``(kind, target, source)`` of the incomplete rows."""
    return (
        articles.withColumn("kind", incomplete_reason(sources))
        .filter("kind is not null")
        .select("kind", F.col("url").alias("target"), "source")
    )


# Phrases that mark a digest.
DIGEST_PHRASES = ("за неделю", "за день", "лучшие статьи недели", "новости недели")


def is_digest(title: Column, phrases: tuple[str, ...] = DIGEST_PHRASES) -> Column:
    lowered = F.lower(tx.text_or_empty(title))
    out = F.lit(False)
    for phrase in phrases:
        out = out | lowered.contains(phrase)
    return out


def category_lines(
    lines: Column, categories: tuple[str, ...], is_heading: str, entry_longer_than: int = 30
) -> Column:
    """Entries under an accepted heading, from an ordered array of lines.

    A heading line that names a category opens it, any other heading closes it,
    and the open category carries forward. The state runs inside the row, so
    there is no window and no shuffle. Result: ``array<struct<pos,category,line>>``.
    """
    state = "struct<category:string,pos:int,kept:array<struct<pos:int,category:string,line:string>>>"

    def named(line: Column) -> Column:
        upper, out = F.upper(line), F.lit("")
        for category in reversed(categories):
            out = F.when(upper.contains(category.upper()), F.lit(category)).otherwise(out)
        return out

    def step(acc: Column, line: Column) -> Column:
        heading = line.rlike(is_heading)
        category = F.when(heading, named(line)).otherwise(acc["category"])
        wanted = ~heading & (category != "") & (F.length(line) > entry_longer_than)
        entry = F.struct(acc["pos"].alias("pos"), category.alias("category"), line.alias("line"))
        return F.struct(
            category.alias("category"),
            (acc["pos"] + 1).alias("pos"),
            F.when(wanted, F.concat(acc["kept"], F.array(entry))).otherwise(acc["kept"]).alias("kept"),
        )

    start = F.from_json(F.lit('{"category":"","pos":0,"kept":[]}'), state)
    return F.aggregate(lines, start, step, lambda acc: acc["kept"])


def title_link_match(listing: DataFrame, links: DataFrame, on: str = "title") -> DataFrame:
    """Each listing title with its first matching link; unmatched rows drop out.

    ``listing`` is ``(page, ord, title, ...)`` and ``links`` ``(page, pos,
    anchor, link)``. Of equal titles on a page only the first gets the link.
    Both sides are reduced by partial aggregation before the join.
    """
    key = ["page", on]
    rows = listing.withColumn(on, tx.normalize_whitespace(F.col(on))).filter(F.col(on) != "")
    extra = [F.min_by(c, "ord").alias(c) for c in listing.columns if c not in ("page", "ord", on)]
    first_rows = rows.groupBy(key).agg(F.min("ord").alias("ord"), *extra)
    first_links = (
        links.select("page", "pos", tx.normalize_whitespace(F.col("anchor")).alias(on), "link")
        .filter(F.col(on) != "")
        .groupBy(key)
        .agg(F.min_by("link", "pos").alias("link"))
    )
    return first_rows.join(first_links, key)
