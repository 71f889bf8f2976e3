"""Recipients and per-topic digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressmill.functions.text import strip, text_or_empty, url_domain

# What a valid address looks like.
MAIL = r"^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}$"


def recipients_by_topic(recipients: DataFrame, mail: str, topics: str, order: str) -> DataFrame:
    """``(topic, mail, first_ord)``: the distinct valid addresses per topic.

    ``first_ord`` gives the first-seen order. The list stays in rows, as a topic
    may have any number of recipients.
    """
    wanted = F.filter(F.transform(F.split(F.col(topics), ","), strip), lambda t: t != "")
    return (
        recipients.select(strip(F.col(mail)).alias("mail"), F.col(order).alias("_ord"), F.explode(wanted).alias("topic"))
        .filter(F.col("mail").rlike(MAIL))
        .groupBy("topic", "mail")
        .agg(F.min("_ord").alias("first_ord"))
    )


# Texts shown where a field is empty.
NO_TITLE, NO_URL, NO_SOURCE, NO_SUMMARY = "Без заголовка", "#", "unknown", "—"


def _or(col: Column, default: str) -> Column:
    return F.coalesce(F.nullif(col.cast("string"), F.lit("")), F.lit(default))


def meta_line(url: Column, source: Column, date_text: Column) -> Column:
    name = _or(source, NO_SOURCE)
    site = F.coalesce(F.nullif(url_domain(url), F.lit("")), name)
    shown = text_or_empty(date_text)
    return F.when(shown != "", F.concat(site, F.lit(" • "), shown)).otherwise(name)


def topic_digest(rows: DataFrame, topic: str = "topic", order: str = "ord", limit: int = 10) -> DataFrame:
    """The cards of each topic's digest: ``(topic, total, pos, title, ...)``.

    Top ``limit`` rows by score, unscored last. Totals are counted apart, so the
    ranking keeps its per-task group limit.
    """
    number = F.col("score").cast("string").try_cast("double")
    name = strip(text_or_empty(F.col(topic)))
    placed = rows.withColumn("_topic", name).filter("_topic <> ''").withColumn("_n", number)
    best = Window.partitionBy("_topic").orderBy(F.desc_nulls_last("_n"), order)
    cards = (
        placed.withColumn("pos", F.row_number().over(best))
        .filter(F.col("pos") <= limit)
        .select(
            F.col("_topic").alias("topic"),
            "pos",
            F.col(order).alias("ord"),
            _or(F.col("title"), NO_TITLE).alias("title"),
            _or(F.col("url"), NO_URL).alias("url"),
            _or(F.col("summary"), NO_SUMMARY).alias("summary"),
            meta_line(F.col("url"), F.col("source"), F.col("news_date")).alias("meta"),
        )
    )
    totals = placed.groupBy(F.col("_topic").alias("topic")).agg(F.count(F.lit(1)).alias("total"))
    return totals.join(cards, "topic")


def digest_mailings(cards: DataFrame, recipients: DataFrame) -> DataFrame:
    """``(topic, total, n_mails)`` of the digests to send; none without recipients."""
    lists = recipients.groupBy("topic").agg(F.count(F.lit(1)).alias("n_mails"))
    return cards.select("topic", "total").distinct().join(lists, "topic")
