"""Candidates, top and reserve lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pressmill.functions.replies import as_int, clean_score, ranked_items
from pressmill.functions.text import text_or_empty
from pressmill.operators.quality import require_columns
from pressmill.schema import RANK_COLUMNS

MAX_CANDIDATES = 30
TOP_N, RESERVE_N = 10, 5


def candidate_topk(
    scored: DataFrame,
    topic: str = "topic",
    order: str | list[str] = "ord",
    limit: int = MAX_CANDIDATES,
) -> DataFrame:
    """The best ``limit`` candidates per topic, with their position ``pos``.

    Equal scores are ordered by ``order``. The rank filter becomes a group limit
    below the shuffle, so each task sends at most ``limit`` rows per topic.
    """
    order = [order] if isinstance(order, str) else order
    best = Window.partitionBy(topic).orderBy(F.desc("clean_score"), *order)
    return (
        scored.filter("is_candidate")
        .withColumn("clean_score", clean_score(F.col("score").cast("string")))
        .withColumn("pos", F.row_number().over(best))
        .filter(F.col("pos") <= limit)
    )


# The fields of a candidate in the ranking request.
PAYLOAD = (
    ("row_id", "ord"),
    ("date", "news_date"),
    ("source", "source"),
    ("title", "title"),
    ("keywords", "keywords"),
    ("score", "clean_score"),
    ("topic", "subject"),
    ("short_summary", "summary"),
    ("reason", "reason"),
)


def candidate_payload(top: DataFrame, topic: str = "topic") -> DataFrame:
    """``(topic, n, payload)``: one JSON array per topic in score order.

    ``top`` comes from ``candidate_topk``, so a group is at most its limit.
    """

    def value(name: str, column: str):
        if column not in top.columns:
            return F.lit("").alias(name)
        if name in ("row_id", "score"):
            return F.col(column).alias(name)
        return text_or_empty(F.col(column)).alias(name)

    item = F.struct(*[value(n, c) for n, c in PAYLOAD])
    rows = F.array_sort(F.collect_list(F.struct("pos", item.alias("item"))))
    return top.groupBy(topic).agg(
        F.count(F.lit(1)).alias("n"),
        F.to_json(F.transform(rows, lambda r: r["item"])).alias("payload"),
    )


def rank_top_reserve(
    scored: DataFrame,
    topic: str = "topic",
    order: str | list[str] = "ord",
    top_n: int = TOP_N,
    reserve_n: int = RESERVE_N,
) -> DataFrame:
    """``top_n + reserve_n`` candidates per topic; the first ``top_n`` are top.

    This is the ranker used when no external one is given.
    """
    return (
        candidate_topk(scored.drop(*RANK_COLUMNS), topic, order, top_n + reserve_n)
        .withColumnRenamed("pos", "top_rank")
        .withColumn("is_top", F.col("top_rank") <= top_n)
    )


def ranks_from_replies(replies: DataFrame, reply: str = "reply", topic: str = "topic") -> DataFrame:
    """``(topic, row_id, rank)`` from ranking replies; the last mention wins."""
    items = replies.select(topic, F.posexplode(ranked_items(F.col(reply))).alias("at", "item"))
    usable = items.select(
        topic, "at", F.col("item.row_id").try_cast("long").alias("row_id"), as_int(F.col("item.rank")).alias("rank")
    ).filter("row_id is not null and rank > 0")
    return usable.groupBy(topic, "row_id").agg(F.max_by("rank", "at").alias("rank"))


def apply_ranking(
    rows: DataFrame,
    ranks: DataFrame,
    topic: str = "topic",
    order: str = "ord",
    top_n: int = TOP_N,
    only: list[str] | None = None,
) -> DataFrame:
    """Set ``top_rank`` and ``is_top`` from ``(topic, row_id, rank)``; others reset.

    With ``only`` the rows of other topics keep the ranking they have.
    """
    given = ranks.select(F.col(topic), F.col("row_id").alias(order), F.col("rank").alias("_rank"))
    empty = reset_ranking(rows.drop(*RANK_COLUMNS))
    known = empty if only is None or not set(RANK_COLUMNS) <= set(rows.columns) else rows
    joined = known.join(given, [topic, order], "left")
    touched = F.lit(True) if only is None else F.col(topic).isin(only)
    rank = F.when(touched, F.col("_rank")).otherwise(F.col("top_rank"))
    flag = F.when(touched, F.coalesce(F.col("_rank") <= top_n, F.lit(False))).otherwise(F.col("is_top"))
    return joined.withColumns({"top_rank": rank, "is_top": flag}).drop("_rank")


def reset_ranking(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"top_rank": F.lit(None).cast("int"), "is_top": F.lit(False)})


def global_topk(rows: DataFrame, limit: int, columns: list[str], order: str = "ord") -> DataFrame:
    """The ``limit`` best rows by numeric score, rows without one last."""
    require_columns(rows, ["score"])
    number = F.col("score").cast("string").try_cast("double")
    return (
        rows.withColumn("_n", F.when(~F.isnan(number), number))
        .orderBy(F.desc_nulls_last("_n"), order)
        .limit(limit)
        .select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns])
    )
