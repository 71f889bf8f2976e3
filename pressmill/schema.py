"""Row shapes and the source and topic dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

ITEM = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("url", "title", "date", "text", "matched_keyword", "review_date", "category")
    ]
)

DAY_ENTRY = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("processed_at", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("links_found", T.LongType()),
        T.StructField("items", T.ArrayType(ITEM)),
        T.StructField("articles", T.ArrayType(ITEM)),
    ]
)

EXPORT_COLUMNS = ("news_date", "title", "text", "url", "source", "topic", "keywords")

SCORE_COLUMNS = ("topic_id", "score", "is_candidate", "subject", "summary", "reason")

RANK_COLUMNS = ("top_rank", "is_top")


@dataclass(frozen=True)
class Source:
    id: str
    label: str
    order: int
    root_key: str = "days"
    # Spark date pattern of the day keys; empty for the cutoff-window sources.
    key_format: str = ""
    # Articles without text are dropped for these sources.
    needs_text: bool = False


# The known sites.
SOURCES = (
    Source("banki", "Банки.ру", 10, needs_text=True),
    Source("cbr", "Центробанк", 20, needs_text=True),
    Source("garant", "Гарант.ру", 30),
    Source("interfax", "Interfax", 40, key_format="yyyy/MM/dd"),
    Source("kommersant", "Kommersant", 50, key_format="yyyy-MM-dd"),
    Source("minfin", "МинФин", 60, needs_text=True),
    Source("nalog", "ФНС", 70, needs_text=True),
    Source("palata", "Палата НК", 80, needs_text=True),
    Source("rbc", "РБК", 90),
    Source("consultant", "Consultant", 100, root_key="reviews"),
)


@dataclass(frozen=True)
class Topic:
    id: str
    title: str
    aliases: tuple[str, ...] = ()


# The known topics and the names they go by.
TOPICS = (
    Topic("payment_systems", "ПС", ("ПС", "ЦК по платежным системам")),
    Topic("ssem", "ССЭМ", ("ССЭМ", "ЦК ССЭМ")),
    Topic("taxes", "Налоги", ("Налоги", "ЦК по налогам")),
)


def source_dim(spark: SparkSession, sources: tuple[Source, ...] = SOURCES) -> DataFrame:
    rows = [(s.id, s.label, s.order, s.root_key, s.key_format) for s in sources]
    return spark.createDataFrame(
        rows,
        "source_id string, source_label string, source_order int, root_key string, key_format string",
    )


def topic_dim(spark: SparkSession, topics: tuple[Topic, ...] = TOPICS) -> DataFrame:
    rows = [(t.id, t.title, list(t.aliases)) for t in topics]
    return spark.createDataFrame(
        rows, "topic_id string, topic_title string, aliases array<string>"
    )
