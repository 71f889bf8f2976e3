"""The given tables seen as articles, scores, profiles and dimensions.

Each Spark view has an SQL twin used by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressmill.functions.rules import Rule, RuleProfile
from pressmill.schema import Source, Topic
from pressmill.session import spread


def table(spark: SparkSession, folder: str, name: str, heavy: bool = False) -> DataFrame:
    """A given table; ``heavy`` when the work per row is worth spreading."""
    scan = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(scan) if heavy else scan


def articles(spark: SparkSession, folder: str, heavy: bool = False) -> DataFrame:
    """documents as articles: ``ord, source, topic, url, title, text, news_date``."""
    slot = F.floor(F.col("doc_id") / 20)
    return table(spark, folder, "documents", heavy).select(
        F.col("doc_id").alias("ord"),
        "source",
        F.col("lang").alias("topic"),
        F.concat_ws("/", "source", (slot % 25).cast("string")).alias("url"),
        F.trim(F.substring_index("text", "\n", 1)).alias("title"),
        "text",
        F.date_add(F.lit("2024-01-01").cast("date"), (slot % 30).cast("int")).alias("news_date"),
    )


ART = """art AS (
  SELECT doc_id AS ord, source, lang AS topic,
         source || '/' || CAST((doc_id // 20) % 25 AS VARCHAR) AS url,
         trim(split_part(text, chr(10), 1)) AS title, text,
         CAST(DATE '2024-01-01' + CAST((doc_id // 20) % 30 AS INTEGER) AS DATE) AS news_date
  FROM documents)"""


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Articles with the partial scores of ``labels``; unlabelled ones have none."""
    marks = table(spark, folder, "labels").select(
        F.col("doc_id").alias("ord"),
        (F.lit(40) + 40 * F.col("quality") - 20 * F.col("toxic")).alias("score"),
    )
    return articles(spark, folder).join(marks, "ord", "left")


SCORED = (
    ART
    + """, scored AS (
  SELECT art.*, 40 + 40 * quality - 20 * toxic AS score
  FROM art LEFT JOIN labels ON art.ord = labels.doc_id)"""
)


# Small rule packs for the four languages of the corpus.
PACKS = (
    RuleProfile(
        "alpha",
        "Alpha",
        core=(
            Rule("conjunction", r"tion\s+and\s+the"),
            Rule("licence", r"licen[sc]e"),
            Rule("articles", r"der\s+die"),
        ),
        secondary=(Rule("relative", r"que\s+de"), Rule("quality noun", r"lichkeit")),
        exclude=(Rule("mail address", r"[a-z0-9.]+@[a-z0-9.]+"), Rule("doubled", r"queque")),
        context=r"ment|heit",
    ),
    RuleProfile(
        "beta",
        "Beta",
        core=(
            Rule("joined", r"(^|[^a-z])und\s+der"),
            Rule("plural", r"los\s+de"),
            Rule("near", r"thin.{0,40}ble"),
            Rule("near", r"ble.{0,25}thin"),
        ),
        secondary=(Rule("noun", r"ción"),),
        exclude=(Rule("long number", r"\+?\d[\d -]{8,}"),),
        require_core=True,
    ),
    RuleProfile(
        "gamma",
        "Gamma",
        core=(Rule("water", r"(^|[^a-z])queeau"), Rule("upper", r"ÉRÉ")),
        secondary=(Rule("unit", r"einlich"), Rule("noun", r"ción")),
    ),
)


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_hits(rules, text: str = "txt") -> str:
    """DuckDB list of ``{label, fragment}`` for the rules that match ``text``."""
    if not rules:
        return "CAST([] AS STRUCT(label VARCHAR, fragment VARCHAR)[])"
    cells = ", ".join(
        f"{{'label': {sql_text(r.label)}, 'fragment': regexp_extract({text}, {sql_text('(?i)' + r.pattern)}, 0)}}"
        for r in rules
    )
    return f"[x FOR x IN [{cells}] IF x.fragment <> '']"


def sql_profile(profile: RuleProfile) -> str:
    """SELECT of ``ord, profile, core, secondary, excluded, require_core`` over ``st``."""
    secondary = sql_hits(profile.secondary)
    if profile.context:
        secondary = (
            f"CASE WHEN regexp_matches(txt, {sql_text('(?i)' + profile.context)}) "
            f"THEN {secondary} ELSE [] END"
        )
    return (
        f"SELECT ord, {sql_text(profile.name)} AS profile, {sql_hits(profile.core)} AS core, "
        f"{secondary} AS secondary, {sql_hits(profile.exclude)} AS excl, "
        f"{str(profile.require_core).lower()} AS require_core FROM st"
    )


ST = ART + ", st AS (SELECT *, title || ' ' || text AS txt FROM art)"
HITS = ST + ", hits AS (" + " UNION ALL ".join(sql_profile(p) for p in PACKS) + ")"
VERDICTS = (
    HITS
    + """, verdicts AS (
  SELECT *, len(excl) = 0 AND (len(core) > 0 OR (NOT require_core AND len(secondary) > 0)) AS kept
  FROM hits)"""
)


# Ten labelled sources and three titled topics; the rest fall back to their ids.
LABELLED = tuple(
    Source(f"src{i}", f"Site {i}", 10 * (i + 1), needs_text=i % 2 == 0) for i in range(10)
)
TITLED = (
    Topic("en", "English", ("English news", "EN")),
    Topic("de", "German", ("German news",)),
    Topic("fr", "French", ("French news",)),
)
