"""Queries of the column operators: text, dates, dimensions, model fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressmill.functions import dates as dt
from pressmill.functions import replies as rp
from pressmill.functions import text as tx
from pressmill.operators import articles as ar
from pressmill.plans.registry import query
from pressmill.plans.standins import ART, LABELLED, TITLED, articles, table


def _items(spark, d):
    """Articles in the two item shapes: current names and older ones."""
    art = articles(spark, d)
    old = F.col("ord") % 3 == 0
    day = F.col("news_date").cast("string")
    return art.select(
        "ord",
        "source",
        "topic",
        F.when(F.col("ord") % 11 != 0, F.col("url")).alias("url"),
        F.when(F.col("ord") % 7 != 0, F.col("title")).alias("title"),
        F.when(old, F.lit("")).otherwise(day).alias("date"),
        F.when(F.col("ord") % 5 != 0, F.col("text")).alias("text"),
        F.when(~old, F.col("topic")).alias("matched_keyword"),
        F.when(old, day).alias("review_date"),
        F.when(F.col("ord") % 2 == 0, F.concat(F.lit("cat "), "topic")).alias("category"),
    )


ITEMS = (
    ART
    + """, items AS (
  SELECT ord, source, topic,
         CASE WHEN ord % 11 <> 0 THEN url ELSE '' END AS url,
         CASE WHEN ord % 7 <> 0 THEN title ELSE '' END AS title,
         CAST(news_date AS VARCHAR) AS date,
         CASE WHEN ord % 5 <> 0 THEN text ELSE '' END AS text,
         CASE WHEN ord % 3 <> 0 THEN topic WHEN ord % 2 = 0 THEN 'cat ' || topic ELSE '' END AS matched_keyword
  FROM art)"""
)


@query(
    "normalize_articles",
    f"WITH {ITEMS} SELECT ord, url, title, date, md5(text) AS text_md5, matched_keyword FROM items",
)
def normalize_articles(spark, d):
    out = ar.normalize_articles(_items(spark, d))
    return out.select("ord", "url", "title", "date", F.md5("text").alias("text_md5"), "matched_keyword")


@query(
    "build_search_text",
    f"""WITH {ITEMS} SELECT ord, CAST(length(title || ' ' || text) AS BIGINT) AS n,
    md5(title || ' ' || text) AS text_md5 FROM items""",
)
def build_search_text(spark, d):
    out = ar.normalize_articles(_items(spark, d)).withColumn(
        "t", tx.search_text(F.col("title"), F.col("text"))
    )
    return out.select("ord", F.length("t").cast("long").alias("n"), F.md5("t").alias("text_md5"))


@query(
    "project_export",
    f"""WITH {ITEMS} SELECT ord, strftime(CAST(date AS DATE), '%d.%m.%Y') AS news_date, title, url,
    CASE WHEN CAST(substr(source, 4) AS INTEGER) < 10 THEN 'Site ' || substr(source, 4) ELSE source END AS source,
    CASE topic WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' ELSE topic END AS topic,
    matched_keyword AS keywords, sha256(text) AS text_sha256 FROM items""",
)
def project_export(spark, d):
    out = ar.project_export(ar.normalize_articles(_items(spark, d)), LABELLED, TITLED)
    return out.withColumn("text_sha256", F.sha2("text", 256)).drop("text")


_MONTH_LIST = list(dt.MONTHS)
_SQL_MONTHS = "[" + ", ".join(f"'{m}'" for m in _MONTH_LIST) + "]"


def _date_texts(spark, d):
    day = F.col("o_orderdate").cast("date")
    names = F.array(*[F.lit(m) for m in _MONTH_LIST])
    named = F.concat_ws(
        " ", F.dayofmonth(day).cast("string"), F.element_at(names, F.month(day)), F.year(day).cast("string")
    )
    kind = F.col("o_orderkey") % 7
    return table(spark, d, "orders").select(
        "o_orderkey",
        day.alias("day"),
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 1, F.date_format(day, "yyyy/MM/dd"))
        .when(kind == 2, F.date_format(day, "'on 'd.M.yyyy"))
        .when(kind == 3, F.concat(F.lit(" "), named, F.lit(" г.")))
        .when(kind == 4, F.concat(F.lit("31.02."), F.year(day).cast("string")))
        .when(kind == 5, F.concat(F.lit("12345-01-01 "), F.col("o_orderpriority")))
        .alias("raw"),
    )


DATE_TEXTS = f"""texts AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderkey % 7 AS kind, o_orderpriority,
  CAST(year(o_orderdate) AS VARCHAR) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
  CAST(day(o_orderdate) AS VARCHAR) AS dd, {_SQL_MONTHS}[month(o_orderdate)] AS mname FROM orders)"""


@query(
    "format_news_date",
    f"""WITH {DATE_TEXTS} SELECT o_orderkey, CASE WHEN kind IN (0, 1, 2, 3) THEN strftime(day, '%d.%m.%Y')
    WHEN kind = 4 THEN '31.02.' || y WHEN kind = 5 THEN '12345-01-01 ' || o_orderpriority ELSE '' END AS shown
    FROM texts""",
)
def format_news_date(spark, d):
    return _date_texts(spark, d).select("o_orderkey", dt.format_news_date(F.col("raw")).alias("shown"))


@query(
    "parse_news_date",
    f"""WITH {DATE_TEXTS} SELECT o_orderkey, CASE WHEN kind IN (0, 1, 2) THEN day END AS news_date FROM texts""",
)
def parse_news_date(spark, d):
    return _date_texts(spark, d).select("o_orderkey", dt.parse_news_date(F.col("raw")).alias("news_date"))


@query(
    "parse_source_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS news_date
    FROM orders""",
)
def parse_source_dates(spark, d):
    raw = _date_texts(spark, d).select("o_orderkey", "day")
    day, key = F.col("day"), F.col("o_orderkey")
    names = F.array(*[F.lit(m) for m in _MONTH_LIST])
    named = F.concat_ws(
        "  ", F.dayofmonth(day).cast("string"), F.element_at(names, F.month(day)), F.year(day).cast("string")
    )
    texts = {
        "mail": F.date_format(day, "E, dd MMM yyyy '23:30:00 +0300'"),
        "short_dotted": F.when(key % 2 == 0, F.date_format(day, "dd.MM.yy")).otherwise(
            F.date_format(day, "'Дата' dd.MM.yyyy 'вечер'")
        ),
        "long_dotted": F.date_format(day, "dd.MM.yyyy '09:15'"),
        "iso_prefix": F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'+03:00'"),
        "named_month": named,
    }
    out = F.lit(None).cast("date")
    for pos, (style, text) in enumerate(texts.items()):
        written = F.when(key % 13 == 0, F.concat(F.lit("x"), F.substring(text, 3, 4))).otherwise(text)
        out = F.when(key % 5 == pos, dt.parse_source_date(written, style)).otherwise(out)
    return raw.select("o_orderkey", out.alias("news_date"))


@query(
    "normalize_whitespace",
    """SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS text_md5,
    CAST(length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS BIGINT) AS n FROM documents""",
)
def normalize_whitespace(spark, d):
    out = table(spark, d, "documents").select("doc_id", tx.normalize_whitespace(F.col("text")).alias("t"))
    return out.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").cast("long").alias("n"))


_CLEAN = tx.CleanProfile(
    collapse_space=True,
    drop_leading_title=True,
    drop_patterns=(r"^.*?the\s+of\s*", r"licen[sc]e\s*"),
    cut_at="tion and",
    late_replacements=((r"\s+", " "), ("ment", "")),
)


@query(
    "strip_boilerplate",
    f"""WITH {ART}, a AS (SELECT ord, title, regexp_replace(text, '\\s+', ' ', 'g') AS t FROM art),
    b AS (SELECT ord, CASE WHEN title <> '' AND starts_with(t, title)
        THEN trim(substr(t, length(title) + 1)) ELSE t END AS t FROM a),
    c AS (SELECT ord, regexp_replace(regexp_replace(t, '^.*?the\\s+of\\s*', ''), 'licen[sc]e\\s*', '', 'g') AS t FROM b),
    e AS (SELECT ord, rtrim(split_part(t, 'tion and', 1)) AS t FROM c),
    f AS (SELECT ord, regexp_replace(regexp_replace(t, '\\s+', ' ', 'g'), 'ment', '', 'g') AS t FROM e)
    SELECT ord, CAST(length(t) AS BIGINT) AS n, md5(t) AS text_md5 FROM f""",
)
def strip_boilerplate(spark, d):
    art = articles(spark, d)
    out = art.select("ord", tx.strip_boilerplate(F.col("text"), _CLEAN, F.col("title")).alias("t"))
    return out.select("ord", F.length("t").cast("long").alias("n"), F.md5("t").alias("text_md5"))


@query(
    "normalize_url_key",
    "SELECT page_id, rtrim(url || '/x', '/') AS url_key FROM pages",
)
def normalize_url_key(spark, d):
    pages = table(spark, d, "pages")
    raw = F.concat(F.lit(" "), "url", F.lit("/x"), F.repeat(F.lit("/"), (F.col("page_id") % 4).cast("int")), F.lit("\n"))
    return pages.select("page_id", tx.url_key(raw).alias("url_key"))


@query(
    "resolve_url",
    """WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) AS root,
      split_part(url, ':', 1) AS scheme, regexp_extract(url, '^[a-z]+://[^/]*/([^?#]*/)?', 0) AS folder FROM pages)
    SELECT page_id, CASE page_id % 4 WHEN 0 THEN root || '/a/1' WHEN 1 THEN 'https://other.example/b'
      WHEN 2 THEN scheme || '://cdn.example/c' ELSE folder || 'd?x=1' END AS link FROM p""",
)
def resolve_url(spark, d):
    kind = F.col("page_id") % 4
    href = (
        F.when(kind == 0, "/a/1")
        .when(kind == 1, "https://other.example/b")
        .when(kind == 2, "//cdn.example/c")
        .otherwise("d?x=1")
    )
    return table(spark, d, "pages").select("page_id", tx.resolve_url(href, F.col("url")).alias("link"))


@query(
    "url_domain",
    """SELECT page_id, regexp_replace(regexp_extract(u, '^[a-z]+://([^/?#]*)', 1), '^www\\.', '') AS domain
    FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN replace(url, '://', '://www.') ELSE url END AS u FROM pages)""",
)
def url_domain(spark, d):
    raw = F.when(F.col("page_id") % 3 == 0, F.replace("url", F.lit("://"), F.lit("://www."))).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", tx.url_domain(raw).alias("domain"))


@query(
    "normalize_topic",
    """SELECT topic_id, count(*) AS n FROM (
      SELECT CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment WHEN c_custkey % 5 = 1 THEN r_name ELSE r_name END AS topic_id
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    GROUP BY topic_id""",
)
def normalize_topic(spark, d):
    nation = table(spark, d, "nation").join(
        table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    aliases = nation.select(F.col("n_name").alias("alias"), F.col("r_name").alias("topic_id")).unionByName(
        nation.select(F.col("r_name").alias("alias"), F.col("r_name").alias("topic_id"))
    )
    kind = F.col("c_custkey") % 5
    names = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(kind == 0, F.col("c_mktsegment"))
        .when(kind == 1, F.concat(F.lit("  "), "r_name"))
        .otherwise(F.concat("n_name", F.lit(" ")))
        .alias("name")
    )
    out = ar.normalize_topic_by_table(names, "name", aliases)
    return out.groupBy("topic_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "coerce_model_columns",
    """WITH e AS (SELECT event_id, event_id % 6 AS kind, value, event_type FROM events)
    SELECT event_id,
      CAST(CASE kind WHEN 0 THEN least(100, trunc(value)) WHEN 1 THEN 0 WHEN 2 THEN 100 WHEN 3 THEN 0
        WHEN 4 THEN least(100, trunc(value)) ELSE 75 END AS INTEGER) AS score,
      CASE kind WHEN 0 THEN trunc(value) >= 60 WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN false
        WHEN 4 THEN true ELSE false END AS is_candidate,
      CASE WHEN kind = 5 THEN 'not_relevant' ELSE event_type END AS subject,
      CASE WHEN kind % 2 = 0 THEN 'long' ELSE 'short' END AS summary
    FROM e""",
)
def coerce_model_columns(spark, d):
    kind = F.col("event_id") % 6
    value = F.col("value").cast("string")
    score = (
        F.when(kind == 0, value).when(kind == 1, F.lit("bad")).when(kind == 2, F.lit("150.5"))
        .when(kind == 3, F.lit("-3")).when(kind == 4, F.concat(F.lit(" "), value)).otherwise(F.lit("7.5e1"))
    )
    flag = F.when(kind == 1, F.lit(" TRUE ")).when(kind == 2, F.lit("Да")).when(kind == 4, F.lit("yes")).otherwise(F.lit("0"))
    base = F.create_map(
        F.lit("score"), score,
        F.lit("topic"), F.when(kind != 5, F.col("event_type")).otherwise(""),
        F.lit("summary"), F.when(kind % 2 == 0, F.lit(" long ")).otherwise(F.lit("")),
        F.lit("short_summary"), F.lit("short"),
    )
    fields = F.when(kind == 0, base).otherwise(F.map_concat(base, F.create_map(F.lit("is_candidate"), flag)))
    out = table(spark, d, "events").select("event_id", fields.alias("f"))
    cols = rp.score_columns(F.col("f"))
    return out.select("event_id", *[cols[n].alias(n) for n in ("score", "is_candidate", "subject", "summary")])


@query(
    "build_embedding_text",
    f"""WITH {ART}, t AS (SELECT ord, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title,
      trim(regexp_replace(text, '\\s+', ' ', 'g')) AS body FROM art)
    SELECT ord, md5(rtrim('Заголовок: ' || title || chr(10) || 'Краткое содержание: ' ||
      CASE WHEN ord % 4 = 0 THEN 'summary ' || ord ELSE body END)) AS text_md5 FROM t""",
)
def build_embedding_text(spark, d):
    summary = F.when(F.col("ord") % 4 == 0, F.concat(F.lit(" summary  "), F.col("ord").cast("string")))
    text = tx.embedding_text(F.col("title"), summary, F.col("text"))
    return articles(spark, d).select("ord", F.md5(text).alias("text_md5"))


_TEMPLATES = {
    "en": "Rate this for {topic}.\nDate: {news_date}\nSource: {source}\nTitle: {title}\nText:\n{text}",
    "de": "Bewerte {topic}: {title} ({source})\n{text}",
    "fr": "Note {title}\n{text}\n{title}",
}


@query(
    "build_prompt_column",
    f"""WITH {ART}, t AS (SELECT ord, topic, news_date, source, title, trim(text, ' ' || chr(10)) AS body FROM art),
    p AS (SELECT ord, topic, CASE topic
      WHEN 'en' THEN 'Rate this for en.' || chr(10) || 'Date: ' || news_date || chr(10) || 'Source: ' || source || chr(10) ||
        'Title: ' || title || chr(10) || 'Text:' || chr(10) || body
      WHEN 'de' THEN 'Bewerte de: ' || title || ' (' || source || ')' || chr(10) || body
      WHEN 'fr' THEN 'Note ' || title || chr(10) || body || chr(10) || title END AS prompt FROM t)
    SELECT ord, md5(prompt) AS prompt_md5, CAST(length(prompt) AS BIGINT) AS n FROM p""",
)
def build_prompt_column(spark, d):
    fields = {n: F.col(n) for n in ("topic", "news_date", "source", "title", "text")}
    prompt = tx.prompt_for_topic(F.col("topic"), _TEMPLATES, fields)
    out = articles(spark, d).select("ord", prompt.alias("p"))
    return out.select("ord", F.md5("p").alias("prompt_md5"), F.length("p").cast("long").alias("n"))


@query(
    "explode_keywords",
    f"""WITH {ART}, k AS (SELECT ord, CASE ord % 5
        WHEN 0 THEN [topic, source] WHEN 1 THEN [topic || ' word'] WHEN 2 THEN [] WHEN 3 THEN []
        ELSE [source] END AS ks FROM art)
    SELECT ord, unnest(ks) AS keyword FROM k""",
)
def explode_keywords(spark, d):
    kind = F.col("ord") % 5
    cell = (
        F.when(kind == 0, F.concat(F.lit("['"), "topic", F.lit("', \""), "source", F.lit('" , \'\']')))
        .when(kind == 1, F.concat(F.lit("  "), "topic", F.lit(" word ")))
        .when(kind == 2, F.lit("[ ]"))
        .when(kind == 4, F.concat(F.lit("["), "source", F.lit("]")))
    )
    out = articles(spark, d).select("ord", F.explode(tx.keyword_list(cell)).alias("keyword"))
    return out
