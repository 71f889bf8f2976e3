"""Queries of exact deduplication, appending and similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressmill.functions.vectors import norm
from pressmill.operators import dedupe as dd
from pressmill.operators import similarity as sm
from pressmill.plans.registry import query
from pressmill.plans.standins import ART, articles, table


def _greedy_sql(scope: str = "") -> str:
    """The sequential rule as unrolled rounds over (scope, url, title)."""
    part = f"{scope}, " if scope else ""
    ctes = [
        ART,
        """p0 AS (SELECT ord, source, topic, nullif(CASE WHEN ord % 23 = 0 THEN '' ELSE url END, '') AS u,
        nullif(CASE WHEN ord % 29 = 0 THEN '' ELSE title END, '') AS t FROM art)""",
    ]
    for n in range(8):
        ctes.append(
            f"""k{n} AS (SELECT * FROM p{n}
          QUALIFY (u IS NULL OR ord = min(ord) OVER (PARTITION BY {part}u))
             AND (t IS NULL OR ord = min(ord) OVER (PARTITION BY {part}t)))"""
        )
        same = f"k.{scope} = p.{scope} AND " if scope else ""
        ctes.append(
            f"""p{n + 1} AS (SELECT * FROM p{n} p WHERE ord NOT IN (SELECT ord FROM k{n})
          AND NOT EXISTS (SELECT 1 FROM k{n} k WHERE {same}k.u = p.u)
          AND NOT EXISTS (SELECT 1 FROM k{n} k WHERE {same}k.t = p.t))"""
        )
    kept = " UNION ALL ".join(f"SELECT ord, source, topic FROM k{n}" for n in range(8))
    return f"WITH {', '.join(ctes)} {kept}"


def _keyed(spark, d):
    return articles(spark, d).withColumns(
        {
            "url": F.when(F.col("ord") % 23 == 0, "").otherwise(F.col("url")),
            "title": F.when(F.col("ord") % 29 == 0, "  ").otherwise(F.col("title")),
        }
    )


@query("dedupe_greedy", _greedy_sql())
def dedupe_greedy(spark, d):
    return dd.dedupe_greedy(_keyed(spark, d), scope=[]).select("ord", "source", "topic")


@query("dedupe_greedy_scoped", _greedy_sql("topic"))
def dedupe_greedy_scoped(spark, d):
    return dd.dedupe_greedy(_keyed(spark, d), scope=["topic"]).select("ord", "source", "topic")


@query(
    "first_by_url",
    f"WITH {ART} SELECT ord, url, title FROM art QUALIFY row_number() OVER (PARTITION BY url ORDER BY ord) = 1",
)
def first_by_url(spark, d):
    return dd.first_by(articles(spark, d).select("ord", "url", "title"), ["url"], ["ord"])


@query(
    "latest_by_url",
    f"WITH {ART} SELECT url, min(ord) AS ord, max_by(title, ord) AS title, max_by(topic, ord) AS topic FROM art GROUP BY url",
)
def latest_by_url(spark, d):
    return dd.latest_by(articles(spark, d).select("ord", "url", "title", "topic"), "url", "ord")


@query(
    "skip_seen",
    f"""WITH {ART} SELECT ord, url, topic FROM art WHERE ord % 5 <> 0
    AND url || topic NOT IN (SELECT url || topic FROM art WHERE ord % 5 = 0)""",
)
def skip_seen(spark, d):
    art = articles(spark, d).select("ord", "url", "topic", F.concat("url", "topic").alias("key"))
    unseen = dd.skip_seen(art.filter("ord % 5 <> 0"), art.filter("ord % 5 = 0"), "key")
    return unseen.select("ord", "url", "topic")


APPEND = (
    ART
    + """, held AS (SELECT ord, url, topic, 'old' AS origin FROM art WHERE ord % 3 = 0),
  inc AS (SELECT ord, CASE WHEN ord % 23 = 0 THEN '' ELSE url END AS url, topic FROM art WHERE ord % 3 <> 0),
  fresh AS (SELECT ord, url, topic, CAST(NULL AS VARCHAR) AS origin FROM inc
    WHERE url <> '' AND (url, topic) NOT IN (SELECT (url, topic) FROM held)
    QUALIFY row_number() OVER (PARTITION BY url, topic ORDER BY ord) = 1
    UNION ALL SELECT ord, url, topic, NULL FROM inc WHERE url = '')"""
)


def period_halves(spark, d):
    """An existing period with an extra column, and an incoming batch."""
    art = articles(spark, d).select("ord", "url", "topic", "title", "news_date")
    held = art.filter("ord % 3 = 0").withColumn("origin", F.lit("old"))
    url = F.when(F.col("ord") % 23 == 0, " / ").otherwise(F.concat("url", F.lit("/")))
    return held, art.filter("ord % 3 <> 0").withColumn("url", url)


@query(
    "append_new_only",
    f"""WITH {APPEND} SELECT ord, url, topic, origin FROM held UNION ALL SELECT ord, url, topic, origin FROM fresh""",
)
def append_new_only(spark, d):
    held, incoming = period_halves(spark, d)
    out = dd.append_new_only(held, incoming)
    return out.select("ord", F.regexp_replace("url", "^ ?/ ?$|/$", "").alias("url"), "topic", "origin")


@query(
    "union_append",
    f"""WITH {ART} SELECT ord, CASE WHEN ord % 3 <> 0 AND ord % 23 = 0 THEN '' ELSE url END AS url,
      CASE WHEN ord % 3 = 0 THEN 'old' END AS origin FROM art""",
)
def union_append(spark, d):
    held, incoming = period_halves(spark, d)
    out = dd.union_append(held, incoming)
    return out.select("ord", F.regexp_replace("url", "^ ?/ ?$|/$", "").alias("url"), "origin")


@query(
    "union_sources",
    f"""WITH {ART} SELECT ord, source, topic, CASE topic WHEN 'en' THEN 10 WHEN 'de' THEN 20 WHEN 'fr' THEN 30 ELSE 40 END AS source_order
    FROM art""",
)
def union_sources(spark, d):
    art = articles(spark, d)
    frames = [
        (topic, 10 * (n + 1), art.filter(F.col("topic") == topic))
        for n, topic in enumerate(("en", "de", "fr", "es"))
    ]
    return dd.union_sources(frames).select("ord", "source", "topic", "source_order")


THRESHOLD = 0.4

_PAIRS = f"""pairs AS (SELECT a.label, a.vec_id AS l, b.vec_id AS r FROM embeddings a JOIN embeddings b
    ON a.label = b.label AND a.vec_id < b.vec_id
    WHERE list_cosine_similarity(a.embedding, b.embedding) >= {THRESHOLD})"""

_COMPONENTS = f"""RECURSIVE {_PAIRS},
  edges AS (SELECT l AS a, r AS b FROM pairs UNION SELECT r, l FROM pairs),
  reach(a, b) AS (SELECT a, a FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
  comp AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY a)"""


def _links(spark, d):
    return sm.similar_links(table(spark, d, "embeddings"), "vec_id", "embedding", "label", THRESHOLD)


@query(
    "similar_pairs",
    f"""WITH {_PAIRS} SELECT label, vec_id, true AS linked FROM embeddings
    WHERE vec_id IN (SELECT l FROM pairs UNION SELECT r FROM pairs)""",
)
def similar_pairs(spark, d):
    """Rows with a similar partner in their topic; the links hold the evidence."""
    links = _links(spark, d)
    ends = links.select("topic", F.explode(F.array("left", "right")).alias("vec_id")).distinct()
    return ends.select(F.col("topic").cast("int").alias("label"), "vec_id", F.lit(True).alias("linked"))


@query(
    "similar_pairs_cut",
    f"""WITH {_PAIRS} SELECT label, vec_id, true AS linked FROM embeddings
    WHERE vec_id IN (SELECT l FROM pairs UNION SELECT r FROM pairs)""",
)
def similar_pairs_cut(spark, d):
    """As ``similar_pairs``, with blocks so small that every topic is cut in rounds."""
    rows = table(spark, d, "embeddings")
    links = sm.similar_links(rows, "vec_id", "embedding", "label", THRESHOLD, block_rows=16, max_pivots=8)
    ends = links.select("topic", F.explode(F.array("left", "right")).alias("vec_id")).distinct()
    return ends.select(F.col("topic").cast("int").alias("label"), "vec_id", F.lit(True).alias("linked"))


@query("semantic_components", f"WITH {_COMPONENTS} SELECT id, component FROM comp")
def semantic_components(spark, d):
    return sm.components(_links(spark, d))


@query(
    "semantic_survivors",
    f"""WITH {_COMPONENTS}, ranked AS (SELECT id, row_number() OVER (PARTITION BY component
      ORDER BY CASE WHEN id % 5 = 0 THEN 0 ELSE (id * 37) % 100 END DESC, id) AS n FROM comp)
    SELECT vec_id, label FROM embeddings WHERE vec_id NOT IN (SELECT id FROM ranked WHERE n > 1)""",
)
def semantic_survivors(spark, d):
    score = F.when(F.col("vec_id") % 5 == 0, "n/a").otherwise((F.col("vec_id") * 37 % 100).cast("string"))
    rows = table(spark, d, "embeddings").withColumn("score", score)
    out = sm.semantic_survivors(rows, "vec_id", "embedding", "label", "score", THRESHOLD)
    return out.select("vec_id", "label")


def hashed_cosines(rows: str, size: int) -> str:
    """SQL CTEs ``counts`` and ``cosines(scope, l, r, cosine)`` of ``rows(id, scope, text)``."""
    return f"""words AS (SELECT id, scope, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+')) AS w
      FROM {rows}),
    counts AS (SELECT id, scope, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {size} AS slot, count(*) AS n
      FROM words WHERE w <> '' GROUP BY ALL),
    lengths AS (SELECT id, scope, sqrt(sum(n * n)) AS len FROM counts GROUP BY ALL),
    cosines AS (SELECT a.scope, a.id AS l, b.id AS r, sum(a.n * b.n) / any_value(x.len * y.len) AS cosine
      FROM counts a JOIN counts b ON a.scope = b.scope AND a.slot = b.slot AND a.id < b.id
      JOIN lengths x ON x.id = a.id AND x.scope = a.scope JOIN lengths y ON y.id = b.id AND y.scope = b.scope
      GROUP BY ALL)"""


@query(
    "embed_rows",
    f"""WITH docs AS (SELECT doc_id AS id, lang AS scope, coalesce(text, '') AS text FROM documents),
    {hashed_cosines("docs", 256)}, slots AS (SELECT id, count(*) AS n_slots, min(slot) FILTER (n = most) AS top_slot,
      max(n) / sqrt(sum(n * n)) AS top FROM (SELECT *, max(n) OVER (PARTITION BY id) AS most FROM counts) GROUP BY id)
    SELECT id AS doc_id, 256 AS size, n_slots IS NOT NULL AS is_unit, CAST(coalesce(n_slots, 0) AS INTEGER) AS n_slots,
      CAST(coalesce(top_slot, 0) AS INTEGER) AS top_slot FROM docs LEFT JOIN slots USING (id)""",
)
def embed_rows(spark, d):
    """Whole texts through a user function, 32 at a time."""
    docs = table(spark, d, "documents", heavy=True).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = sm.embed_rows(docs, "doc_id", "text", sm.hashed_encoder(256)).withColumn("top", F.array_max("vec"))
    return out.select(
        "doc_id",
        F.size("vec").alias("size"),
        (F.abs(norm(F.col("vec")) - 1) < 1e-5).alias("is_unit"),
        F.size(F.filter("vec", lambda x: x > 0)).alias("n_slots"),
        (F.array_position("vec", F.col("top")) - 1).cast("int").alias("top_slot"),
    )


@query(
    "embed_texts",
    f"""WITH RECURSIVE docs AS (SELECT doc_id AS id, lang AS scope, text FROM documents),
    {hashed_cosines("docs", 256)},
    links AS (SELECT l, r FROM cosines WHERE cosine >= 0.995),
    reach(id, other) AS (SELECT l, r FROM links UNION SELECT r, l FROM links
      UNION SELECT reach.id, CASE WHEN links.l = reach.other THEN links.r ELSE links.l END
      FROM reach JOIN links ON reach.other IN (links.l, links.r))
    SELECT id, least(id, min(other)) AS component FROM reach GROUP BY id""",
)
def embed_texts(spark, d):
    """Default embedder over whole texts, and the near copies it finds per language."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    vectors = sm.hashed_vectors(docs, "doc_id", "text")
    rows = docs.select("doc_id", "lang").join(vectors, "doc_id")
    groups = sm.components(sm.similar_links(rows, "doc_id", "vec", "lang", 0.995))
    return groups.select("id", "component")
