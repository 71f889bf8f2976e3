"""Queries of scoring, ranking, counting and the digest."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressmill.operators import digest as dg
from pressmill.operators import quality as ql
from pressmill.operators import ranking as rk
from pressmill.operators import scoring as sc
from pressmill.plans.registry import query
from pressmill.plans.standins import ART, SCORED, TITLED, articles, scored, table
from pressmill.schema import Topic
from pressmill.session import work_path

ALL_TOPICS = TITLED + (Topic("es", "Spanish"),)


def _replies(spark, d):
    """events as raw model replies: plain, fenced, after reasoning, in prose, broken."""
    k = F.get_json_object("props", "$.k")
    body = F.concat(
        F.lit('{"score": '), k, F.lit(', "topic": "'), F.col("event_type"),
        F.lit('", "summary": "a \\"b\\" {c}", "reason": " r "}'),
    )
    kind = F.col("event_id") % 8
    flat = F.concat(F.lit('{"summary": "s'), k, F.lit('", "score": '), k, F.lit("}"))
    reply = (
        F.when(kind == 0, body)
        .when(kind == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(kind == 2, F.concat(F.lit("so {x} </think> hm </think>\n"), body))
        .when(kind == 3, F.concat(F.lit("Here it is: "), body, F.lit(" done {z}")))
        .when(kind == 4, F.concat(F.lit("{broken] "), flat, F.lit(" and {also")))
        .when(kind == 5, F.concat(F.lit('{"summary": "say "x" now", "score": '), k, F.lit(', "reason": }')))
        .when(kind == 6, F.lit("no object at all"))
        .otherwise(F.concat(F.lit('{oops {"summary": "only", "is_candidate": true} '), k))
    )
    return table(spark, d, "events", heavy=True).select("event_id", reply.alias("reply"))


@query(
    "parse_model_json",
    """WITH e AS (SELECT event_id, event_id % 8 AS kind, event_type, CAST(props ->> 'k' AS INTEGER) AS k FROM events)
    SELECT event_id,
      CASE WHEN kind <= 2 THEN 'object' WHEN kind = 3 THEN 'embedded' WHEN kind = 4 THEN 'summary_score'
        WHEN kind = 5 THEN 'pulled' WHEN kind = 6 THEN 'none' ELSE 'summary' END AS found_by,
      CASE WHEN kind <= 5 THEN least(100, k) ELSE 0 END AS score,
      CASE WHEN kind <= 5 THEN least(100, k) >= 60 ELSE kind = 7 END AS is_candidate,
      CASE WHEN kind <= 3 THEN event_type ELSE 'not_relevant' END AS subject,
      CASE WHEN kind <= 3 THEN 'a "b" {c}' WHEN kind = 4 THEN 's' || k WHEN kind = 5 THEN 'say "x" now'
        WHEN kind = 6 THEN '' ELSE 'only' END AS summary,
      CASE WHEN kind <= 3 THEN 'r' ELSE '' END AS reason FROM e""",
)
def parse_model_json(spark, d):
    return sc.parse_replies(_replies(spark, d)).drop("reply")


def _keyword_scorer(prompts):
    """Stands in for a model: scores by how often "the" and "der" occur."""
    out = []
    for text in prompts:
        hits = text.count("the") + text.count("der")
        if hits == 13:
            out.append(RuntimeError("503"))
        else:
            out.append(f'{{"score": {hits}, "topic": "t{hits % 3}", "summary": "n{hits}", "reason": "count"}}')
    return out


_COUNT = "(length(text) - length(replace(text, 'the', ''))) // 3 + (length(text) - length(replace(text, 'der', ''))) // 3"


@query(
    "score_rows",
    f"""WITH {ART}, n AS (SELECT ord, topic, {_COUNT} AS n FROM art)
    SELECT ord, topic AS topic_id,
      CAST(CASE WHEN topic = 'fr' OR n = 13 THEN 0 ELSE least(100, n) END AS INTEGER) AS score,
      CASE WHEN topic = 'fr' OR n = 13 THEN false ELSE least(100, n) >= 60 END AS is_candidate,
      CASE WHEN topic = 'fr' OR n = 13 THEN 'not_relevant' ELSE 't' || (n % 3) END AS subject,
      CASE WHEN topic <> 'fr' AND n <> 13 THEN 'n' || n END AS summary,
      CASE WHEN topic = 'fr' THEN 'Не найден профиль ранжирования для ЦК: fr'
        WHEN n = 13 THEN 'Ошибка LLM scoring: 503' ELSE 'count' END AS reason
    FROM n""",
)
def score_rows(spark, d):
    """Three topics are scored, French has no profile."""
    rows = articles(spark, d)
    path = work_path(spark, "scores")
    topics = (Topic("en", "English"), Topic("de", "German"), Topic("es", "Spanish"))
    sc.score_in_waves(rows, "ord", path, _keyword_scorer, F.col("text"), waves=2, topics=topics)
    # A second run finds only the failed rows to do again.
    sc.score_in_waves(rows, "ord", path, _keyword_scorer, F.col("text"), waves=1, topics=topics)
    return sc.current_scores(sc.read_scores(spark, path, "ord", rows), "ord")


@query(
    "resume_unscored",
    f"""WITH {ART} SELECT ord, topic FROM art WHERE ord NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)""",
)
def resume_unscored(spark, d):
    scores = table(spark, d, "labels").select(
        F.col("doc_id").alias("ord"),
        F.lit("en").alias("topic_id"),
        F.when(F.col("toxic") == 1, sc.ERROR_PREFIX + " 503").otherwise("fine").alias("reason"),
    )
    return sc.resume_unscored(articles(spark, d), scores, "ord").select("ord", "topic")


@query(
    "prepare_ranking",
    f"""WITH {SCORED} SELECT ord, topic AS topic_id,
      topic <> 'es' AND CASE WHEN ord % 4 = 0 THEN true WHEN ord % 4 = 1 THEN false ELSE coalesce(score, 0) >= 60 END AS is_candidate
    FROM scored""",
)
def prepare_ranking(spark, d):
    flag = F.when(F.col("ord") % 4 == 0, "Yes").when(F.col("ord") % 4 == 1, "0").when(F.col("ord") % 4 == 2, "nan")
    rows = scored(spark, d).withColumn("is_candidate", flag)
    return sc.prepare_ranking(rows, TITLED).select("ord", "topic_id", "is_candidate")


def candidates(spark, d):
    return scored(spark, d).withColumn("is_candidate", F.col("score") >= 40).withColumns(
        {"subject": F.lit("s"), "summary": F.col("title"), "reason": F.lit("r")}
    )


_TOP = (
    SCORED
    + """, top AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, ord) AS pos
    FROM scored WHERE score >= 40)"""
)


@query(
    "candidate_topk",
    f"WITH {_TOP} SELECT topic, CAST(pos AS INTEGER) AS pos, ord, CAST(score AS INTEGER) AS score FROM top WHERE pos <= 30",
)
def candidate_topk(spark, d):
    return rk.candidate_topk(candidates(spark, d)).select("topic", "pos", "ord", F.col("score").cast("int").alias("score"))


@query(
    "candidate_payload",
    f"""WITH {_TOP} SELECT topic, pos, ord AS row_id, title, CAST(score AS INTEGER) AS score, CAST(news_date AS VARCHAR) AS date,
      CAST(least(30, count(*) OVER (PARTITION BY topic)) AS BIGINT) AS n FROM top QUALIFY pos <= 30""",
)
def candidate_payload(spark, d):
    payload = rk.candidate_payload(rk.candidate_topk(candidates(spark, d)))
    items = F.from_json("payload", "array<struct<row_id:bigint,title:string,score:int,date:string>>")
    out = payload.select("topic", "n", F.posexplode(items).alias("p", "x"))
    return out.select("topic", (F.col("p") + 1).cast("long").alias("pos"), "x.*", "n")


@query(
    "rank_top_reserve",
    f"WITH {_TOP} SELECT topic, ord, CAST(pos AS INTEGER) AS top_rank, pos <= 10 AS is_top FROM top WHERE pos <= 15",
)
def rank_top_reserve(spark, d):
    return rk.rank_top_reserve(candidates(spark, d)).select("topic", "ord", "top_rank", "is_top")


_RANKED = (
    _TOP
    + """, given AS (SELECT topic, ord, pos, 31 - pos AS rank FROM top WHERE pos <= 30 AND pos % 7 <> 0)"""
)


@query(
    "apply_ranking",
    f"""WITH {_RANKED} SELECT a.ord, a.topic, CAST(g.rank AS INTEGER) AS top_rank, coalesce(g.rank <= 10, false) AS is_top
    FROM art a LEFT JOIN given g ON a.ord = g.ord AND a.topic = g.topic""",
)
def apply_ranking(spark, d):
    """Ranks from replies that mention rows twice, unknown ids and bad ranks."""
    top = rk.candidate_topk(candidates(spark, d))
    rank = F.when(F.col("pos") % 7 == 0, F.lit('"x"')).otherwise((31 - F.col("pos")).cast("string"))
    item = F.concat(F.lit('{"row_id": '), F.col("ord").cast("string"), F.lit(', "rank": '), rank, F.lit("}"))
    early = F.concat(F.lit('{"row_id": '), F.col("ord").cast("string"), F.lit(', "rank": 99}'))
    listed = F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("pos") % 7 == 0, item).otherwise(F.concat_ws(",", early, item)).alias("x"))))
    body = F.concat(
        F.lit('{"ranked_top15": ['), F.array_join(F.transform(listed, lambda r: r["x"]), ","),
        F.lit(', {"row_id": -5, "rank": 1}, {"rank": 2}]}'),
    )
    replies = top.groupBy("topic").agg(body.alias("reply"))
    rows = articles(spark, d).withColumns({"top_rank": F.lit(3), "is_top": F.lit(True)})
    out = rk.apply_ranking(rows, rk.ranks_from_replies(replies))
    return out.select("ord", "topic", "top_rank", "is_top")


@query("reset_ranking", f"WITH {ART} SELECT topic, count(*) AS n, 0 AS n_top FROM art GROUP BY topic")
def reset_ranking(spark, d):
    rows = rk.reset_ranking(articles(spark, d).withColumn("is_top", F.lit(True)))
    return rows.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_top") | F.col("top_rank").isNotNull()).cast("int").alias("n_top")
    )


@query(
    "top_count_by_topic",
    f"WITH {_RANKED} SELECT a.topic, count(*) FILTER (g.rank <= 10) AS n_top FROM art a LEFT JOIN given g ON a.ord = g.ord GROUP BY a.topic",
)
def top_count_by_topic(spark, d):
    return ql.top_count_by_topic(apply_ranking(spark, d))


@query(
    "global_topk",
    """SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) END AS score,
      o_orderstatus, CAST(NULL AS VARCHAR) AS url FROM orders
    ORDER BY CASE WHEN o_orderkey % 10 <> 0 THEN round(o_totalprice * 100) END DESC NULLS LAST, o_orderkey LIMIT 10""",
)
def global_topk(spark, d):
    cents = F.round(F.col("o_totalprice") * 100).cast("long").cast("string")
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("ord"),
        F.when(F.col("o_orderkey") % 10 == 0, "n/a").otherwise(cents).alias("score"),
        "o_orderstatus",
    )
    return rk.global_topk(rows, 10, ["ord", "score", "o_orderstatus", "url"])


@query(
    "counts_by_source_topic",
    f"""WITH {ART}, grid AS (SELECT s.source, t.topic FROM (SELECT DISTINCT source FROM art) s, (VALUES ('en'), ('de'), ('fr'), ('es'), ('it')) t(topic))
    SELECT source, topic, count(ord) AS n FROM grid LEFT JOIN art USING (source, topic) GROUP BY ALL""",
)
def counts_by_source_topic(spark, d):
    art = articles(spark, d).select("source", "topic")
    topics = spark.createDataFrame([(t,) for t in ("en", "de", "fr", "es", "it")], "topic string")
    return ql.counts_by_source_topic(art, art, topics)


@query(
    "distinct_topics",
    "SELECT DISTINCT trim(event_type) AS topic FROM events WHERE event_type <> 'view'",
)
def distinct_topics(spark, d):
    name = F.when(F.col("event_type") == "view", "  ").otherwise(F.concat(F.lit(" "), "event_type", F.lit("\t")))
    return ql.distinct_topics(table(spark, d, "events").select(name.alias("topic")))


_PEOPLE = """people AS (SELECT c_custkey AS ord,
    CASE WHEN c_custkey % 9 = 0 THEN 'bad address' ELSE 'c' || (c_custkey % 700) || '@mail.example' END AS mail,
    [n_name, 'all', c_mktsegment] AS ts FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _recipients(spark, d):
    people = table(spark, d, "customer").join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey")
    mail = F.when(key % 9 == 0, "bad address").otherwise(
        F.concat(F.lit(" c"), (key % 700).cast("string"), F.lit("@mail.example"))
    )
    rows = people.select(
        key.alias("ord"), mail.alias("mail"), F.concat_ws(" , ", "n_name", F.lit("all"), F.lit(""), "c_mktsegment").alias("topics")
    )
    return dg.recipients_by_topic(rows, "mail", "topics", "ord")


@query(
    "recipients_by_topic",
    f"WITH {_PEOPLE} SELECT topic, mail, min(ord) AS first_ord FROM (SELECT ord, mail, unnest(ts) AS topic FROM people) WHERE mail LIKE '%@%' GROUP BY ALL",
)
def recipients_by_topic(spark, d):
    return _recipients(spark, d)


def _digest_rows(spark, d):
    return scored(spark, d).select(
        "ord",
        F.concat(F.lit(" "), "topic").alias("topic"),
        F.concat(F.lit("https://www."), "source", F.lit(".example/"), "url").alias("url"),
        F.when(F.col("ord") % 6 != 0, F.col("source")).alias("source"),
        F.when(F.col("ord") % 4 != 0, F.col("title")).alias("title"),
        F.when(F.col("ord") % 3 == 0, "short").alias("summary"),
        F.when(F.col("ord") % 5 != 0, F.date_format("news_date", "dd.MM.yyyy")).alias("news_date"),
        "score",
    )


@query(
    "topic_digest",
    f"""WITH {SCORED}, r AS (SELECT *, count(*) OVER (PARTITION BY topic) AS total,
      row_number() OVER (PARTITION BY topic ORDER BY score DESC NULLS LAST, ord) AS pos FROM scored)
    SELECT topic, total, CAST(pos AS INTEGER) AS pos, ord, CASE WHEN ord % 4 <> 0 AND title <> '' THEN title ELSE 'Без заголовка' END AS title,
      'https://www.' || source || '.example/' || url AS url, CASE WHEN ord % 3 = 0 THEN 'short' ELSE '—' END AS summary,
      CASE WHEN ord % 5 <> 0 THEN source || '.example • ' || strftime(news_date, '%d.%m.%Y')
        WHEN ord % 6 <> 0 THEN source ELSE 'unknown' END AS meta FROM r WHERE pos <= 10""",
)
def topic_digest(spark, d):
    return dg.topic_digest(_digest_rows(spark, d))


@query(
    "digest_mailings",
    f"""WITH {ART}, {_PEOPLE} SELECT topic, count(*) AS total,
      (SELECT count(DISTINCT mail) FROM people WHERE mail LIKE '%@%') AS n_mails FROM (SELECT CASE WHEN topic IN ('en', 'de') THEN 'all' ELSE topic END AS topic FROM art)
    WHERE topic = 'all' GROUP BY topic""",
)
def digest_mailings(spark, d):
    """Spanish and French have no recipients, so only one digest goes out."""
    topic = F.when(F.col("topic").isin("en", "de"), "all").otherwise(F.col("topic"))
    rows = scored(spark, d).withColumns({"topic": topic, "summary": F.col("title")})
    return dg.digest_mailings(dg.topic_digest(rows), _recipients(spark, d))


@query(
    "require_columns",
    "SELECT event_type, count(*) AS n, CAST(NULL AS VARCHAR) AS missing FROM events WHERE event_type = 'view' GROUP BY event_type"
    " UNION ALL SELECT event_type, count(*), 'missing columns: score' FROM events WHERE event_type <> 'view' GROUP BY event_type",
)
def require_columns(spark, d):
    """The gate on two frames, one with and one without the score column."""
    events = table(spark, d, "events")
    frames = (
        events.filter("event_type = 'view'").withColumn("score", F.col("value")),
        events.filter("event_type <> 'view'"),
    )
    out = None
    for frame in frames:
        try:
            ql.require_columns(frame, ["score"])
            missing = F.lit(None).cast("string")
        except ql.MissingColumns as refused:
            missing = F.lit(str(refused))
        part = frame.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("missing", missing)
        out = part if out is None else out.unionByName(part)
    return out
