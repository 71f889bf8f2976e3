"""The whole run composed: select, dedupe, append, score, drop copies, rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressmill.functions.rules import RuleProfile
from pressmill.operators.dedupe import append_new_only, dedupe_greedy
from pressmill.operators.ranking import rank_top_reserve
from pressmill.operators.rules import profile_fanout
from pressmill.operators.similarity import hashed_vectors, semantic_survivors
from pressmill.plans.registry import query
from pressmill.plans.dedupe_queries import hashed_cosines
from pressmill.plans.standins import PACKS, VERDICTS, articles, sql_text
from pressmill.session import written


def curate(
    items: DataFrame,
    profiles: list[RuleProfile],
    existing: DataFrame | None = None,
    threshold: float = 0.995,
    top_n: int = 10,
    reserve_n: int = 5,
) -> DataFrame:
    """Top and reserve rows per profile for a batch of articles.

    The score here is the number of rules that hit; ``operators.scoring`` plugs
    in an external scorer between the same steps.
    """
    selected = profile_fanout(items, profiles).withColumn("topic", F.col("profile"))
    # Used by the rounds and by the final join: settled once, not recomputed.
    selected = written(selected, "selected")
    unique = dedupe_greedy(selected, scope=["topic", "source"])
    period = append_new_only(existing, unique)
    at = F.array_position(F.array(*[F.lit(p.name) for p in profiles]), F.col("topic"))
    row_id = F.col("ord") * len(profiles) + at - 1
    scored = period.withColumns({"score": F.least(F.col("n_hits") * 30, F.lit(100)), "row_id": row_id})
    scored = written(scored.withColumn("is_candidate", F.col("score") >= 30), "scored")
    vectors = hashed_vectors(scored, "row_id", "text", 64)
    kept = semantic_survivors(scored.join(vectors, "row_id", "left"), "row_id", "vec", "topic", "score", threshold)
    return rank_top_reserve(kept, "topic", "ord", top_n, reserve_n)


def _curate_sql() -> str:
    ctes = [
        VERDICTS
        + """, p0 AS (SELECT v.ord, v.profile AS topic, a.source, a.url, a.title, a.text,
      least(30 * (len(v.core) + len(v.secondary)), 100) AS score,
      array_to_string(list_transform(list_filter(list_concat(v.core, v.secondary),
        lambda h, i: list_position(list_concat(v.core, v.secondary), h) = i),
        lambda h: h.label || ': «' || h.fragment || '»'), '; ') AS matched_keyword,
      nullif(a.url, '') AS u, nullif(trim(a.title), '') AS t
      FROM verdicts v JOIN art a ON a.ord = v.ord WHERE v.kept)"""
    ]
    for n in range(8):
        ctes.append(
            f"""k{n} AS (SELECT * FROM p{n}
      QUALIFY (u IS NULL OR ord = min(ord) OVER (PARTITION BY topic, source, u))
        AND (t IS NULL OR ord = min(ord) OVER (PARTITION BY topic, source, t)))"""
        )
        same = "k.topic = p.topic AND k.source = p.source"
        ctes.append(
            f"""p{n + 1} AS (SELECT * FROM p{n} p
      WHERE NOT EXISTS (SELECT 1 FROM k{n} k WHERE {same} AND k.ord = p.ord)
      AND NOT EXISTS (SELECT 1 FROM k{n} k WHERE {same} AND k.u = p.u)
      AND NOT EXISTS (SELECT 1 FROM k{n} k WHERE {same} AND k.t = p.t))"""
        )
    kept = " UNION ALL ".join(f"SELECT * FROM k{n}" for n in range(8))
    names = ", ".join(sql_text(p.name) for p in PACKS)
    return f"""WITH RECURSIVE {', '.join(ctes)},
    kept AS (SELECT *, ord * {len(PACKS)} + list_position([{names}], topic) - 1 AS row_id FROM ({kept})),
    rows AS (SELECT row_id AS id, topic AS scope, text FROM kept),
    {hashed_cosines("rows", 64)},
    links AS (SELECT l, r FROM cosines WHERE cosine >= 0.995),
    reach(id, other) AS (SELECT l, r FROM links UNION SELECT r, l FROM links
      UNION SELECT reach.id, CASE WHEN links.l = reach.other THEN links.r ELSE links.l END
      FROM reach JOIN links ON reach.other IN (links.l, links.r)),
    beaten AS (SELECT DISTINCT a.row_id FROM reach JOIN kept a ON a.row_id = reach.id JOIN kept b ON b.row_id = reach.other
      WHERE (b.score, -b.row_id) > (a.score, -a.row_id)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, ord) AS pos FROM kept
      WHERE row_id NOT IN (SELECT row_id FROM beaten))
    SELECT topic, ord, url, title, CAST(score AS INTEGER) AS score, CAST(pos AS INTEGER) AS top_rank,
      pos <= 10 AS is_top, matched_keyword FROM ranked WHERE pos <= 15"""


@query("curate_run", _curate_sql())
def curate_run(spark: SparkSession, d: str) -> DataFrame:
    out = curate(articles(spark, d, heavy=True), list(PACKS))
    return out.select("topic", "ord", "url", "title", "score", "top_rank", "is_top", "matched_keyword")
