"""The daily runs: collect days, export from the cache, enrich the period, rank it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pressmill.functions.rules import RuleProfile
from pressmill.functions.text import strip, text_or_empty, url_key
from pressmill.operators import articles as ar
from pressmill.operators import periods as pr
from pressmill.operators import ranking as rk
from pressmill.operators import scoring as sc
from pressmill.operators import windows as wn
from pressmill.operators.dedupe import dedupe_greedy
from pressmill.operators.quality import Counters
from pressmill.operators.rules import profile_fanout
from pressmill.operators.similarity import DEFAULT_THRESHOLD, semantic_survivors
from pressmill.schema import SCORE_COLUMNS, SOURCES, TOPICS, Source, Topic
from pressmill.session import written
from pressmill.sources import day_cache as dc


def _by_source(sources: tuple[Source, ...], value: Callable[[Source], object], default) -> Column:
    out = F.lit(default)
    for source in sources:
        if value(source) != default:
            out = F.when(F.col("source") == source.id, F.lit(value(source))).otherwise(out)
    return out


def collect_run(
    raw: DataFrame,
    profiles: list[RuleProfile],
    table: str,
    days: int,
    refresh_days: int,
    today: Column,
) -> DataFrame:
    """Bring the day table up to date with raw articles; returns the run's counters.

    Only days of the window that are not held, or are among the last
    ``refresh_days``, are worked on: their articles are fanned out to the profiles,
    deduplicated per topic and stored as whole days. Days that fell out of the
    window go. ``raw`` has ``ord, source, day, url, title, text``. The counters are taken
    by the run's own writes.
    """
    spark = raw.sparkSession
    span = wn.day_range(raw.select("source").distinct(), days, today)
    held = spark.read.parquet(table).select("source", "day") if dc.folder_exists(spark, table) else None
    cached = span.select("source", "day").limit(0) if held is None else held.distinct()
    plan = written(wn.refresh_plan(span, cached, refresh_days).filter("process"), "plan").select("source", "day")
    counters = Counters()
    rows, one = F.count(F.lit(1)), "_first"
    work = counters.watch(raw.join(plan, ["source", "day"], "left_semi"), articles=rows)
    chosen = profile_fanout(work, profiles, one).withColumn("topic", F.col("profile")).drop("profile")
    chosen = written(counters.watch(chosen, selected=rows, matched=F.count_if(one)).drop(one), "chosen")
    no_title = F.count_if(strip(text_or_empty(F.col("title"))) == "")
    kept = written(counters.watch(dedupe_greedy(chosen, ["topic"]), kept=rows, without_title=no_title), "kept")
    topics = F.array(*[F.lit(p.name) for p in profiles])
    dc.upsert_days(kept, table, processed=plan.select("source", F.explode(topics).alias("topic"), "day"))
    dc.trim_days(spark, table, dc.DAY_PARTS, F.col("day") > F.date_sub(today, days))
    n = counters.figures()
    figures = {
        "n_articles": n["articles"],
        "n_filtered": n["articles"] - n["matched"],
        "n_duplicates": n["selected"] - n["kept"],
        "n_kept": n["kept"],
        "n_without_title": n["without_title"],
    }
    return spark.createDataFrame([tuple(figures.values())], ", ".join(f"{k} long" for k in figures))


def _window_articles(
    docs: DataFrame,
    source_ids: list[str] | None,
    topic_ids: list[str],
    days: int,
    today: Column,
    sources: tuple[Source, ...],
) -> DataFrame:
    """Articles of the window, settled: they are read once for the keys and once for the rows."""
    held = dc.scan_all(docs, source_ids, topic_ids)
    key_format = _by_source(sources, lambda s: s.key_format, "")
    held = held.filter(wn.in_source_window(F.col("day"), key_format, days, today))
    topic_at = F.array_position(F.array(*[F.lit(t) for t in topic_ids]), F.col("topic"))
    age = F.date_diff(today, F.try_to_date(F.translate("day", "/", "-"), "y-M-d"))
    place = F.struct(
        topic_at.alias("topic_at"),
        _by_source(sources, lambda s: s.order, 0).alias("source_order"),
        "source",
        age.alias("age"),
        "file",
        "line",
        "pos",
    )
    return written(ar.normalize_articles(held.withColumn("ord", place)), "items")


_UNIQUE_IN = ["topic", "source"]


def cached_articles(
    docs: DataFrame,
    source_ids: list[str] | None,
    topic_ids: list[str],
    days: int,
    today: Column,
    sources: tuple[Source, ...] = SOURCES,
) -> DataFrame:
    """Articles of the window, unique per topic and source, newest day first.

    ``ord`` is the place of a row in the output: topic, source, day, document,
    position.
    """
    return dedupe_greedy(_window_articles(docs, source_ids, topic_ids, days, today, sources), _UNIQUE_IN)


def export_run(
    docs: DataFrame,
    store: pr.PeriodStore,
    source_ids: list[str] | None,
    topic_ids: list[str],
    days: int,
    today: Column,
    sources: tuple[Source, ...] = SOURCES,
    topics: tuple[Topic, ...] = TOPICS,
) -> DataFrame:
    """Append the window's articles to the open period and return the period."""
    items = _window_articles(docs, source_ids, topic_ids, days, today, sources)
    unique = dedupe_greedy(items, _UNIQUE_IN)
    # The texts of the rows to append are read at the end: the choice needs the keys only.
    return store.append(ar.project_export(unique, sources, topics), rows=ar.project_export(items, sources, topics))


# Earlier appends come first, within one the place given by ``cached_articles``.
ROW_ORDER = [pr.BATCH_COLUMN, "ord"]


def row_key() -> Column:
    """A stable key of a period row, by which its score is kept."""
    parts = (url_key(F.col("url")), F.col("topic"), F.col("title"), F.col("news_date"))
    return F.sha2(F.to_json(F.array(*[F.coalesce(p, F.lit("")) for p in parts])), 256)


def _known_topics(topics: tuple[Topic, ...], only_topic: str | None) -> list[str]:
    if not only_topic or only_topic == "all":
        return [t.id for t in topics]
    return [ar.alias_table(topics).get(only_topic.strip(), only_topic.strip())]


Embedder = Callable[[DataFrame], DataFrame]


def enrich_run(
    store: pr.PeriodStore,
    score_table: str,
    scorer: sc.Scorer,
    prompt: Column,
    embed: Embedder | None = None,
    topics: tuple[Topic, ...] = TOPICS,
    only_topic: str | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    waves: int = 8,
) -> DataFrame:
    """Score what is not scored yet, drop semantic copies, reset all ranks.

    ``embed`` maps rows with ``row_id`` to ``(row_id, vec)``; without it no row
    is dropped. The period is replaced as a whole and returned.
    """
    rows = store.read_open().withColumn("row_key", row_key())
    rows = rows.drop(*SCORE_COLUMNS, *[c for c in ("row_id",) if c in rows.columns])
    sc.score_in_waves(
        rows, "row_key", score_table, scorer, prompt, waves=waves, topics=topics, only_topic=only_topic
    )
    held = sc.read_scores(rows.sparkSession, score_table, "row_key", rows)
    scored = rows.join(sc.current_scores(held, "row_key"), "row_key", "left").drop("row_key")
    # The ids are fixed by writing them; order is told by ``ROW_ORDER``.
    numbered = written(scored.withColumn("row_id", F.monotonically_increasing_id()), "scored")
    kept = numbered
    if embed is not None:
        chosen = _known_topics(topics, only_topic)
        everything = not only_topic or only_topic == "all"
        scope = F.when(F.lit(everything) | F.col("topic_id").isin(chosen), F.col("topic_id"))
        with_vectors = numbered.join(embed(numbered), "row_id", "left").withColumn("_scope", scope)
        kept = semantic_survivors(with_vectors, "row_id", "vec", "_scope", "score", threshold, ROW_ORDER)
        kept = kept.drop("vec", "_scope")
    return store.replace(rk.reset_ranking(kept))


# Takes (topic, candidates as JSON) and returns a ranking reply.
Ranker = Callable[[str, str], str]


def rank_run(
    rows: DataFrame,
    ranker: Ranker | None = None,
    top_n: int = rk.TOP_N,
    reserve_n: int = rk.RESERVE_N,
    topics: tuple[Topic, ...] = TOPICS,
    only_topic: str | None = None,
) -> DataFrame:
    """Rank the candidates of each topic of an enriched period.

    A ranker is called once per topic with at most 30 candidates. Without one
    the order is by score.
    """
    prepared = sc.prepare_ranking(rows, topics)
    known = _known_topics(topics, only_topic)
    ranked = prepared.filter(F.col("topic_id").isin(known))
    if ranker is None:
        best = rk.rank_top_reserve(ranked, "topic_id", ROW_ORDER, top_n, reserve_n)
        ranks = best.select("topic_id", "row_id", F.col("top_rank").alias("rank"))
    else:
        top = rk.candidate_topk(ranked, "topic_id", ROW_ORDER).withColumn("ord", F.col("row_id"))

        def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                replies = [ranker(t, p) for t, p in zip(frame["topic_id"], frame["payload"])]
                yield pd.DataFrame({"topic_id": frame["topic_id"], "reply": replies})

        asked = rk.candidate_payload(top, "topic_id").select("topic_id", "payload").mapInPandas(
            ask, "topic_id string, reply string"
        )
        ranks = rk.ranks_from_replies(asked, topic="topic_id")
    return rk.apply_ranking(prepared, ranks, "topic_id", "row_id", top_n, known)
