"""Resumable scoring with a pluggable scorer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pressmill.functions import replies as rp
from pressmill.functions.text import strip, text_or_empty
from pressmill.operators.articles import normalize_topic
from pressmill.operators.quality import require_columns
from pressmill.schema import TOPICS, Topic
from pressmill.session import work_path
from pressmill.sources.day_cache import folder_exists

# The reasons written for rows that could not be scored.
ERROR_PREFIX = "Ошибка LLM scoring:"
UNKNOWN_TOPIC = "Не найден профиль ранжирования для ЦК: "

SCORES = (
    "topic_id string, score int, is_candidate boolean, subject string, summary string, reason string"
)

# Takes prompts and returns one reply (or an exception) per prompt.
Scorer = Callable[[list[str]], list]


def is_scored(topic_id: Column, reason: Column) -> Column:
    """A row is done when it has a topic id and no error reason."""
    failed = strip(text_or_empty(reason)).startswith(ERROR_PREFIX)
    value = strip(text_or_empty(topic_id))
    return ~failed & (value != "") & ~F.lower(value).isin("nan", "none")


def resume_unscored(rows: DataFrame, scores: DataFrame | None, id_col: str) -> DataFrame:
    """Rows that still need a score: none held yet, or only error rows."""
    if scores is None:
        return rows
    done = scores.filter(is_scored(F.col("topic_id"), F.col("reason"))).select(id_col)
    return rows.join(done, id_col, "left_anti")


def parse_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Adds ``found_by`` and the five score columns to rows with a raw reply."""
    cleaned = replies.withColumn("_clean", rp.reply_text(F.col(reply)))
    parsed = cleaned.withColumn("_parsed", rp.parse_reply(F.col("_clean")))
    fields = F.col("_parsed.fields")
    return parsed.select(
        *replies.columns,
        F.col("_parsed.found_by").alias("found_by"),
        *[col.alias(name) for name, col in rp.score_columns(fields).items()],
    )


def _known(topic_id: Column, topics: tuple[Topic, ...]) -> Column:
    return topic_id.isin([t.id for t in topics])


def _replies(scorer: Scorer, prompts: list[str]) -> list:
    """One reply or exception per prompt."""
    try:
        got = list(scorer(prompts))
        if len(got) == len(prompts):
            return got
        error = ValueError(f"{len(prompts)} prompts gave {len(got)} replies")
    except Exception as failure:  # the scorer is the caller's
        error = failure
    if len(prompts) == 1:
        return [error]
    return [reply for prompt in prompts for reply in _replies(scorer, [prompt])]


def score_rows(
    rows: DataFrame,
    id_col: str,
    scorer: Scorer,
    prompt: Column,
    topics: tuple[Topic, ...] = TOPICS,
    only_topic: str | None = None,
    batch: int = 64,
) -> DataFrame:
    """``(id, topic_id, score, ...)`` for rows with a ``topic`` column.

    The scorer gets batches of prompts; a batch that fails is tried again row by
    row, so that one prompt fails alone. A reply that is an exception, or that
    holds no JSON object, becomes an error row with score 0. Rows of an unknown
    topic get score 0 without a call; rows of other topics than ``only_topic``
    are left out.
    """
    id_type = rows.schema[id_col].dataType.simpleString()
    base = rows.select(
        id_col, "topic", normalize_topic(F.col("topic"), topics).alias("topic_id"), prompt.alias("prompt")
    )
    known = _known(F.col("topic_id"), topics)
    wanted = base.filter(known)
    if only_topic and only_topic != "all":
        wanted = wanted.filter(normalize_topic(F.lit(only_topic), topics) == F.col("topic_id"))

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                got = _replies(scorer, part["prompt"].tolist())
                failed = [isinstance(g, Exception) for g in got]
                yield pd.DataFrame(
                    {
                        id_col: part[id_col],
                        "topic_id": part["topic_id"],
                        "reply": [None if bad else g for g, bad in zip(got, failed)],
                        "error": [str(g) if bad else None for g, bad in zip(got, failed)],
                    }
                )

    called = wanted.select(id_col, "topic_id", "prompt").mapInPandas(
        call, f"{id_col} {id_type}, topic_id string, reply string, error string"
    )
    parsed = parse_replies(called)
    bad = F.coalesce(
        F.col("error"), F.when(F.col("found_by") == "none", F.lit("no JSON object in the reply"))
    )
    scored = parsed.withColumn("_bad", bad).select(
        id_col,
        "topic_id",
        F.when(F.col("_bad").isNull(), F.col("score")).otherwise(0).alias("score"),
        (F.col("_bad").isNull() & F.col("is_candidate")).alias("is_candidate"),
        F.when(F.col("_bad").isNull(), F.col("subject")).otherwise(rp.DEFAULT_SUBJECT).alias("subject"),
        F.when(F.col("_bad").isNull(), F.col("summary")).alias("summary"),
        F.when(F.col("_bad").isNull(), F.col("reason"))
        .otherwise(F.concat(F.lit(ERROR_PREFIX + " "), F.col("_bad")))
        .alias("reason"),
    )
    unknown = base.filter(~known).select(
        id_col,
        "topic_id",
        F.lit(0).alias("score"),
        F.lit(False).alias("is_candidate"),
        F.lit(rp.DEFAULT_SUBJECT).alias("subject"),
        F.lit(None).cast("string").alias("summary"),
        F.concat(F.lit(UNKNOWN_TOPIC), text_or_empty(F.col("topic"))).alias("reason"),
    )
    return scored.unionByName(unknown)


def score_in_waves(
    rows: DataFrame,
    id_col: str,
    table: str,
    scorer: Scorer,
    prompt: Column,
    waves: int = 8,
    **how,
) -> None:
    """Append the scores of all pending rows to ``table``, one wave at a time.

    A wave is committed as a whole, so a run that breaks off loses at most one.
    The next run scores what is still missing or failed.
    """
    spark = rows.sparkSession
    pending = resume_unscored(rows, read_scores(spark, table, id_col, rows), id_col)
    staged = pending.select(
        id_col, "topic", prompt.alias("_prompt"), F.pmod(F.xxhash64(id_col), F.lit(waves)).alias("_wave")
    )
    # The input is scanned once; a wave reads its own partition.
    path = work_path(spark, "waves")
    staged.write.partitionBy("_wave").parquet(path)
    schema = f"{staged.drop('_wave').schema.simpleString()[7:-1].replace(':', ' ')}, _wave bigint"
    for wave in range(waves):
        share = spark.read.schema(schema).parquet(path).filter(F.col("_wave") == wave)
        scored = score_rows(share, id_col, scorer, F.col("_prompt"), **how)
        scored.write.mode("append").parquet(table)


def read_scores(spark, table: str, id_col: str, rows: DataFrame) -> DataFrame | None:
    """The score table, or None before the first wave."""
    if not folder_exists(spark, table):
        return None
    id_type = rows.schema[id_col].dataType.simpleString()
    return spark.read.schema(f"{id_col} {id_type}, {SCORES}").parquet(table)


def current_scores(scores: DataFrame, id_col: str) -> DataFrame:
    """One row per id: the successful score if there is one, else an error row."""
    done = is_scored(F.col("topic_id"), F.col("reason"))
    rest = [c for c in scores.columns if c != id_col]
    return (
        scores.groupBy(id_col)
        .agg(F.max_by(F.struct(*rest), done).alias("s"))
        .select(id_col, "s.*")
    )


def prepare_ranking(
    df: DataFrame, topics: tuple[Topic, ...] = TOPICS
) -> DataFrame:
    """Rebuild ``topic_id`` and ``is_candidate`` before ranking.

    A flag that is present is kept; without one a score of 60 or more makes a
    candidate. Rows of an unknown topic are never candidates.
    """
    require_columns(df, ["score"])
    flag = F.col("is_candidate").cast("string") if "is_candidate" in df.columns else F.lit(None).cast("string")
    given = strip(text_or_empty(flag))
    topic_id = normalize_topic(F.col("topic"), topics)
    candidate = F.when(
        ~given.isin("", "nan", "none", "None"), rp.as_bool(given)
    ).otherwise(rp.clean_score(F.col("score")) >= rp.CANDIDATE_SCORE)
    return df.withColumns(
        {"topic_id": topic_id, "is_candidate": _known(topic_id, topics) & candidate}
    )
