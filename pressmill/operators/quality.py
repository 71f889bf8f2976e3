"""Run counters and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from pressmill.functions.text import strip, text_or_empty
from pressmill.session import work_path


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Fail before any job runs when the frame lacks a column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")


def run_stats(rejects: DataFrame) -> DataFrame:
    """Failure rows per kind, with the number of distinct targets."""
    return rejects.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("target").alias("n_targets")
    )


class Counters:
    """Counts that a run's own writes take on the way, without a scan of their own.

    ``watch`` attaches an observation to a frame; its figures are there once the frame
    has been written. Watch what belongs to the writing stage itself, behind the last
    shuffle: a part made again after a lost executor is counted once there.
    """

    def __init__(self):
        self._watched: list[Observation] = []

    def watch(self, df: DataFrame, **counts: Column) -> DataFrame:
        seen = Observation()
        self._watched.append(seen)
        return df.observe(seen, *[c.alias(name) for name, c in counts.items()])

    def figures(self) -> dict[str, int]:
        return {name: n for seen in self._watched for name, n in seen.get.items()}


def split_rows(df: DataFrame, reason: Column, reasons: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept rows, rejected rows with their ``reason``, and ``(reason, n)``, in one pass.

    ``reason`` is null for a row to keep. All rows are written once, by outcome, and each
    side reads its own folder; the counts (``kept`` and each of ``reasons``, zeros
    included) are taken by that write.
    """
    spark, counters = df.sparkSession, Counters()
    tagged = df.withColumn("reason", reason)
    each = {f"n{i}": F.count_if(F.col("reason") == r) for i, r in enumerate(reasons)}
    tagged = counters.watch(tagged, kept=F.count_if(F.col("reason").isNull()), **each)
    path = work_path(spark, "outcomes")
    by_outcome = tagged.withColumn("outcome", F.when(F.col("reason").isNull(), "kept").otherwise("rejected"))
    by_outcome.write.partitionBy("outcome").parquet(path)
    written = spark.read.schema(by_outcome.schema).parquet(path)
    n = counters.figures()
    rows = [("kept", n["kept"]), *[(r, n[f"n{i}"]) for i, r in enumerate(reasons)]]
    kept, rejected = (written.filter(F.col("outcome") == o).drop("outcome") for o in ("kept", "rejected"))
    return kept.drop("reason"), rejected, spark.createDataFrame(rows, "reason string, n long")


def counts_by_source_topic(articles: DataFrame, sources: DataFrame, topics: DataFrame) -> DataFrame:
    """Articles per source and topic of the dimensions, zeros included.

    The grid is the result's own size: each source is unfolded over the set of all
    topics, one value of the plan. The article counts are aggregated before they meet it.
    """
    counted = articles.groupBy("source", "topic").agg(F.count(F.lit(1)).alias("n"))
    every = topics.agg(F.collect_set("topic")).scalar()
    grid = sources.select("source").distinct().select("source", F.explode(every).alias("topic"))
    return grid.join(counted, ["source", "topic"], "left").select(
        "source", "topic", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def top_count_by_topic(rows: DataFrame, topic: str = "topic") -> DataFrame:
    return rows.groupBy(topic).agg(F.count_if("is_top").alias("n_top"))


def distinct_topics(rows: DataFrame, topic: str = "topic") -> DataFrame:
    return rows.select(strip(text_or_empty(F.col(topic))).alias("topic")).filter("topic <> ''").distinct()
