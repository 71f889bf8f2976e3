"""Shared helpers: tables of the work folder, distributed ranks, regex spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressmill.session import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with ``rank_`` (long, from 0, gapless) within ``groups`` by ``order``.

    One range exchange sorts by groups and order; the sorted rows are written to
    the shared folder with their place, so that a lost executor cannot change a
    place that another step has already used. Only one row per task and group is
    summed up further, so one group may hold any share of the rows. ``order`` should
    tell all rows apart that differ; equal rows are numbered in any order.
    """
    spark = df.sparkSession
    keys = [F.col(g) for g in groups]
    placed = written(
        df.repartitionByRange(parts_of(spark), *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("place_", F.monotonically_increasing_id())
        .withColumn("part_", F.shiftright("place_", 33).cast("int")),
        name,
    )
    runs = placed.groupBy("part_", *groups).agg(
        F.count("*").alias("rows_"), F.min("place_").alias("first_")
    )
    before = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("part_").rowsBetween(
        Window.unboundedPreceding, -1
    )
    runs = runs.select(
        F.col("part_").alias("run_part_"),
        *[F.col(g).alias(f"run_{g}_") for g in groups],
        (F.coalesce(F.sum("rows_").over(before), F.lit(0)) - F.col("first_")).alias("shift_"),
    )
    same = F.col("part_") == F.col("run_part_")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"run_{g}_"))
    return (
        placed.join(runs, same)
        .withColumn("rank_", F.col("place_") + F.col("shift_"))
        .drop("place_", "part_", "run_part_", "shift_", *[f"run_{g}_" for g in groups])
    )
