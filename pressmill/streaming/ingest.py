"""Incremental runs: the daily run as a stream over landed files.

All jobs take an ``available_now`` trigger, which serves the daily cron run, or
run continuously. State is bounded by watermarks; sinks are idempotent per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pressmill.operators.dedupe import first_by
from pressmill.operators.periods import PeriodStore
from pressmill.session import written
from pressmill.sources.day_cache import folder_exists, write_days


def landed(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A stream over Parquet files as they land."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ingest_append(
    stream: DataFrame,
    store: PeriodStore,
    checkpoint: str,
    available_now: bool = True,
    name: str = "stream",
    **keys,
) -> StreamingQuery:
    """Append the unseen rows of each micro-batch to the open period.

    The batch is named by the stream and the batch id, so a replayed batch replaces
    itself and no other writer's.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        store.append(batch, batch=batch_id, writer=name, **keys)

    return _start(stream.writeStream.foreachBatch(sink), checkpoint, available_now)


def _timed(stream: DataFrame, time: str, late: str) -> DataFrame:
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def dedupe_stream(stream: DataFrame, keys: list[str], time: str, keep_for: str) -> DataFrame:
    """First arrival per key; keys are forgotten ``keep_for`` after the watermark."""
    return _timed(stream, time, keep_for).dropDuplicatesWithinWatermark(keys)


def to_table(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    return _start(
        stream.writeStream.format("parquet").option("path", path).outputMode("append"),
        checkpoint,
        available_now,
    )


def late_refresh(
    stream: DataFrame,
    table: str,
    key: list[str],
    order: str,
    checkpoint: str,
    refresh_days: int,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep a day table current while late or edited rows arrive.

    A micro-batch rewrites only the days it touches: days not held yet, and days
    among the last ``refresh_days`` known. Rows for older held days are ignored,
    as a closed day is. The newest version of a row wins. ``stream`` has
    ``source, topic, day`` and ``key``.
    """
    part = ["source", "topic", "day"]

    def sink(batch: DataFrame, batch_id: int) -> None:
        held = _read_days(batch.sparkSession, table, batch.schema)
        fresh = batch
        if held is not None:
            # Partition values only; no data columns are read.
            days = held.select(*part).distinct().withColumn("held", F.lit(True))
            newest = batch.select("day").unionByName(held.select("day")).agg(F.max("day")).first()[0]
            marked = batch.join(days, part, "left")
            recent = F.col("day") > F.date_sub(F.lit(newest), refresh_days)
            fresh = marked.filter(F.col("held").isNull() | recent).drop("held")
            touched = held.join(fresh.select(*part).distinct(), part, "left_semi")
            fresh = fresh.select(*batch.columns).unionByName(touched.select(*batch.columns))
        # The table is read and rewritten, so the new days are settled first.
        write_days(written(first_by(fresh, key, [F.desc(order)]), "days"), table)

    return _start(stream.writeStream.foreachBatch(sink), checkpoint, available_now)


def _read_days(spark: SparkSession, table: str, schema: StructType) -> DataFrame | None:
    return spark.read.schema(schema).parquet(table) if folder_exists(spark, table) else None


def daily_counts(stream: DataFrame, time: str, by: list[str], late: str = "2 days") -> DataFrame:
    """Rows per day and ``by``, closed once the watermark has passed the day."""
    return (
        _timed(stream, time, late)
        .groupBy(F.window(time, "1 day").alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.to_date("w.start").alias("day"), *by, "n")
    )
