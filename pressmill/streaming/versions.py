"""Late and edited rows with the newest version of each key held as state.

``late_refresh`` finds out what a micro-batch changes by reading the table. Here the state
of the stream knows it: per key the order value and the day of the newest version, with a
time to live. Each call for a state costs about the same, so the keys share ``BUCKETS``
states by hash, which are read and written once per batch. Only rows newer than that leave the operator, so a batch opens the days of
its changed rows and no other; neither the table nor its folders are listed again.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from pressmill.operators.dedupe import first_by
from pressmill.session import written
from pressmill.sources.day_cache import DAY_PARTS, drop_days, folder_exists, write_days

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: States that hold the keys; fixed for the life of a checkpoint.
BUCKETS = 1 << 14
_BUCKET = "_bucket"
#: Where the newest version of a row was before.
WAS = [f"was_{name}" for name in DAY_PARTS]


def _identity(value):
    """A key's value as a dictionary tells it apart, as grouping does."""
    if isinstance(value, float) and value != value:
        return "NaN", float
    return bytes(value) if isinstance(value, bytearray) else value


class _Newest(StatefulProcessor):
    """Lets a row pass if it is newer than every version of its key seen before."""

    def __init__(self, schema: StructType, key: list[str], order: str, ttl_ms: int):
        self.names, self.key, self.order, self.ttl_ms = schema.names, key, order, ttl_ms
        cells = [StructField(f"key_{n}", schema[name].dataType) for n, name in enumerate(key)]
        cells += [StructField("order", schema[order].dataType), *(schema[name] for name in DAY_PARTS)]
        cells.append(StructField("seen", LongType()))
        self.held = StructType([StructField("keys", ArrayType(StructType(cells)))])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("newest", self.held, self.ttl_ms)

    def _rank(self, value) -> tuple:
        return (value is not None, value) if value is not None else (False,)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n, best = len(self.key), {}
        for row in rows:
            own = tuple(_identity(row[name]) for name in self.key)
            place = (self._rank(row[self.order]), repr(row))
            if own not in best or best[own][0] < place:
                best[own] = (place, row)
        now = timerValues.getCurrentProcessingTimeInMs() if self.ttl_ms else 0
        found = self.state.get()
        held = {tuple(map(_identity, cell[:n])): tuple(cell) for cell in (found[0] if found else ())}
        if self.ttl_ms:
            held = {own: cell for own, cell in held.items() if cell[-1] + self.ttl_ms > now}
        passed = []
        for own, ((rank, _), row) in best.items():
            known = held.get(own)
            if known is not None and rank <= self._rank(known[n]):
                continue
            parts = tuple(row[name] for name in DAY_PARTS)
            held[own] = (*(row[name] for name in self.key), row[self.order], *parts, now)
            passed.append((row, (None,) * len(parts) if known is None else known[n + 1 : -1]))
        if passed:
            self.state.update((list(held.values()),))
        for row, was in passed:
            yield Row(**{name: row[name] for name in self.names}, **dict(zip(WAS, was)))

    def close(self) -> None:
        pass


def newest_versions(stream: DataFrame, key: list[str], order: str, keep_ms: int) -> DataFrame:
    """The rows newer than every version of their key before, with ``WAS``.

    Of the rows of a key in one micro-batch the newest counts; a null order is the oldest
    and equal orders are not newer. A key not seen for ``keep_ms`` is forgotten (0: never).
    """
    schema = stream.schema
    was = [StructField(new, schema[name].dataType) for new, name in zip(WAS, DAY_PARTS)]
    bucketed = stream.withColumn(_BUCKET, F.pmod(F.xxhash64(*key), F.lit(BUCKETS)))
    return bucketed.groupBy(_BUCKET).transformWithState(
        statefulProcessor=_Newest(schema, key, order, keep_ms),
        outputStructType=StructType([*schema.fields, *was]),
        outputMode="Update",
        timeMode="ProcessingTime" if keep_ms else "None",
    )


def refresh_changed(
    stream: DataFrame,
    table: str,
    key: list[str],
    order: str,
    checkpoint: str,
    refresh_days: int,
    keep_ms: int = 0,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep a day table current: a micro-batch reads and rewrites the days it changes.

    The rule is that of ``late_refresh``: days not held yet are written, days among the
    last ``refresh_days`` known are rewritten, older held days stay as they are. A row that
    moves to another day leaves its former one, if that is not closed. ``stream`` has
    ``source, topic, day``, none of them null. The names of a batch's days pass the driver;
    they are folder names. A replayed batch gives the same table.
    """
    spark = stream.sparkSession

    def sink(batch: DataFrame, batch_id: int) -> None:
        changed = written(batch, "changed")
        newest = _newest_day(changed, table, f"{checkpoint}/newest_day", batch_id)
        if newest is None:
            return
        now = changed.select(*DAY_PARTS)
        was = changed.select(*(F.col(w).alias(p) for w, p in zip(WAS, DAY_PARTS))).dropna()
        recent = F.col("day") > F.date_sub(F.lit(newest), refresh_days)
        touched = now.withColumn("now", F.lit(True)).unionByName(was.withColumn("now", F.lit(False)))
        touched = touched.groupBy(*DAY_PARTS).agg(F.max("now").alias("now"), F.max(recent).alias("recent"))
        opened, folders = [], []
        for day in touched.toLocalIterator():
            folder = _folder(batch.sparkSession, table, day)
            held = folder_exists(batch.sparkSession, folder)
            if (held and day.recent) or (not held and day.now):
                opened.append(tuple(day[p] for p in DAY_PARTS))
                folders += [folder] if held else []
        if not opened:
            return
        days = batch.sparkSession.createDataFrame(opened, changed.select(*DAY_PARTS).schema)
        rows = changed.select(*stream.columns)
        if folders:
            reader = batch.sparkSession.read.schema(stream.schema).option("basePath", table)
            old = reader.parquet(*folders).select(*stream.columns)
            rows = first_by(rows.unionByName(old), key, [F.desc(order)])
        done = written(rows.join(days, DAY_PARTS, "left_semi"), "days")
        drop_days(days.join(done.select(*DAY_PARTS).distinct(), DAY_PARTS, "left_anti"), table, DAY_PARTS)
        write_days(done, table)

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)  # the provider that keeps typed state
    try:
        versions = newest_versions(stream, key, order, keep_ms)
        writer = versions.writeStream.outputMode("update").foreachBatch(sink)
        writer = writer.option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        spark.conf.set(_PROVIDER, before)


def _folder(spark: SparkSession, table: str, day: Row) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join([table, *(f"{name}={escape(str(day[name]))}" for name in DAY_PARTS)])


def _newest_day(changed: DataFrame, table: str, notes: str, batch_id: int):
    """The newest day known after this batch, noted for the next one."""
    spark = changed.sparkSession
    known = changed.agg(F.max("day").alias("day"))
    if folder_exists(spark, f"{notes}/{batch_id - 1}"):
        known = known.unionByName(spark.read.parquet(f"{notes}/{batch_id - 1}"))
    elif folder_exists(spark, table):  # the first batch over a table that is there already
        known = known.unionByName(spark.read.schema(changed.schema).parquet(table).select("day"))
    newest = known.agg(F.max("day").alias("day"))
    newest.write.mode("overwrite").parquet(f"{notes}/{batch_id}")
    return spark.read.parquet(f"{notes}/{batch_id}").first()[0]
