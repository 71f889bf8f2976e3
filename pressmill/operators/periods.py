"""The open reporting period: bounds, writing, export and closing."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressmill.functions.dates import parse_news_date
from pressmill.operators.dedupe import unseen_rows
from pressmill.operators.key_index import KeyIndex, hashed
from pressmill.session import written

PERIOD_COLUMN = "period_id"
# The append a row came with; rows of later appends stand behind it.
BATCH_COLUMN = "period_batch"


def period_bounds(rows: DataFrame, news_date: Column, run_date: str, period_start: str | None = None) -> DataFrame:
    """``(date_from, date_to)``: start of the open period to the latest news date.

    Without a readable date the run date stands in; the end is never before the
    start.
    """
    start = F.to_date(F.lit(period_start or run_date))
    latest = rows.agg(F.max(parse_news_date(news_date)).alias("latest"))
    end = F.coalesce("latest", F.to_date(F.lit(run_date)))
    return latest.select(start.alias("date_from"), F.greatest(end, start).alias("date_to"))


def news_span(rows: DataFrame, news_date: Column) -> DataFrame:
    """``(date_from, date_to)`` of the readable dates, null when there are none."""
    day = parse_news_date(news_date)
    return rows.agg(F.min(day).alias("date_from"), F.max(day).alias("date_to"))


def period_line(date_from: Column, date_to: Column) -> Column:
    """Fixed wording of the report's period line."""
    head = F.lit("Результат отработки парсера")
    span = F.concat(
        head, F.lit(" с "), F.date_format(date_from, "dd.MM.yyyy"), F.lit(" по "), F.date_format(date_to, "dd.MM.yyyy"), F.lit(".")
    )
    return F.coalesce(span, F.concat(head, F.lit(".")))


def period_name(date_from: Column, date_to: Column) -> Column:
    return F.concat_ws("_", F.lit("news"), date_from.cast("string"), date_to.cast("string"))


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names of the committed folders below ``path``."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    found = []
    for status in fs.listStatus(top):
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if status.isDirectory() and fs.exists(marker):
            found.append(status.getPath().getName())
    return sorted(found)


class PeriodStore:
    """The open period and the closed ones as append-only Parquet batches.

    ``rows/<folder>/b<number>.<writer>.<id>`` holds one committed batch; a folder
    without its commit marker is not read, so a batch is there in full or not at
    all. A writer that repeats a batch id replaces that batch of its own, never
    another writer's. ``closed/g<generation>`` names the period a generation
    became and the folder of the next one: that marker alone decides which folder
    is open, so rows written before a break are never taken up by accident.
    ``derived/<folder>`` holds what is made from each batch and can be made again: its
    keys (``key_index``) and partial counts (``batch_counts``).
    Closing copies no rows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _closed(self) -> list[int]:
        return sorted(int(n[1:]) for n in _children(self.spark, f"{self.root}/closed"))

    def generation(self) -> int:
        return (self._closed() or [-1])[-1] + 1

    def _open_folder(self) -> str:
        closed = self._closed()
        if not closed:
            return "g000000"
        return self.spark.read.parquet(f"{self.root}/closed/g{closed[-1]:06d}").first()["next"]

    def _batches(self, folder: str) -> list[str]:
        return _children(self.spark, f"{self.root}/rows/{folder}")

    def _read(self, folder: str) -> DataFrame | None:
        paths = [f"{self.root}/rows/{folder}/{name}" for name in self._batches(folder)]
        if not paths:
            return None
        return self.spark.read.option("mergeSchema", "true").parquet(*paths)

    def read_open(self) -> DataFrame | None:
        return self._read(self._open_folder())

    def open_batches(self) -> list[tuple[str, str]]:
        """Name and folder of each batch of the open period."""
        folder = self._open_folder()
        return [(name, f"{self.root}/rows/{folder}/{name}") for name in self._batches(folder)]

    def derived(self, kind: str, batch: str) -> str:
        """Where what is derived from a batch is kept; it goes when the batch is written again."""
        return f"{self.root}/derived/{self._open_folder()}/{kind}/batch={batch}"

    def committed(self, path: str) -> bool:
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
        return marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(marker)

    def _drop_derived(self, folder: str, batch: str) -> None:
        every = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/derived/{folder}/*/batch={batch}")
        fs = every.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for status in fs.globStatus(every) or []:
            fs.delete(status.getPath(), True)

    def append(
        self,
        incoming: DataFrame,
        batch: int | None = None,
        url: str = "url",
        topic: str = "topic",
        order: str = "ord",
        writer: str = "append",
        rows: DataFrame | None = None,
    ) -> DataFrame:
        """Append the unseen rows of a batch and return the open period.

        ``writer`` and ``batch`` name a batch that may be written again; without a
        number the batch gets a name of its own. Held keys are looked up in the period's
        key index, so an append reads the index files of its own buckets, not the period.
        Two appends at the same time do not see one another's rows: have one writer, or
        let a later ``read_open`` be deduplicated with ``first_by``.

        With ``rows`` only ``order`` and the keys of ``incoming`` are worked on, and the rows
        to append are looked up in ``rows`` by ``order``, which must tell all of them apart:
        long texts are then read for these rows only.
        """
        folder = self._open_folder()
        held = self._batches(folder)
        tag = f"{writer}.{uuid.uuid4().hex if batch is None else batch}"
        again = [n for n in held if n.partition(".")[2] == tag]
        number = _number(again[0]) if again else max(map(_number, held), default=-1) + 1
        name = f"b{number:09d}.{tag}"
        path = f"{self.root}/rows/{folder}"
        index = KeyIndex(self.spark, f"{self.root}/derived/{folder}/keys-{url}-{topic}")
        earlier = [n for n in held if _number(n) < number]
        for missing in [n for n in earlier if not index.has(n)]:
            index.add(missing, self.spark.read.parquet(f"{path}/{missing}"), url, topic)
        self._drop_derived(folder, name)  # until the rows of this name are there again

        def known(first: DataFrame) -> DataFrame | None:
            return index.held(written(hashed(first), "batch_keys"), earlier) if earlier else None

        if rows is not None:
            incoming = incoming.select(order, url, topic)
        fresh = unseen_rows(incoming, known, url, topic, order)
        if rows is not None:
            # Settled before: where they are few, the planner looks them up without a shuffle.
            fresh = rows.join(written(fresh.select(order), "unseen"), order, "left_semi")
        fresh.withColumn(BATCH_COLUMN, F.lit(number)).write.mode("overwrite").parquet(f"{path}/{name}")
        index.add(name, self.spark.read.parquet(f"{path}/{name}"), url, topic)
        return self._read(folder)

    def _mark_closed(self, generation: int, period_id: str | None, folder: str, following: str) -> None:
        row = self.spark.range(1).select(
            F.lit(generation).alias("generation"),
            F.lit(period_id).cast("string").alias(PERIOD_COLUMN),
            F.lit(folder).alias("folder"),
            F.lit(following).alias("next"),
        )
        row.write.mode("overwrite").parquet(f"{self.root}/closed/g{generation:06d}")

    def _new_folder(self) -> str:
        return f"g{self.generation() + 1:06d}-{uuid.uuid4().hex}"

    def replace(self, rows: DataFrame) -> DataFrame:
        """Put ``rows`` in place of the open period (after enrichment).

        Batch numbers go on from there, so they keep telling the row order.
        """
        folder, following = self._open_folder(), self._new_folder()
        number = max(map(_number, self._batches(folder)), default=0)
        rows.write.parquet(f"{self.root}/rows/{following}/b{number:09d}.replace.{uuid.uuid4().hex}")
        self._mark_closed(self.generation(), None, folder, following)
        return self._read(following)

    def compact(self) -> DataFrame | None:
        """The open period as one batch, after many small ones."""
        rows = self.read_open()
        return None if rows is None else self.replace(rows)

    def close(self, period_id: str) -> None:
        """Close the open period; closing when nothing is open does nothing."""
        folder = self._open_folder()
        held = self._read(folder)
        if held is not None and not held.isEmpty():
            self._mark_closed(self.generation(), period_id, folder, self._new_folder())

    def read_archive(self) -> DataFrame | None:
        """All rows of the closed periods with their ``period_id``, in one scan."""
        markers = [f"{self.root}/closed/g{n:06d}" for n in self._closed()]
        if not markers:
            return None
        named = self.spark.read.parquet(*markers).filter(F.col(PERIOD_COLUMN).isNotNull())
        named = named.select(F.col("folder").alias("_folder"), PERIOD_COLUMN)
        folders = [r["_folder"] for r in named.collect()]  # one name per period
        paths = [f"{self.root}/rows/{f}/{b}" for f in folders for b in self._batches(f)]
        if not paths:
            return None
        rows = self.spark.read.option("mergeSchema", "true").parquet(*paths)
        folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3)
        return rows.withColumn("_folder", folder).join(named, "_folder").drop("_folder")


def _number(batch_name: str) -> int:
    return int(batch_name.partition(".")[0][1:])


INTERNAL_PREFIXES = ("_audit_", "audit_", BATCH_COLUMN)


def drop_internal(rows: DataFrame, prefixes: tuple[str, ...] = INTERNAL_PREFIXES) -> DataFrame:
    return rows.drop(*[c for c in rows.columns if c.startswith(prefixes)])


def export_flat(rows: DataFrame, path: str, columns: list[str]) -> None:
    """CSV with a fixed column order, other public columns behind."""
    public = drop_internal(rows)
    ordered = [c for c in columns if c in public.columns] + [c for c in public.columns if c not in columns]
    public.select(*ordered).write.mode("overwrite").option("header", True).option("escape", '"').option("quote", '"').csv(path)
