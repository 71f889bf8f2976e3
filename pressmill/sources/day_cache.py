"""Day caches: nested JSON documents, one per source and topic.

A document is ``{root: {day: entry}}`` with root ``days`` or ``reviews``. A
document is read in full by the task that owns it, as the format is one JSON
value; a cache kept as a table (``write_days``) has no such limit.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import islice
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressmill.schema import DAY_ENTRY, SOURCES
from pressmill.session import work_path, written

_DAY_MAP = f"map<string,{DAY_ENTRY.simpleString()}>"
_ROOTS = f"struct<days:{_DAY_MAP},reviews:{_DAY_MAP}>"
DAY_PARTS = ["source", "topic", "day"]
_STRICT = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}
#: Below a cache: its documents as rows ``(source, topic, body)`` instead of folders.
_TABLE = "documents.parquet"
# What a folder is named by where its part is null or empty.
_UNNAMED = "__HIVE_DEFAULT_PARTITION__"


def _path_part(back: int) -> Column:
    """A folder name counted from the file, ``key=value`` folders unwrapped."""
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -back)
    return F.url_decode(F.regexp_replace(folder, "^[A-Za-z_]+=", ""))


def _wanted_folders(
    spark: SparkSession, path: str, sources: list[str] | None, topics: list[str] | None
) -> list[str]:
    """The ``{source}/{topic}`` folders of the wanted ids, from a listing of names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop(f"{path}/*/*")) or []

    def bare(name: str) -> str:
        return unquote(name.partition("=")[2] or name)

    out = []
    for status in found:
        folder = status.getPath()
        source, topic = bare(folder.getParent().getName()), bare(folder.getName())
        if (sources is None or source in sources) and (topics is None or topic in topics):
            out.append(folder.toString())
    return out


def read_documents(
    spark: SparkSession,
    path: str,
    one_per_line: bool = False,
    sources: list[str] | None = None,
    topics: list[str] | None = None,
) -> DataFrame:
    """``(file, source, topic, body)``, a row per cache document.

    ``path`` holds ``{source}/{topic}/<file>``. With ``one_per_line`` a file
    holds many compact documents, or ``path`` holds a table of documents
    (``stage_documents``). Of the wanted sources and topics (None for all) only
    the folders are opened; a table is filtered.
    """
    if one_per_line and folder_exists(spark, f"{path.rstrip('/')}/{_TABLE}"):
        held = spark.read.parquet(f"{path.rstrip('/')}/{_TABLE}")
        for name, wanted in (("source", sources), ("topic", topics)):
            held = held if wanted is None else held.filter(F.col(name).isin(wanted))
        return held.select(F.col("_metadata.file_path").alias("file"), "source", "topic", "body")
    paths = [path]
    if sources is not None or topics is not None:
        paths = _wanted_folders(spark, path.rstrip("/"), sources, topics)
    if not paths:
        return spark.createDataFrame([], "file string, source string, topic string, body string")
    return read_files(spark, paths, one_per_line)


def read_files(spark: SparkSession, paths: list[str], one_per_line: bool = False) -> DataFrame:
    """The documents of files or folders, as ``read_documents`` gives them."""
    reader = spark.read.option("recursiveFileLookup", "true")
    return reader.text(paths, wholetext=not one_per_line).select(
        F.col("_metadata.file_path").alias("file"),
        _path_part(3).alias("source"),
        _path_part(2).alias("topic"),
        F.col("value").alias("body"),
    )


def parse_documents(docs: DataFrame) -> DataFrame:
    """Adds ``days`` (day key to entry) and ``broken``.

    Text that is not JSON, and JSON without a day map under the root its source
    uses, count as broken and carry an empty map. ``line`` tells the documents of
    a file apart.
    """
    review_rooted = [s.id for s in SOURCES if s.root_key == "reviews"]
    held = F.when(F.col("source").isin(review_rooted), F.col("roots.reviews")).otherwise(
        F.col("roots.days")
    )
    return docs.withColumn("roots", F.from_json("body", _ROOTS, _STRICT)).select(
        "file",
        F.monotonically_increasing_id().alias("line"),
        "source",
        "topic",
        F.coalesce(held, F.create_map().cast(_DAY_MAP)).alias("days"),
        held.isNull().alias("broken"),
    )


def scan_entries(docs: DataFrame) -> DataFrame:
    """A row per day entry: ``file, line, source, topic, day, entry``."""
    # The outer form: a plain explode would parse each document once more, for a
    # filter on the size of the map.
    return parse_documents(docs).select(
        "file", "line", "source", "topic", F.explode_outer("days").alias("day", "entry")
    ).filter("day is not null")


def scan_articles(docs: DataFrame) -> DataFrame:
    """A row per article with its document, source, topic, day key and position."""
    return entry_articles(scan_entries(docs))


def entry_articles(entries: DataFrame) -> DataFrame:
    """The articles of day entries.

    ``items`` is used, or the older ``articles`` where items is missing or empty.
    """
    listed = F.when(F.size("entry.items") > 0, F.col("entry.items")).otherwise(
        F.col("entry.articles")
    )
    return entries.select(
        "file", "line", "source", "topic", "day", F.posexplode(listed).alias("pos", "item")
    ).select("file", "line", "source", "topic", "day", "pos", "item.*")


def scan_all(docs: DataFrame, sources: list[str] | None, topics: list[str]) -> DataFrame:
    """Articles of the wanted sources (None for all) and topics.

    One read, no loop over files.
    """
    wanted = docs.filter(F.col("topic").isin(topics))
    if sources is not None:
        wanted = wanted.filter(F.col("source").isin(sources))
    return scan_articles(wanted)


def write_days(df: DataFrame, path: str) -> None:
    """Replace exactly the ``(source, topic, day)`` partitions present in ``df``.

    Rows are clustered by their partition first, and a partition of many rows
    is cut over tasks by ``maxRecordsPerFile`` and the adaptive rebalance.
    """
    (
        df.hint("rebalance", "source", "topic", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", 2_000_000)
        .partitionBy(*DAY_PARTS)
        .parquet(path)
    )


def upsert_days(
    df: DataFrame,
    path: str,
    links: str = "links_found",
    status: str = "processed",
    processed: DataFrame | None = None,
) -> None:
    """Store whole days: each day in ``df`` replaces what was held for it.

    ``processed`` lists the ``(source, topic, day)`` that were worked on; those
    without rows are emptied.
    """
    if processed is not None and folder_exists(df.sparkSession, path):
        emptied = processed.select(*DAY_PARTS).join(
            df.select(*DAY_PARTS).distinct(), DAY_PARTS, "left_anti"
        )
        drop_days(emptied, path, DAY_PARTS)
    stamped = df.withColumns(
        {
            "processed_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"),
            "status": F.lit(status),
            "links_found": F.coalesce(F.col(links), F.lit(0)) if links in df.columns else F.lit(0),
        }
    )
    write_days(stamped, path)


def folder_exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def drop_days(days: DataFrame, table: str, parts: list[str]) -> int:
    """Delete the partition folders that ``days`` lists; no data is read.

    The list is metadata, a row per folder; it passes through the driver one task's
    rows at a time, and folders are deleted by a few threads.
    """
    spark = days.sparkSession
    folders = written(days.select(*parts).distinct(), "dropped_days")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(table).getFileSystem(spark._jsc.hadoopConfiguration())
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName

    def delete(row) -> int:
        steps = [f"{name}={escape(str(row[name]))}" for name in parts]
        fs.delete(hadoop("/".join([table, *steps])), True)
        return 1

    with ThreadPoolExecutor(8) as threads:
        rows = folders.toLocalIterator()
        return sum(sum(threads.map(delete, lot)) for lot in iter(lambda: list(islice(rows, 1000)), []))


def trim_days(spark: SparkSession, table: str, parts: list[str], keep: Column) -> int:
    """Drop the days of a table that ``keep`` does not hold for."""
    held = spark.read.parquet(table).select(*parts)
    return drop_days(held.filter(~F.coalesce(keep, F.lit(False))), table, parts)


def stage_documents(articles: DataFrame, spark: SparkSession, as_table: bool = False) -> str:
    """Write articles as cache documents, one compact document per line.

    ``articles`` has ``source, topic, chunk, day, root, ord`` and the item
    fields; ``(source, topic, chunk)`` must hold a bounded number of rows. Folders
    suit a bounded number of sources: where these grow with the rows, ``as_table``
    keeps the same documents as rows, in as many files as there are tasks.
    """
    path = work_path(spark, "day_cache")
    fields = ["url", "title", "date", "text", "matched_keyword"]
    item = F.struct("day", "ord", F.struct(*[c for c in fields if c in articles.columns]).alias("item"))

    def entry(day: Column) -> Column:
        own = F.filter("held", lambda h: h["day"].eqNullSafe(day))
        return F.struct(
            day.alias("day"),
            F.struct(
                day.alias("date"),
                F.lit("processed").alias("status"),
                F.size(own).cast("long").alias("links_found"),
                F.transform(own, lambda h: h["item"]).alias("items"),
            ),
        )

    # The days are told apart within a document, so its texts are shuffled once.
    days = (
        articles.groupBy("source", "topic", "chunk", "root")
        .agg(F.array_sort(F.collect_list(item)).alias("held"))
        .withColumn("named", F.array_distinct(F.transform("held", lambda h: h["day"])))
        .withColumn("days", F.map_from_entries(F.transform("named", entry)))
    )
    body = F.concat(F.lit('{"'), F.col("root"), F.lit('":'), F.to_json("days"), F.lit("}"))
    if as_table:
        named = [
            F.coalesce(F.nullif(F.col(n).cast("string"), F.lit("")), F.lit(_UNNAMED)).alias(n)
            for n in ("source", "topic")
        ]
        days.select(*named, body.alias("body")).write.parquet(f"{path}/{_TABLE}")
        return path
    days.select("source", "topic", body.alias("value")).write.partitionBy(
        "source", "topic"
    ).text(path)
    return path


def stage_indented(articles: DataFrame, spark: SparkSession) -> str:
    """Write articles as one indented document per source and topic, a line per day.

    ``articles`` has ``source, topic, day, ord`` and the item fields; a day of a source and
    topic must hold a bounded number of rows, a document need not.
    """
    path = work_path(spark, "day_cache")
    part = ["source", "topic"]
    fields = ["url", "title", "date", "text", "matched_keyword"]
    item = F.struct("ord", F.struct(*[c for c in fields if c in articles.columns]).alias("item"))
    days = articles.groupBy(*part, "day").agg(F.array_sort(F.collect_list(item)).alias("held"))
    entry = F.struct(
        F.col("day").alias("date"),
        F.lit("processed").alias("status"),
        F.size("held").cast("long").alias("links_found"),
        F.transform("held", lambda h: h["item"]).alias("items"),
    )
    ends = days.groupBy(*part).agg(F.max("day").alias("last"))
    lines = days.join(ends, part).select(
        *part,
        F.col("day").alias("place"),
        F.concat(
            F.lit('    "'),
            "day",
            F.lit('": '),
            F.to_json(entry),
            F.when(F.col("day") == F.col("last"), F.lit("")).otherwise(F.lit(",")),
        ).alias("value"),
    )
    review_rooted = [s.id for s in SOURCES if s.root_key == "reviews"]
    root = F.when(F.col("source").isin(review_rooted), F.lit("reviews")).otherwise(F.lit("days"))
    head = F.concat(F.lit('{\n  "'), root, F.lit('": {'))
    first = ends.select(*part, F.lit("").alias("place"), head.alias("value"))
    tail = ends.select(*part, F.lit("~").alias("place"), F.lit("  }\n}").alias("value"))
    (
        lines.unionByName(first)
        .unionByName(tail)
        .repartition(*part)
        .sortWithinPartitions(*part, "place")
        .drop("place")
        .write.partitionBy(*part)
        .text(path)
    )
    return path
