"""Day caches read by ranges of bytes, so that one huge document feeds many tasks.

An indented cache document (two spaces a level) has each day key on a line of its own at
depth two. A line break cannot stand inside a JSON string, so ``\\n    "`` begins a day
entry and nothing else, and the text source splits a file there, on any file system, in
ranges of ``spark.sql.files.maxPartitionBytes``. No task holds more than one entry.

A broken document yields no rows, which only all of its entries together can tell. So a
first scan proves each file: one root, entries that all parse, the end last. Files that
prove otherwise (another layout, broken or compact ones) are read whole, as
``day_cache.read_documents`` does; the rows are the same either way. The proof can be kept
and handed in again: it holds for a file of the same length and time of change, and then
a read for some days parses the entries of these days only.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressmill.schema import DAY_ENTRY, SOURCES
from pressmill.sources import day_cache as dc

#: Begins a day entry; what precedes the first one is the head of the document.
ENTRY_START = '\n    "'
_TAIL = "\n  }\n}"
_FILE = ["file", "modified", "size"]
PROOF = "file string, modified timestamp, size long, regular boolean"


def read_pieces(
    spark: SparkSession,
    path: str,
    sources: list[str] | None = None,
    topics: list[str] | None = None,
) -> DataFrame | None:
    """``file, modified, size, source, topic, at, value``: heads and entries of all files.

    ``at`` orders the pieces of a file. None if no folder is wanted.
    """
    paths = [path]
    if sources is not None or topics is not None:
        paths = dc._wanted_folders(spark, path.rstrip("/"), sources, topics)
    if not paths:
        return None
    reader = spark.read.option("recursiveFileLookup", "true").option("lineSep", ENTRY_START)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("size"),
        dc._path_part(3).alias("source"),
        dc._path_part(2).alias("topic"),
        F.struct(
            F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("nth")
        ).alias("at"),
        "value",
    )


def _with_parts(pieces: DataFrame) -> DataFrame:
    """Adds ``head``, ``last``, ``day`` and ``body``; a piece of no known form has no body."""
    review_rooted = [s.id for s in SOURCES if s.root_key == "reviews"]
    root = F.when(F.col("source").isin(review_rooted), F.lit("reviews")).otherwise(F.lit("days"))
    ended = F.regexp_replace("value", r"\s+\z", "")
    last = F.endswith(ended, F.lit(_TAIL))
    text = (
        F.when(last, F.left(ended, F.length(ended) - len(_TAIL)))
        .when(F.endswith("value", F.lit(",")), F.left("value", F.length("value") - 1))
    )
    day = F.substring_index("value", '"', 1)
    known = F.startswith(F.substr("value", F.length(day) + 1), F.lit('": {')) & ~F.contains(
        day, F.lit("\\")
    )
    return pieces.withColumns(
        {
            "head": F.col("value") == F.concat(F.lit('{\n  "'), root, F.lit('": {')),
            "last": last,
            "day": day,
            "body": F.when(known, F.substr(text, F.length(day) + 4)),
        }
    )


def _entry(body="body"):
    wrapped = F.concat(F.lit('{"entry":'), F.col(body), F.lit("}"))
    kind = f"struct<entry:{DAY_ENTRY.simpleString()}>"
    return F.from_json(wrapped, kind, dc._STRICT)["entry"]


def prove(pieces: DataFrame) -> DataFrame:
    """``file, modified, size, regular``: may the file's entries be read one by one?"""
    parsed = _with_parts(pieces).withColumn("good", ~F.col("head") & _entry().isNotNull())
    return (
        parsed.groupBy(*_FILE)
        .agg(
            F.count_if("head").alias("heads"),
            F.min_by("head", "at").alias("head_first"),
            F.count_if(F.col("last") & F.col("good")).alias("lasts"),
            F.max_by("last", "at").alias("last_last"),
            F.count_if(~F.col("head") & ~F.col("good")).alias("others"),
        )
        .select(
            *_FILE,
            (
                (F.col("heads") == 1)
                & F.col("head_first")
                & (F.col("lasts") == 1)
                & F.col("last_last")
                & (F.col("others") == 0)
            ).alias("regular"),
        )
    )


def scan_entries(
    spark: SparkSession,
    path: str,
    sources: list[str] | None = None,
    topics: list[str] | None = None,
    first_day: str | None = None,
    last_day: str | None = None,
    proof: DataFrame | None = None,
) -> DataFrame:
    """A row per day entry: ``file, line, source, topic, day, entry``, one document per file.

    The rows of ``day_cache.scan_entries`` over whole documents, of the days from
    ``first_day`` to ``last_day`` (None: no bound). ``proof`` holds rows of ``prove``; files
    it does not know as they are now are proved first. Names of files read whole pass the
    driver, which lists all files anyway.
    """
    pieces = read_pieces(spark, path, sources, topics)
    if pieces is None:
        return dc.scan_entries(dc.read_documents(spark, path, sources=sources, topics=topics))
    if proof is None:
        proof = prove(pieces)
    else:
        proof = proof.select(*_FILE, "regular").dropDuplicates(_FILE)
        fresh = prove(pieces.join(proof, _FILE, "left_anti"))
        proof = proof.unionByName(fresh)
    low = F.lit(True) if first_day is None else F.col("day") >= first_day
    high = F.lit(True) if last_day is None else F.col("day") <= last_day
    regular = proof.filter("regular")
    entries = (
        _with_parts(pieces)
        .filter(~F.col("head") & low & high)
        .join(regular, _FILE, "left_semi")
        .select("file", F.lit(0).cast("long").alias("line"), "source", "topic", "day", _entry().alias("entry"))
    )
    present = pieces.select(*_FILE).distinct().join(regular, _FILE, "left_anti")
    whole = [_as_path(row.file) for row in present.select("file").toLocalIterator()]
    if not whole:
        return entries
    rest = dc.scan_entries(dc.read_files(spark, whole)).filter(low & high)
    return entries.unionByName(rest)


def _as_path(file: str) -> str:
    """The path of a file's address, with the signs of patterns escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(file))
