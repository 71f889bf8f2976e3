"""Line dedup with run-length keep bitmaps.

1. Documents get a row number and lines a 128-bit hash of their key (the line without
   white space at its ends, A to Z in lower case). Hashes are counted by document with
   map-side combining, and only hashes of enough documents go on.
2. The lines with these hashes are dealt out by ranges of (hash, document, position) and
   sorted so; a hash held by many documents spans several ranges. A pass over the sorted
   lines numbers each hash's occurrences: the first ones are its first in the corpus.
3. What comes back is a bitmap for each document, compressed to its runs of kept lines
   (``keep``: structs of ``first`` and ``lines``), never text. ``apply_bitmaps`` joins
   bitmaps and texts where texts are wanted.

Hashes with the most lines, at most ``HEAVY`` by their definition, are joined by a
broadcast; every other hash has less than 1 / ``HEAVY`` of the lines that are joined.

Defined results: a row is a document, also where ``doc_id`` is null or repeated; documents
come in the order of ``doc_id`` (nulls last) and, within one id, of the table; null and
empty texts are one empty line; keys shorter than ``min_chars`` code points are never
dropped; a line that repeats within one document counts once for it; columns other than
``doc_id`` and ``text`` are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.common import ranked, table
from pressmill.session import written

HEAVY = 1000
#: The white space that is stripped (U+0020, U+0009 to U+000D).
WHITE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A to Z in lower case."""
    cut = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(cut) == F.char_length(cut)
    plain = F.translate(cut, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(ascii_only, F.lower(cut)).otherwise(plain)


def numbered(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text, n_lines``, written once so that row numbers stay the same."""
    text = F.coalesce("text", F.lit(""))
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            text.alias("text"),
            (breaks + 1).cast("long").alias("n_lines"),
        ),
        "line_documents",
    )


def line_hashes(rows: DataFrame, min_chars: int) -> DataFrame:
    """``row, doc_id, pos, h1, h2`` of every line whose key is long enough."""
    lines = rows.select("row", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return (
        lines.withColumn("key", line_key(F.col("line")))
        .where(F.char_length("key") >= min_chars)
        .select(
            "row",
            "doc_id",
            "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), "key").alias("h2"),
        )
    )


def _frequent_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """The lines whose hash stands in at least ``min_docs`` documents."""
    frequent = written(
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct("row").alias("docs"), F.count("*").alias("lines"))
        .where(F.col("docs") >= min_docs)
        .select("h1", "h2", "lines"),
        "line_frequent",
    )
    total = frequent.agg(F.sum("lines")).first()[0] or 0
    heavy = F.col("lines") * HEAVY > F.lit(total)  # so at most HEAVY hashes
    common = lines.join(F.broadcast(frequent.where(heavy).drop("lines")), ["h1", "h2"])
    return common.unionByName(lines.join(frequent.where(~heavy).drop("lines"), ["h1", "h2"]))


def keep_runs(dropped: Column, n_lines: Column) -> Column:
    """The runs of lines between the sorted ``dropped`` positions."""
    before = F.concat(F.array(F.lit(-1)), dropped).alias("before")
    after = F.concat(dropped, F.array(n_lines.cast("int"))).alias("after")
    gaps = F.transform(
        F.arrays_zip(before, after),
        lambda x: F.struct(
            (x["before"] + 1).alias("first"), (x["after"] - x["before"] - 1).alias("lines")
        ),
    )
    return F.filter(gaps, lambda run: run["lines"] > 0)


def keep_bitmaps(
    rows: DataFrame, min_docs: int = 2, min_chars: int = 1, keep_first: int = 1
) -> DataFrame:
    """``row, doc_id, n_lines, n_dropped, keep`` of every row of ``numbered(docs)``.

    Of each key found in at least ``min_docs`` documents the first ``keep_first`` lines
    of the corpus stay and all others go.
    """
    lines = written(line_hashes(rows, min_chars), "line_hashes")
    order = [F.col("doc_id").asc_nulls_last(), F.col("row"), F.col("pos")]
    streamed = ranked(_frequent_lines(lines, min_docs), ["h1", "h2"], order, "line_order")
    dropped = (
        streamed.where(F.col("rank_") >= keep_first)
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("pos")).alias("dropped"))  # one document's lines
    )
    gone = F.coalesce("dropped", F.array().cast("array<int>"))
    return (
        rows.select("row", "doc_id", "n_lines")
        .join(dropped, "row", "left")
        .select(
            "row",
            "doc_id",
            "n_lines",
            F.size(gone).cast("long").alias("n_dropped"),
            keep_runs(gone, F.col("n_lines")).alias("keep"),
        )
    )


def apply_bitmaps(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``bitmaps`` with ``kept``, the text of the kept lines joined by line breaks."""
    split = F.array(F.split("text", "\n", -1))  # an array of one, so it is split once
    kept = F.transform(
        split,
        lambda lines: F.array_join(
            F.flatten(
                F.transform("keep", lambda run: F.slice(lines, run["first"] + 1, run["lines"]))
            ),
            "\n",
        ),
    )[0]
    text = F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(kept)
    return bitmaps.join(rows.select("row", "text"), "row").withColumn("kept", text).drop("text")


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered(table(spark, sf_dir, "documents"))
    bitmaps = keep_bitmaps(rows, min_docs=10, min_chars=1, keep_first=0)
    return apply_bitmaps(rows, bitmaps).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), l AS (
  SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
), s AS (
  SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS kept
  FROM k WHERE key NOT IN (SELECT key FROM f) GROUP BY r
)
SELECT doc_id, len(lines) AS n_lines, len(lines) - coalesce(n, 0) AS n_dropped,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (r)
"""

QUERIES = {"op12_line_dedup": _query}
ORACLES = {"op12_line_dedup": _SQL}
