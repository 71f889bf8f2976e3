"""Sharding by proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked; a row's fractional
rank is (rank + 1/2) / rows of its source. Sorted by it, any stretch of rows holds the
sources in the proportions of the whole table, so equal cuts give shards that all match
the mixture. The law is ``rows``: shard sizes differ by one row at most.

Both ranks come from distributed sorts of narrow rows (no texts), so a source may hold
any share of the rows; nothing is gathered per source or in one task.

Defined results: null text has no bytes and crc 0; null source is a source of its own;
null or repeated ``doc_id`` and repeated rows are each placed once; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.common import ranked, table
from pressmill.session import written

SHARDS = 8
SEED = 20_240_601


def shard(
    rows: DataFrame, key: list[str], stratum: str, shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """``rows`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    ``key`` names the columns that identify a row; they and the seed fix the shuffle.
    """
    given = rows.columns
    mixed = F.xxhash64(F.lit(seed), *key)
    inner = ranked(rows, [stratum], [mixed, *map(F.col, key)], "strata").withColumnRenamed(
        "rank_", "nth_"
    )
    sizes = rows.groupBy(F.col(stratum).alias("stratum_")).agg(F.count("*").alias("size_"))
    placed = inner.join(sizes, F.col(stratum).eqNullSafe(F.col("stratum_"))).select(
        *given, ((F.col("nth_") + 0.5) / F.col("size_")).alias("share_")
    )
    order = [F.col("share_"), F.col(stratum), mixed, *map(F.col, key)]
    total = rows.count()
    # Shard s holds the ranks from ceil(s * total / shards) on.
    done = ranked(placed, [], order, "mixture").withColumn(
        "shard_", F.expr(f"rank_ * {shards} div {max(total, 1)}")
    )
    first = F.expr(f"(shard_ * {total} + {shards - 1}) div {shards}")
    return done.select(
        *given, F.col("shard_").cast("int").alias("shard"), (F.col("rank_") - first).alias("slot")
    )


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    done = shard(written(narrow, "narrow"), ["doc_id", "text_crc32", "size"], "source")
    return done.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op6_interleaved_shards": _query}
ORACLES: dict[str, str] = {}
