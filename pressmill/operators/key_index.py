"""Which keys a period holds, without scanning its rows.

Each committed batch leaves its keys in Parquet, partitioned by a bucket of their hash
and sorted by hash, with a Parquet Bloom filter on the hash in every bucket file. A batch
has a power of two of buckets, one for about ``PER_BUCKET`` keys. An append of at most
``PROBES`` keys reads the files of its own buckets only, and of these only the row groups
whose Bloom filter may hold one of its hashes; a larger one reads the buckets it touches
and compares them exactly. Either way url and topic decide, never a hash alone.

The index is derived: a batch whose keys are missing (a break between the two writes, or
rows written another way) is indexed again from its rows.
"""

from __future__ import annotations

from functools import reduce
import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressmill.functions.text import strip, text_or_empty, url_key
from pressmill.session import written

KEY = ["_url", "_topic"]
PER_BUCKET, MAX_BUCKETS, PROBES = 4096, 4096, 1000
#: Parquet pushes an IN of up to this many values down to its filters (Spark's default).
_PUSHED = 10


def keyed(rows: DataFrame, url: str, topic: str) -> DataFrame:
    """``rows`` with the normalised ``_url`` and ``_topic``."""
    return rows.withColumns(
        {"_url": url_key(F.col(url)), "_topic": strip(text_or_empty(F.col(topic)))}
    )


def hashed(keys: DataFrame) -> DataFrame:
    """The distinct keys with a url, with their ``hash``."""
    keys = keys.filter("_url <> ''").select(*KEY).distinct()
    return keys.select(*KEY, F.xxhash64(*KEY).alias("hash"))


def _bucket(buckets: int) -> Column:
    return F.pmod("hash", F.lit(buckets)).cast("int")


def _touched(buckets: list[int]) -> Column:
    """The bucket files that can hold a hash whose finest bucket is one of ``buckets``."""
    out, of = F.lit(False), MAX_BUCKETS
    while of:
        own = sorted({b % of for b in buckets})
        inside = F.lit(True) if len(own) == of else F.col("bucket").isin(own)
        out, of = out | ((F.col("of") == of) & inside), of // 2
    return out


def _one_of(column: str, values: list[int]) -> Column:
    """Membership as a balanced tree of INs that Parquet's filters take."""
    terms = [F.col(column).isin(values[i : i + _PUSHED]) for i in range(0, len(values), _PUSHED)]
    while len(terms) > 1:
        pairs = [terms[i : i + 2] for i in range(0, len(terms), 2)]
        terms = [reduce(lambda a, b: a | b, pair) for pair in pairs]
    return terms[0]


class KeyIndex:
    """The keys of the batches of one open period below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _path(self, batch: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/batch={batch}")

    def has(self, batch: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(batch), "_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def drop(self, batch: str) -> None:
        path = self._path(batch)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def add(self, batch: str, rows: DataFrame, url: str, topic: str) -> None:
        """Index the keys of a committed batch."""
        keys = written(hashed(keyed(rows.select(url, topic), url, topic)), "keys")
        wanted = max(keys.count() / PER_BUCKET, 1)
        of = min(2 ** math.ceil(math.log2(wanted)), MAX_BUCKETS)
        (
            keys.withColumns({"of": F.lit(of), "bucket": _bucket(of)})
            .repartition("bucket")
            .sortWithinPartitions("bucket", "hash")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")  # commits the batch as a whole
            .partitionBy("of", "bucket")
            .option("parquet.bloom.filter.enabled#hash", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .option("parquet.enable.dictionary#hash", "false")
            .parquet(f"{self.root}/batch={batch}")
        )

    def candidates(self, probe: DataFrame, batches: list[str]) -> DataFrame:
        """The indexed keys that may be among ``probe`` (``hash``), read as described above."""
        finest = probe.select("hash", _bucket(MAX_BUCKETS).alias("bucket"))
        few = finest.limit(PROBES + 1).collect()
        exact = len(few) <= PROBES
        rows = few if exact else finest.select("bucket").distinct().collect()  # MAX_BUCKETS at most
        paths = [f"{self.root}/batch={b}" for b in batches]
        held = (
            self.spark.read.schema("_url string, _topic string, hash long, of int, bucket int")
            .option("basePath", self.root)
            .parquet(*paths)
            .filter(_touched([r["bucket"] for r in rows]))
        )
        if exact and few:
            held = held.filter(_one_of("hash", sorted({r["hash"] for r in few})))
        return held.select("hash", *KEY)

    def held(self, probe: DataFrame, batches: list[str]) -> DataFrame:
        """The keys of ``probe`` (from ``hashed``) that one of ``batches`` holds."""
        if not batches:
            return probe.select(*KEY).limit(0)
        found = self.candidates(probe, batches)
        return probe.join(found, ["hash", *KEY], "left_semi").select(*KEY)
