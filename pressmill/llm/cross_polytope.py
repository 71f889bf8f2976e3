"""Approximate nearest neighbours by cross-polytope hashing.

A table turns unit vectors by three rounds of random signs and a fast Hadamard
transform, and assigns each to the nearest signed axis. A query probes the buckets of
its nearest axes in each table; all rows found are compared exactly, in double precision.

The index holds every row once in each table. A bucket is cut into blocks of rows and
of queries of bounded size; every pair of blocks is one piece of work that returns a few
neighbours per query, so neither a hot bucket nor the candidates of a query meet in one
task, and candidate pairs are never rows. Of equal vectors only the smallest ids, one
more than asked for, can be among the results; the others are left out of the index. A
query that finds fewer rows than asked for is compared with all rows in the same blocks.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
take no part, nor do rows without id; vectors of different lengths are never compared;
repeated rows count once, and of an id with several vectors the nearest counts; ties go
to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressmill.llm.arrow_tasks import by_task
from pressmill.llm.common import parts_of, table
from pressmill.session import written

TABLES, PROBES = 16, 6
#: Hashes that make up a bucket; more of them for indexes of many millions of rows.
HASHES = 1
NEIGHBOURS = 5
ROW_BLOCK, QUERY_BLOCK = 4096, 512
SEED = 5


def usable(vector: Column) -> Column:
    fine = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    )
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that squares neither overflow nor vanish."""
    exponent = np.frexp(np.abs(vectors).max(axis=1))[1]
    return np.ldexp(vectors, -exponent[:, None])


def _hadamard(rows: np.ndarray) -> np.ndarray:
    n, width, step = *rows.shape, 1
    while step < width:
        pairs = rows.reshape(n, -1, 2, step)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack([low + high, low - high], axis=2).reshape(n, width)
        step *= 2
    return rows


def _rotated(rows: np.ndarray, number: int) -> np.ndarray:
    """Pseudo-rotation ``number`` of rows padded to a power of two."""
    signs = np.random.default_rng([SEED, number]).choice([-1.0, 1.0], (3, rows.shape[1]))
    for round_signs in signs:
        rows = _hadamard(rows * round_signs)
    return rows


def buckets(vectors: np.ndarray, probes: int, tables: int = TABLES, hashes: int = HASHES) -> np.ndarray:
    """The ``probes`` nearest buckets of each row in each table, nearest first."""
    n, size = vectors.shape
    width = 1 << max(size - 1, 0).bit_length()
    unit = scaled(vectors)
    unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    padded = np.zeros((n, width))
    padded[:, :size] = unit
    out = np.empty((n, tables, probes), np.int64)
    for number in range(tables):
        codes, near = np.zeros((n, 1), np.int64), np.zeros((n, 1))
        for h in range(hashes):
            turned = _rotated(padded, number * hashes + h)
            axes = np.concatenate([turned, -turned], axis=1)  # + axes, then - axes
            best = np.argsort(-axes, axis=1, kind="stable")[:, : min(probes, 2 * width)]
            value = np.take_along_axis(axes, best, 1)
            codes = (codes[:, :, None] * (2 * width) + best[:, None, :]).reshape(n, -1)
            near = (near[:, :, None] + value[:, None, :]).reshape(n, -1)
            order = np.argsort(-near, axis=1, kind="stable")[:, :probes]
            codes, near = np.take_along_axis(codes, order, 1), np.take_along_axis(near, order, 1)
        # With fewer buckets than probes the nearest is repeated, which finds nothing new.
        out[:, number, :] = codes[:, np.minimum(np.arange(probes), codes.shape[1] - 1)]
    return out


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1)


def _hashed(rows: DataFrame, probes: int, tables: int, hashes: int) -> DataFrame:
    """``id, vector, size`` and one row for each table and probed bucket."""
    kind = rows.schema["vector"].dataType.simpleString()
    names = ["id", "vector", "size", "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                found = buckets(_matrix(part.column(1)), probes, tables, hashes)
                per_row = found.shape[1] * found.shape[2]
                ends = pa.array(np.arange(0, found.size + 1, per_row), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(found.reshape(-1), pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names)

    done = rows.select("id", "vector", F.size("vector").alias("size")).mapInArrow(
        run, f"id long, vector {kind}, size int, buckets array<bigint>"
    )
    spot = F.posexplode("buckets").alias("at", "bucket")
    table_of = F.expr(f"cast(at div {probes} as int)").alias("tree")
    return done.select("id", "vector", "size", spot).select(
        "id", "vector", "size", table_of, "bucket"
    )


def _searched(index: DataFrame, probed: DataFrame, place: list[str], k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows with the place of a query."""
    sizes = (
        index.groupBy(*place).agg(F.ceil(F.count("*") / ROW_BLOCK).cast("int").alias("row_blocks"))
        .join(
            probed.groupBy(*place).agg(
                F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks")
            ),
            place,
        )
    )

    def dealt(side: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        block = F.expr(f"cast(pmod(xxhash64(id), {own}) as int)")
        each = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        both = side.join(sizes, place).select("*", block.alias("b"), each.alias("o"))
        ends = ("o", "b") if asks else ("b", "o")
        return both.select(
            F.concat_ws(":", *place, *ends).alias("task"), F.lit(asks).alias("asks"), "id", "vector"
        )

    work = dealt(index, "row_blocks", "query_blocks", False).unionByName(
        dealt(probed, "query_blocks", "row_blocks", True)
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_task(batches):
            asks = part.column("asks").to_numpy(zero_copy_only=False)
            if asks.all() or not asks.any():
                continue
            ids = part.column("id").to_numpy()
            found = best(_matrix(part.column("vector")), ids, asks, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in found], ["query_id", "vec_id", "score"]
            )

    found = (
        work.repartition(parts_of(index.sparkSession), "task")
        .sortWithinPartitions("task")
        .mapInArrow(search, "query_id long, vec_id long, score double")
    )
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        once.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest(rows: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, tables: int = TABLES,
            probes: int = PROBES, hashes: int = HASHES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of ``id, vector`` rows and queries.

    Rows with the id of the query are no candidates.
    """
    copies = Window.partitionBy("vector").orderBy("id")
    indexed = (
        rows.where(usable(F.col("vector")) & F.col("id").isNotNull())
        .distinct()
        .withColumn("copy", F.row_number().over(copies))
        .where(F.col("copy") <= k + 1)
        .drop("copy")
    )
    asked = queries.where(usable(F.col("vector")) & F.col("id").isNotNull()).distinct()
    index = written(_hashed(indexed, 1, tables, hashes), "index")
    probed = written(_hashed(asked, probes, tables, hashes), "probes")
    found = written(_searched(index, probed, ["size", "tree", "bucket"], k), "found")
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = asked.join(full, "id", "left_anti").withColumn("size", F.size("vector"))
    exact = _searched(index.where("tree = 0"), short, ["size"], k)
    return found.join(full.withColumnRenamed("id", "query_id"), "query_id", "left_semi").select(
        "query_id", "rank", "vec_id", "score"
    ).unionByName(exact)


def best(vectors: np.ndarray, ids: np.ndarray, asks: np.ndarray, k: int):
    """Columns query id, row id, cosine: the ``k`` nearest rows of each query."""
    vectors = scaled(vectors)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    rows, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
    unit = vectors / norms[:, None]
    near = unit[queries] @ unit[rows].T
    near[ids[queries][:, None] == ids[rows][None, :]] = -np.inf
    out: list[tuple] = []
    for i, q in enumerate(queries):
        line = near[i]
        least = np.partition(line, -k)[-k] if len(line) > k else -np.inf
        # The product may round ties apart; the exact measure decides among them.
        some = rows[(line >= least - 1e-9) & (line > -np.inf)]
        score = (vectors[some] * vectors[q]).sum(axis=1) / (norms[some] * norms[q])
        order = np.lexsort((ids[some], -score))[:k]
        out.append((np.full(len(order), ids[q]), ids[some][order], score[order]))
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector")
    )
    return nearest(rows, rows.where("id % 50 = 0"))


QUERIES = {"op2_cross_polytope": _query}
ORACLES: dict[str, str] = {}
