"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressmill.session import written


def _edge_mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """``(id, component)`` of the linked rows; the component is its smallest id.

    Alternating large-star and small-star rounds over an edge table, until the
    edges are stars around the smallest ids. Each round aggregates per node with
    map-side combine and is written to the shared folder.
    """
    edges = links.select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    ).filter("u <> v").distinct()
    edges = written(edges, "edges")
    mark = _edge_mark(edges)
    while True:
        edges = written(_small_star(_large_star(edges)), "edges")
        new = _edge_mark(edges)
        if new == mark:
            break
        mark = new
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest of its group."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (
        both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
