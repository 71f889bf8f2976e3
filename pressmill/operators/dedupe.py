"""Exact duplicate removal and append-only merging."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from pressmill.functions.text import strip, text_or_empty
from pressmill.operators.components import components
from pressmill.operators.key_index import KEY, keyed
from pressmill.session import written

#: Rounds before the pending rows are parted, and rows of a component decided in one pass.
ROUNDS, COMPONENT_ROWS = 3, 50_000


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key.

    ``row_number() = 1`` is planned as a group limit: each task keeps one row
    per key before the shuffle, so a hot key sends one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def latest_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """Last values per key, at the place (``order``) of the first one."""
    rest = [c for c in df.columns if c not in (key, order)]
    return (
        df.groupBy(key)
        .agg(
            F.max_by(F.struct(*rest), order).alias("last"),
            F.min(order).alias(order),
        )
        .select(key, order, "last.*")
    )


def skip_seen(items: DataFrame, seen: DataFrame, key: str = "url") -> DataFrame:
    """Items whose key was not taken before."""
    return items.join(seen.select(key).distinct(), key, "left_anti")


def dedupe_greedy(
    articles: DataFrame,
    scope: list[str],
    order: str = "ord",
    url: str = "url",
    title: str = "title",
) -> DataFrame:
    """Keep a row unless an earlier *kept* row of its scope shares url or title.

    Empty keys never block, and dropped rows register nothing. The kept rows are
    the greedy matching of urls and titles in ``order``. Each round keeps every
    row that is the first of both its groups and drops the rows these block, so
    the result equals the sequential pass. After each ``ROUNDS`` rounds the pending
    rows are parted into components, which decide nothing of one another: one of at
    most ``COMPONENT_ROWS`` rows is decided in one pass, whatever its chains, and only
    larger ones go on in rounds, until nothing is pending. ``order`` must tell the rows
    of a scope apart, which is checked. Null is a scope value like any other.

    The rounds work on keys only, and equal (url, title) pairs collapse to their
    first row before the first shuffle, so groups of copies cost one row per
    task. The articles themselves are joined once, at the end.
    """
    within = F.struct(*scope) if scope else F.lit(0)
    keys = articles.select(
        within.alias("_scope"),
        F.col(order).alias("_ord"),
        F.nullif(text_or_empty(F.col(url)), F.lit("")).alias("_url"),
        F.nullif(strip(text_or_empty(F.col(title))), F.lit("")).alias("_title"),
    )
    twice = keys.groupBy("_scope", "_ord").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not twice.isEmpty():
        raise ValueError(f"{order} does not tell the rows of a scope apart")
    scope = ["_scope"]  # a struct, which compares null fields as equal
    free = keys.filter("_url is null and _title is null").select(*scope, "_ord")
    pending = (
        keys.filter("_url is not null or _title is not null")
        .groupBy(*scope, "_url", "_title")
        .agg(F.min("_ord").alias("_ord"))
    )
    kept = [free]
    for done in count(1):
        # A round reads the pending rows three times: settled before.
        marked = _mark_first(written(pending, "greedy_pending"), scope)
        held = written(marked, "greedy_round")
        kept.append(held.filter("_first").select(*scope, "_ord"))
        rest = held.filter("not _first").drop("_first")
        if rest.isEmpty():
            break
        winners = held.filter("_first")
        for name in ("_url", "_title"):
            taken = winners.filter(F.col(name).isNotNull()).select(*scope, name).distinct()
            rest = rest.join(taken, [*scope, name], "left_anti")
        pending = rest
        if done % ROUNDS == 0:
            decided, pending = _by_component(pending)
            kept.append(decided)
            if pending.isEmpty():
                break
    chosen = reduce(DataFrame.unionByName, kept)
    rows = articles.withColumns({"_scope": within, "_ord": F.col(order)})
    return rows.join(chosen, ["_scope", "_ord"], "left_semi").select(*articles.columns)


def _by_component(pending: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The kept rows of the smaller components, and the rows of the larger ones.

    Nodes are hashes of keys. A collision joins two components, which changes no result:
    rows block one another by their keys.
    """
    nodes = [
        F.when(F.col(n).isNotNull(), F.xxhash64(F.lit(n), "_scope", n)) for n in ("_url", "_title")
    ]
    rows = pending.withColumns({"_u": F.coalesce(*nodes), "_v": F.coalesce(*nodes[::-1])})
    links = rows.filter("_u <> _v").select("_u", "_v").distinct().repartition("_u")
    member = components(links.mapInPandas(_forest, "left long, right long"))
    placed = written(
        rows.join(member.withColumnRenamed("id", "_u"), "_u", "left")
        .withColumn("component", F.coalesce("component", "_u"))
        .select(*pending.columns, "component"),
        "greedy_components",
    )
    sizes = placed.groupBy("component").agg(F.count(F.lit(1)).alias("rows"))
    large = sizes.filter(F.col("rows") > COMPONENT_ROWS).select("component")
    place = Window.partitionBy("component").orderBy("_ord")
    small = placed.join(large, "component", "left_anti").withColumn("_at", F.row_number().over(place))
    first = (
        small.select("component", "_at", F.to_json(F.struct("_scope")).alias("_within"), "_url", "_title")
        .groupBy("component")
        .applyInPandas(_in_turn, "component long, _at int")
    )
    decided = small.join(first, ["component", "_at"], "left_semi").select("_scope", "_ord")
    return written(decided, "greedy_decided"), placed.join(large, "component", "left_semi").drop("component")


def _forest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's links as links of each node to one node of its component."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while (above := parent.setdefault(node, node)) != node:
            parent[node] = parent[above]
            node = above
        return node

    for part in parts:
        for u, v in zip(part["_u"].tolist(), part["_v"].tolist()):
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    links = [(node, root(node)) for node in parent]
    yield pd.DataFrame([x for x in links if x[0] != x[1]], columns=["left", "right"], dtype="int64")


def _in_turn(group: pd.DataFrame) -> pd.DataFrame:
    """One component in order: a row stays unless a kept one has its url or title."""
    taken, kept = set(), []
    for row in group.sort_values("_at").itertuples(index=False):
        keys = {(n, row[2], k) for n, k in enumerate(row[3:]) if isinstance(k, str)}
        if not keys & taken:
            taken |= keys
            kept.append(row[:2])
    return pd.DataFrame(kept, columns=["component", "_at"])


def _mark_first(pending: DataFrame, scope: list[str]) -> DataFrame:
    """Adds ``_first``: the row is the first of its url group and title group."""
    out = pending
    for name in ("_url", "_title"):
        lowest = (
            pending.filter(F.col(name).isNotNull())
            .groupBy(*scope, name)
            .agg(F.min("_ord").alias(f"_min{name}"))
        )
        out = out.join(lowest, [*scope, name], "left")
    leads = [F.coalesce(F.col("_ord") == F.col(f"_min{n}"), F.lit(True)) for n in ("_url", "_title")]
    return out.select(*scope, "_url", "_title", "_ord", (leads[0] & leads[1]).alias("_first"))


def append_new_only(
    existing: DataFrame | None,
    incoming: DataFrame,
    url: str = "url",
    topic: str = "topic",
    order: str = "ord",
) -> DataFrame:
    """Existing rows plus the incoming rows whose (url, topic) is new.

    Existing rows never change and keep their extra columns. The first incoming
    row per key wins, in the first batch as well; rows without a url are always
    appended.
    """
    if existing is None:
        return new_rows(None, incoming, url, topic, order)
    return existing.unionByName(
        new_rows(existing, incoming, url, topic, order), allowMissingColumns=True
    )


def new_rows(existing: DataFrame | None, incoming: DataFrame, url: str, topic: str, order: str) -> DataFrame:
    """The rows ``append_new_only`` adds."""

    def held(first: DataFrame) -> DataFrame | None:
        if existing is None:
            return None
        # Of the keys held, only those of the batch are shuffled and compared.
        keys = keyed(existing.select(url, topic), url, topic).filter("_url <> ''").select(KEY)
        return keys.join(first.select(KEY), KEY, "left_semi").distinct()

    return unseen_rows(incoming, held, url, topic, order)


def unseen_rows(
    incoming: DataFrame,
    held: Callable[[DataFrame], DataFrame | None],
    url: str,
    topic: str,
    order: str,
) -> DataFrame:
    """The first row of each key that ``held`` does not return, and all rows without a url.

    ``held`` gets the batch's first rows (with ``_url`` and ``_topic``) and returns those of
    their keys that were there before.
    """
    fresh = keyed(incoming, url, topic)
    # Rows without a url skip window and join, so they form no hot key.
    unkeyed = fresh.filter("_url = ''")
    # Both sides shrink to one row per key and task before they are shuffled,
    # and the join reuses the partitioning of that shuffle.
    first = first_by(fresh.filter("_url <> ''"), KEY, [order])
    before = held(first)
    unseen = first if before is None else first.join(before, KEY, "left_anti")
    return unseen.unionByName(unkeyed).drop(*KEY)


def union_append(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Both frames over the union of their columns."""
    return existing.unionByName(new, allowMissingColumns=True)


def union_sources(frames: list[tuple[str, int, DataFrame]]) -> DataFrame:
    """Concatenate ``(topic, source order, frame)`` results with explicit order columns."""
    placed = [
        df.withColumn("topic", F.lit(topic)).withColumn("source_order", F.lit(order))
        for topic, order, df in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), placed)
