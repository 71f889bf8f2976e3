"""N-gram Jaccard join with MinHash prefixes of one depth (banding).

Texts (lower case, words split at white space) are sets of five-word shingles; a text of
fewer words is one shingle. The join finds all pairs of texts with a Jaccard similarity
of 0.8 or more.

1. Equal word sequences collapse to one node with its number of rows.
2. Each node gets one hashed signature prefix for each of ``TREES`` tries. All have the
   longest depth at which a pair at the threshold meets in some trie with the target recall
   (``depth_for``). The depth does not follow the data: all pairs are wanted, so a node that
   met others at a greater depth must still be matched at this one.
3. Nodes that share a prefix are candidates. A prefix group is cut into blocks of bounded
   size, each pair of blocks being one piece of work, so that a hot prefix is spread over
   many tasks. A pair is verified only in the first trie where it meets; groups whose
   nodes all met in an earlier trie are skipped before any shingles are sent.
4. Each piece of work compares the whole shingle sets exactly and returns, per node, its
   number of links and one link that joins it to its part of the group: never the pairs.
5. Links' closure gives the classes.

Result: one row per document with ``class_id`` (the smallest ``doc_id`` of the class) and
``n_links`` (how many other documents have a similarity of 0.8 or more with it, copies
included).

Defined results: a null text is empty, and texts without words are copies of one another;
null ids are in classes but name none (a class of null ids only has a null ``class_id``);
repeated rows are copies; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
import xxhash

from pressmill.llm.arrow_tasks import by_task
from pressmill.llm.chunk_ids import steps
from pressmill.llm.common import parts_of, table
from pressmill.operators.similarity import components
from pressmill.session import written

WORDS, THRESHOLD = 5, 0.8
TREES, FULL_DEPTH, RECALL = 20, 8, 0.9999
#: Nodes of one block; a piece of work compares two blocks at most.
BLOCK = 400
SEED = 11
#: Words that a worker remembers the hashes of.
CACHE_WORDS = 400_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def depth_for(
    threshold: float = THRESHOLD,
    trees: int = TREES,
    full: int = FULL_DEPTH,
    recall: float = RECALL,
) -> int:
    """The longest prefix that lets pairs at the threshold meet with the wanted recall."""
    for depth in range(full, 1, -1):
        if 1 - (1 - threshold**depth) ** trees >= recall:
            return depth
    return 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Hashed shingle sets of texts, with the words' hashes remembered."""

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, {}

    def sets(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Sorted distinct 64-bit hashes of each text's shingles."""
        known, width = self.known, self.words
        if len(known) > CACHE_WORDS:
            known.clear()
        for word in set().union(*texts).difference(known) if texts else ():
            known[word] = xxhash.xxh3_64_intdigest(word, SEED)
        out = []
        for words in texts:
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            n = max(len(h) - width + 1, min(1, len(h)))
            size = len(h) - n + 1 if n else 0
            rolled = np.zeros(n, np.uint64)
            for k in range(size):
                rolled = _mixed(rolled ^ h[k : k + n])
            out.append(np.unique(rolled))
        return out


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def node_of(words: list[str]) -> str:
    return xxhash.xxh3_128_hexdigest(" ".join(words))


def _coefficients(trees: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    size = (trees, depth)
    factors = random.integers(1, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, random.integers(0, 2**63, size, dtype=np.uint64)


def prefix_keys(sets: list[np.ndarray], trees: int, depth: int) -> np.ndarray:
    """One 32-bit key per set and trie: the signature prefix of that depth."""
    factors, shifts = _coefficients(trees, depth)
    sizes = np.array([len(s) for s in sets])
    keys = np.zeros((len(sets), trees), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        starts = np.r_[0, np.cumsum(sizes[full])[:-1]]
        for tree in range(trees):
            for level in range(depth):
                least = np.minimum.reduceat(flat * factors[tree, level] + shifts[tree, level], starts)
                keys[full, tree] = _mixed(keys[full, tree] ^ least)
    return (keys >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _signed(docs: DataFrame, trees: int, depth: int) -> DataFrame:
    """``doc_id, text_hash, node, keys`` of every document."""
    names = ["doc_id", "text_hash", "node", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in steps(batches):
            texts = [words_of(t) for t in batch.column(1).to_pylist()]
            keys = prefix_keys(shingler.sets(texts), trees, depth)
            ends = pa.array(np.arange(0, keys.size + 1, trees), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(keys.reshape(-1), pa.int32()))
            nodes = pa.array([node_of(w) for w in texts])
            own = [batch.column(0), batch.column(2)]
            yield pa.RecordBatch.from_arrays([*own, nodes, lists], names)

    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", "text", text_hash).mapInArrow(
        run, "doc_id long, text_hash long, node string, keys array<int>"
    )


def _shingled(docs: DataFrame) -> DataFrame:
    """``node, shingles`` of ``text`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in steps(batches):
            texts = [words_of(t) for t in batch.column(0).to_pylist()]
            sets = shingler.sets(texts)
            ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
            flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
            lists = pa.ListArray.from_arrays(ends, pa.array(flat, pa.int64()))
            nodes = pa.array([node_of(w) for w in texts])
            yield pa.RecordBatch.from_arrays([nodes, lists], ["node", "shingles"])

    return docs.select("text").mapInArrow(run, "node string, shingles array<bigint>")


def _work(nodes: DataFrame, trees: int, block: int) -> DataFrame:
    """``tree, task, side, node``: which blocks of which prefix groups are compared."""
    postings = nodes.select("node", "keys", F.posexplode("keys").alias("tree", "key"))
    shared = postings.groupBy("tree", "key").agg(F.count("*").alias("size")).where("size > 1")
    # Sized from ``nodes``, which has one row for the ``trees`` postings: never broadcast these.
    both = postings.join(shared.hint("merge"), ["tree", "key"])
    # All met before if some earlier trie has one key for the whole group.
    spread = [
        (F.min(F.col("keys")[t]) == F.max(F.col("keys")[t])) & (F.col("tree") > t) for t in range(trees)
    ]
    met = spread[0]
    for one in spread[1:]:
        met = met | one
    fresh = both.groupBy("tree", "key", "size").agg(met.alias("met")).where("NOT met").drop("met", "size")
    fresh = both.join(fresh.hint("merge"), ["tree", "key"]).select(
        "tree",
        "key",
        "node",
        F.ceil(F.col("size") / block).cast("int").alias("blocks"),
    )
    place = F.expr("cast(pmod(xxhash64(node), blocks) as int)")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        fresh.withColumn("own", place)
        .select("tree", "key", "node", "own", other.alias("other"))
        .select(
            "tree",
            F.concat_ws(
                ":", "tree", "key", F.least("own", "other"), F.greatest("own", "other")
            ).alias("task"),
            (F.col("own") > F.col("other")).alias("second"),
            (F.col("own") == F.col("other")).alias("inner"),
            "node",
        )
    )


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def compare(
    tree: int, second: np.ndarray, inner: bool, keys: np.ndarray, weights: np.ndarray,
    flat: np.ndarray, starts: np.ndarray, threshold: float,
) -> tuple[np.ndarray, list[int]]:
    """Links (in rows) per node of one piece of work, and a spanning forest's parents."""
    n = len(second)
    sizes = np.diff(starts)
    ids = np.unique(flat, return_inverse=True)[1]
    marked = np.zeros(len(flat), bool)
    links, parent = np.zeros(n, np.int64), list(range(n))
    for i in range(n) if inner else np.flatnonzero(~second):
        others = np.arange(i + 1, n) if inner else np.flatnonzero(second)
        ratio = np.minimum(sizes[others], sizes[i]) >= threshold * np.maximum(sizes[others], sizes[i])
        met = (keys[others, :tree] == keys[i, :tree]).any(axis=1)
        others = others[ratio & ~met & (keys[others, tree] == keys[i, tree])]
        if not len(others):
            continue
        marked[ids[starts[i] : starts[i + 1]]] = True
        if 4 * len(others) < n:
            hit = np.array([marked[ids[starts[j] : starts[j + 1]]].sum() for j in others])
        else:
            total = np.r_[0, np.cumsum(marked[ids])]
            hit = total[starts[others + 1]] - total[starts[others]]
        marked[ids[starts[i] : starts[i + 1]]] = False
        union = sizes[others] + sizes[i] - hit
        for j in others[hit >= threshold * union - 1e-9].tolist():
            links[i] += weights[j]
            links[j] += weights[i]
            a, b = _root(parent, i), _root(parent, j)
            parent[max(a, b)] = min(a, b)
    return links, [_root(parent, i) for i in range(n)]


def _verified(rows: DataFrame, threshold: float) -> DataFrame:
    """``node, links, joined`` of the pieces of work; ``joined`` links it to its part."""

    def finish(work: pa.RecordBatch) -> pa.RecordBatch:
        n = work.num_rows
        lists = work.column("shingles")
        starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        keys = work.column("keys").flatten().to_numpy().reshape(n, -1)
        links, parent = compare(
            work.column("tree")[0].as_py(),
            work.column("second").to_numpy(zero_copy_only=False),
            work.column("inner")[0].as_py(),
            keys,
            work.column("copies").to_numpy(),
            lists.flatten().to_numpy(),
            starts,
            threshold,
        )
        found = pa.array(np.flatnonzero(links), pa.int64())
        nodes = work.column("node")
        return pa.RecordBatch.from_arrays(
            [
                nodes.take(found),
                pa.array(links, pa.int64()).take(found),
                nodes.take(pa.array(parent, pa.int64()).take(found)),
            ],
            ["node", "links", "joined"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for work in by_task(batches):
            yield finish(work)

    spark = rows.sparkSession
    dealt = rows.repartition(parts_of(spark), "task").sortWithinPartitions("task", "node")
    return dealt.mapInArrow(run, "node string, links long, joined string")


def similar_documents(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id, text_hash, component, class_id, n_links`` of every row of ``doc_id, text``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    depth = depth_for(threshold, trees, recall=recall)
    members = written(_signed(docs, trees, depth), "signed")
    nodes = members.groupBy("node").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("first_id"), F.min("keys").alias("keys")
    )
    nodes = written(nodes, "nodes")
    work = written(_work(nodes, trees, block), "work")
    wanted = work.select("node").distinct()
    about = nodes.join(wanted, "node", "left_semi")
    # One document of each wanted node (a null id stands for itself) gives the shingles.
    ids = about.select(F.col("first_id").alias("wanted_id")).distinct()
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    shingles = _shingled(texts).dropDuplicates(["node"])
    rows = work.join(about.select("node", "copies", "keys"), "node").join(shingles, "node")
    found = written(_verified(rows, threshold), "links")
    linked = components(
        found.where("node <> joined"), left="node", right="joined"
    ).select(F.col("id").alias("node"), "component")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classed = nodes.join(linked, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    heads = classed.groupBy("component").agg(F.min("first_id").alias("class_id"))
    classed = (
        classed.join(heads, "component")
        .join(links, "node", "left")
        .select("node", "component", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    return members.select("doc_id", "text_hash", "node").join(classed, "node").drop("node")


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: of each class of near copies, the document with the smallest id stays."""
    found = similar_documents(docs.select("doc_id", "text"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    heads = found.groupBy("component").agg(F.min(place).alias("head"))
    heads = written(heads.select(_row_key("head.doc_id", F.col("head.text_hash"))), "heads")
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(_row_key("doc_id", text_hash), F.struct(*docs.columns).alias("row"))
    # Rows that repeat id and text share a key.
    return rows.join(heads, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def _row_key(doc_id: str, text_hash: Column) -> Column:
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), text_hash).alias(
        "key"
    )


QUERIES = {"op5_lsh_forest_join": _query}
ORACLES: dict[str, str] = {}
