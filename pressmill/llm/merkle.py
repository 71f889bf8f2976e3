"""Document fingerprints: a Merkle tree over sections, paragraphs and leaves.

A text is split at blank lines into sections and at line breaks into paragraphs; both
splits can be undone. A paragraph's hash is that of its text, a section's that of its
paragraphs' hashes, and the root's that of its sections' hashes: equal roots mean equal
texts, and where the roots differ, differing branches locate the edit (``edits``).

Paragraphs are cut into leaves after the code points of ``CUTS``, so that the cuts follow
the content: an insertion changes the leaves it touches, and those after it stay. A stretch
of 64 code points without such a one is cut there. Two trees are compared by their distinct
nodes of all levels (leaves, paragraphs, sections): their likeness is twice the shared nodes
over all nodes of both. Texts of at most ``SHORT`` code points have a finer level, of every
three code points in a row, and two of them are compared by it. So a text and one that
keeps its first half are never 0 alike, unless that half is line breaks alone.

All of it is DataFrame expressions. Defined results: a null text is empty; two empty
texts are alike (1), an empty and another are not (0); rows with equal ``doc_id`` and
text are one document of the order, each is returned, and all have the same next
document; rows of one ``doc_id`` with different texts follow one another by a hash of the
text; null ids come last in descending order; a single document is its own next one; an
empty table gives no rows; further columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.common import ranked, table
from pressmill.session import written

SECTION_BREAK, PARAGRAPH_BREAK = "\n\n", "\n"
#: A leaf ends after one of these: two letters, and of each 4,096 code points from U+3000 to
#: U+DFFF the first 128, which makes about one in thirty in scripts without spaces.
CUTS = "dkгж" + "".join(rf"\x{{{block:X}000}}-\x{{{block:X}07F}}" for block in range(3, 14))
LEAF = rf"[^\n]{{0,63}}?[{CUTS}]|[^\n]{{1,64}}"
#: Longer than two leaves: the kept half of a longer text holds its first leaf whole.
SHORT = 128


def _node(children: Column) -> Column:
    return F.sha2(F.array_join(children, ","), 256)


def tree(text: Column) -> Column:
    """Sections as structs of ``hash`` and ``paragraphs`` (an array of hashes)."""
    hashes = F.transform(
        F.split(text, F.lit(SECTION_BREAK), -1),
        lambda section: F.transform(
            F.split(section, F.lit(PARAGRAPH_BREAK), -1), lambda line: F.sha2(line, 256)
        ),
    )
    return F.transform(
        hashes, lambda lines: F.struct(_node(lines).alias("hash"), lines.alias("paragraphs"))
    )


def root(sections: Column) -> Column:
    return _node(F.transform(sections, lambda s: s["hash"]))


def nodes(text: Column) -> Column:
    """``all``: distinct hashes of leaves, paragraphs and sections; ``fine``: of a short text's
    runs of three code points (null: the text is long)."""

    def hashes(level: str, parts: Column) -> Column:
        full = F.filter(parts, lambda part: part != "")
        return F.transform(full, lambda part: F.xxhash64(F.lit(level), part))

    every = F.concat(
        hashes("leaf", F.regexp_extract_all(text, F.lit(LEAF), 0)),
        hashes("paragraph", F.split(text, F.lit(PARAGRAPH_BREAK), -1)),
        hashes("section", F.split(text, F.lit(SECTION_BREAK), -1)),
    )
    led = F.concat(F.lit("\n\n"), text)  # so that a single code point makes a run
    runs = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substr(led, i, F.lit(3)))
    fine = F.when(F.length(text) == 0, F.array().cast("array<bigint>")).when(
        F.length(text) <= SHORT, F.array_distinct(F.transform(runs, lambda run: F.xxhash64(run)))
    )
    return F.struct(F.array_distinct(every).alias("all"), fine.alias("fine"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, from the nodes of two texts."""

    def shared(x: Column, y: Column) -> Column:
        total = F.size(x) + F.size(y)
        return F.when(total == 0, 1.0).otherwise(
            2.0 * F.size(F.array_intersect(x, y)) / total
        )

    short = a["fine"].isNotNull() & b["fine"].isNotNull()
    return F.when(short, shared(a["fine"], b["fine"])).otherwise(shared(a["all"], b["all"]))


def edits(a: Column, b: Column) -> Column:
    """(section, paragraph) places, from 0, whose hashes differ between two trees.

    Only the branches whose section hash differs are opened.
    """
    kind = "array<struct<section:int,paragraph:int>>"

    def places(pair: Column, section: Column) -> Column:
        left, right = pair["a"]["paragraphs"], pair["b"]["paragraphs"]
        lines = F.transform(
            F.arrays_zip(
                F.coalesce(left, F.array().cast("array<string>")).alias("l"),
                F.coalesce(right, F.array().cast("array<string>")).alias("r"),
            ),
            lambda x, i: F.struct(
                section.alias("section"), i.alias("paragraph"), x["l"].eqNullSafe(x["r"]).alias("same")
            ),
        )
        differing = F.transform(
            F.filter(lines, lambda x: ~x["same"]),
            lambda x: F.struct(x["section"].alias("section"), x["paragraph"].alias("paragraph")),
        )
        same = pair["a"]["hash"].eqNullSafe(pair["b"]["hash"])
        return F.when(same, F.array().cast(kind)).otherwise(differing)

    return F.flatten(F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), places))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, head, next_nodes`` of ``doc_id, text`` (not null).

    ``head`` is the beginning of the next document in descending order, half as long as
    the text at most. Whole texts are shuffled once: both joins read the same exchange of
    (key, text), and the second finds it dealt by its own key. What is sent on is a
    beginning and the nodes' hashes.
    """
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.xxhash64("text"))
    keyed = docs.select(key.alias("key"), "text")
    doc_id = F.substring_index("key", ":", 1).try_cast("long").alias("doc_id")
    names = keyed.groupBy("key").agg(F.max(F.length("text")).alias("n")).select("*", doc_id)
    order = [F.col("doc_id").desc_nulls_last(), F.col("key")]
    place = written(ranked(names, [], order, "order").select("key", "n", "rank_"), "places")
    total = max(place.count(), 1)
    # Who gets the beginning of a document: the one before it, the last before the first.
    route = place.select("key", F.expr(f"pmod(rank_ - 1, {total})").alias("to")).join(
        place.select(F.col("rank_").alias("to"), F.col("key").alias("to_key"), "n"), "to"
    )
    sent = (
        keyed.join(route, "key")
        .select(
            F.col("to_key").alias("key"),
            F.expr("substr(text, 1, n div 2)").alias("head"),
            nodes(F.col("text")).alias("next_nodes"),
        )
        .dropDuplicates(["key"])  # equal rows have sent the same
    )
    return keyed.join(sent, "key").select(doc_id, "text", "head", "next_nodes")


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    kept = F.expr("substr(text, 1, length(text) - length(text) div 2)")
    both = with_next(docs).select(
        "doc_id", "text", "next_nodes", F.concat(kept, F.col("head")).alias("edited")
    )
    own, other = F.col("own"), F.col("other")
    changed = F.transform(
        edits(F.col("tree"), F.col("edited_tree")),
        lambda place: F.concat_ws(":", place["section"].cast("string"), place["paragraph"].cast("string")),
    )
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        tree(F.col("text")).alias("tree"),
        tree(F.col("edited")).alias("edited_tree"),
        nodes(F.col("text")).alias("own"),
        nodes(F.col("edited")).alias("other"),
        "next_nodes",
    ).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        root(F.col("tree")).alias("fingerprint"),
        root(F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(own, other).alias("near_edited"),
        likeness(own, F.col("next_nodes")).alias("near_next"),
        F.array_join(changed, ",").alias("edits"),
    )


def _sql() -> str:
    def nodes_of(text: str) -> str:
        parts = {
            "leaf": f"regexp_extract_all({text}, '{LEAF}')",
            "paragraph": f"string_split({text}, chr(10))",
            "section": f"string_split({text}, chr(10) || chr(10))",
        }
        named = [
            f"list_transform(list_filter({v}, lambda x: x <> ''), lambda x: '{k} ' || x)"
            for k, v in parts.items()
        ]
        return f"list_distinct({' || '.join(named)})"

    def fine_of(text: str) -> str:
        runs = f"lambda i: substr(chr(10) || chr(10) || {text}, i, 3)"
        return (
            f"CASE WHEN length({text}) <= {SHORT} THEN"
            f" list_distinct(list_transform(range(1, length({text}) + 1), {runs})) END"
        )

    def near(x: str, y: str) -> str:
        def share(a: str, b: str) -> str:
            return (
                f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE"
                f" ELSE 2.0::DOUBLE * len(list_intersect({a}, {b})) / (len({a}) + len({b})) END"
            )

        return (
            f"CASE WHEN {x}_fine IS NOT NULL AND {y}_fine IS NOT NULL"
            f" THEN {share(x + '_fine', y + '_fine')} ELSE {share(x + '_all', y + '_all')} END"
        )

    def tree_of(text: str) -> str:
        return (
            f"list_transform(string_split({text}, chr(10) || chr(10)),"
            " lambda s: list_transform(string_split(s, chr(10)), lambda p: sha256(p)))"
        )

    def root_of(tree: str) -> str:
        return (
            f"sha256(array_to_string(list_transform({tree},"
            " lambda s: sha256(array_to_string(s, ','))), ','))"
        )

    texts = {"a": "text", "b": "edited", "c": "next"}
    sets = ", ".join(f"{nodes_of(t)} AS {k}_all, {fine_of(t)} AS {k}_fine" for k, t in texts.items())
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), n AS (
  SELECT doc_id, text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next FROM d
  WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), e AS (
  SELECT *, substr(text, 1, length(text) - length(text) // 2)
    || substr(next, 1, length(text) // 2) AS edited FROM n
), l AS (
  SELECT *, {tree_of("text")} AS t, {tree_of("edited")} AS u, {sets} FROM e
)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256,
  {root_of("t")} AS fingerprint, {root_of("u")} AS edited_fingerprint,
  {near("a", "b")} AS near_edited, {near("a", "c")} AS near_next,
  coalesce(array_to_string(flatten(list_transform(range(0, greatest(len(t), len(u))), lambda i:
    CASE WHEN t[i + 1] IS NOT DISTINCT FROM u[i + 1] THEN [] ELSE
      list_transform(list_filter(range(0, greatest(coalesce(len(t[i + 1]), 0), coalesce(len(u[i + 1]), 0))),
        lambda j: t[i + 1][j + 1] IS DISTINCT FROM u[i + 1][j + 1]),
        lambda j: i || ':' || j) END)), ','), '') AS edits
FROM l
"""


QUERIES = {"op4_merkle_fingerprints": _query}
ORACLES = {"op4_merkle_fingerprints": _sql()}
