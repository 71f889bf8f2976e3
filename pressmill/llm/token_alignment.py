"""Cross-tokenizer alignment as a monoid of fragments.

A byte range of a document gives a fragment: the tokens of both tokenizers that end in
the range, as an open prefix up to the first offset where both end a token, closed groups
between such offsets, and an open suffix. Fragments of adjacent ranges compose by closing
the left suffix with the right prefix; that is associative, and the empty fragment is
neutral. Documents of up to ``chunk`` code points are one fragment. Longer ones are cut
into ranges of that size, dealt over Spark tasks and composed by a tree of ``FAN``
fragments a node.

A range's tokens are found without the rest of the document: its text is widened to the
next places where a single space stands between other characters. No token of either
vocabulary reaches across such a place (checked for the second on loading, fixed by the
word pattern of the first). A text without such places is one range.

Two tokens that end together are linked. Then one is a suffix of the other, so there are
at most as many pairs of ids as the two vocabularies have bytes (some half a million for
the given files, whatever the corpus): the table of their counts is broadcast.

Defined results: texts that are null, empty or not reproduced by both tokenizers (a
literal U+2581, say) have no tokens, zeros and an empty ``groups``; a changed text only
ever becomes shorter, so ranges tell it as well as the whole; each row is a document, also
where ``doc_id`` is null or repeated; columns other than ``doc_id`` and ``text`` are not
read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressmill.llm.arrow_tasks import text_steps
from pressmill.llm.common import parts_of, table
from pressmill.llm.speculative_bpe import _byte_chars
from pressmill.session import written

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Code points of a range, fragments of a tree node, how far back a safe place is sought.
CHUNK, FAN, BACK = 65_536, 8, 1024
#: Ids of the second tokenizer are below this, so a pair of ids is one number.
IDS = 2**20
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_SPACE = "▁"


@dataclass
class Fragment:
    """``cut`` tells whether the range holds an offset where both end a token; without one
    all tokens are in the prefix. ``pairs`` and ``times`` are the linked ids and how often."""

    ok: bool
    n_a: int
    n_b: int
    n_groups: int
    cut: bool
    head_a: list[int]
    head_b: list[int]
    closed: str
    tail_a: list[int]
    tail_b: list[int]
    pairs: list[int]
    times: list[int]


NEUTRAL = Fragment(True, 0, 0, 0, False, [], [], "", [], [], [], [])


def _group(a: list[int], b: list[int]) -> str:
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b))


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two adjacent ranges."""
    head_a, head_b, closed, tail_a, tail_b = x.head_a, x.head_b, x.closed, x.tail_a, x.tail_b
    if not x.cut:
        head_a, head_b = head_a + y.head_a, head_b + y.head_b
        closed, tail_a, tail_b = y.closed, y.tail_a, y.tail_b
    elif not y.cut:
        tail_a, tail_b = tail_a + y.head_a, tail_b + y.head_b
    else:
        middle = _group(tail_a + y.head_a, tail_b + y.head_b)
        closed = ";".join(part for part in (closed, middle, y.closed) if part)
        tail_a, tail_b = y.tail_a, y.tail_b
    return Fragment(
        x.ok and y.ok,
        x.n_a + y.n_a,
        x.n_b + y.n_b,
        x.n_groups + y.n_groups,
        x.cut or y.cut,
        head_a,
        head_b,
        closed,
        tail_a,
        tail_b,
        x.pairs + y.pairs,
        x.times + y.times,
    )


def groups_of(whole: Fragment) -> str:
    """All groups of a whole document; both tokenizers end with it."""
    if not whole.cut:
        return ""
    first = _group(whole.head_a, whole.head_b)
    return f"{first};{whole.closed}" if whole.closed else first


class Tokenizers:
    """Both tokenizers of a worker, with the bytes of all their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as f:
            model = json.load(f)
        special = {t["content"] for t in model["added_tokens"]}
        byte_of = {c: i for i, c in enumerate(_byte_chars())}
        ranks = {
            bytes(byte_of[c] for c in token): i
            for token, i in model["model"]["vocab"].items()
            if token not in special
        }
        # The file's merges stand in the order of the ids they make, so ids are ranks.
        self.a = tiktoken.Encoding(
            "a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        names = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            names[i] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if len(pieces) > IDS or any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in pieces):
            raise ValueError("a piece of the second tokenizer reaches across a space")
        pieces = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.bytes = [pa.array(names, pa.binary()), pa.array(pieces, pa.binary())]
        self.sizes = [np.array([len(t) for t in x], np.int64) for x in (names, pieces)]
        # Each id with each mark that can follow it in the text of groups.
        self.kinds = [len(names), len(names), len(pieces), len(pieces)]
        ids = [i for n in (len(names), len(names), len(pieces), len(pieces)) for i in range(n)]
        marks = np.repeat([",", "|", ",", ";"], self.kinds).tolist()
        self.text = pa.array([f"{i}{m}" for i, m in zip(ids, marks, strict=True)])

    def _joined(self, side: int, ids: np.ndarray) -> pa.Buffer | bytes:
        return self.bytes[side].take(pa.array(ids)).buffers()[2] or b""

    def encode(self, spaced: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """Ids of both for texts that begin with a space, and whether both give them back."""
        second = self.b.encode([s[1:] for s in spaced], num_threads=1)
        for text, b in zip(spaced, second, strict=True):
            a = self.a.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
            b, raw = np.array(b, np.int64), text.encode()
            ok = all(
                int(size[ids].sum()) == len(raw) and bytes(self._joined(side, ids)) == raw
                for side, (ids, size) in enumerate(zip((a, b), self.sizes))
            )
            yield a, b, ok

    def _closed(self, a: np.ndarray, last_a: np.ndarray, b: np.ndarray, last_b: np.ndarray) -> str:
        """The text of whole groups; ``last_*`` mark the last token of each group."""
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        ends_a, ends_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        out = np.empty(len(a) + len(b), np.int64)
        starts_b = np.r_[0, ends_b[:-1]]
        first_b = self.kinds[0] + self.kinds[1]
        out[np.arange(len(a)) + starts_b[group_a]] = a + last_a * self.kinds[0]
        out[np.arange(len(b)) + ends_a[group_b]] = first_b + b + last_b * self.kinds[2]
        return bytes(self.text.take(pa.array(out)).buffers()[2])[:-1].decode()

    def fragment(self, a: np.ndarray, b: np.ndarray, low: int, high: int) -> Fragment:
        """The fragment of the tokens that end in (``low``, ``high``] of their text."""
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        in_a = slice(*np.searchsorted(ends_a, [low, high], side="right"))
        in_b = slice(*np.searchsorted(ends_b, [low, high], side="right"))
        a, ends_a, b, ends_b = a[in_a], ends_a[in_a], b[in_b], ends_b[in_b]
        both = np.zeros(max(high - low, 0) + 1, np.int8)
        both[ends_a - low] = 1
        both[ends_b - low] += 1
        last_a, last_b = both[ends_a - low] == 2, both[ends_b - low] == 2
        at_a, at_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        if not len(at_a):
            return Fragment(
                True, len(a), len(b), 0, False, a.tolist(), b.tolist(), "", [], [], [], []
            )
        closed = ""
        if len(at_a) > 1:
            span_a, span_b = slice(at_a[0], at_a[-1]), slice(at_b[0], at_b[-1])
            closed = self._closed(a[span_a], last_a[span_a], b[span_b], last_b[span_b])
        pairs, times = np.unique(a[last_a] * IDS + b[last_b], return_counts=True)
        return Fragment(
            True,
            len(a),
            len(b),
            len(at_a),
            True,
            a[: at_a[0]].tolist(),
            b[: at_b[0]].tolist(),
            closed,
            a[at_a[-1] :].tolist(),
            b[at_b[-1] :].tolist(),
            pairs.tolist(),
            times.tolist(),
        )


@lru_cache(maxsize=1)
def _tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(FILE_A), public_tokenizers.path(FILE_B)


def ranges(spaced: str, chunk: int = CHUNK) -> Iterator[tuple[str, int, int]]:
    """Texts around the ranges of ``spaced``, with the bytes where the range begins and ends.

    A range ends after ``chunk`` code points, or at the next safe place where none lies
    shortly before that.
    """
    low = wide_low = 0
    while wide_low < len(spaced):
        high = low + chunk
        after = _SAFE.search(spaced, high)
        wide_high = after.start() if after else len(spaced)
        back = [m.start() for m in _SAFE.finditer(spaced, max(high - BACK, wide_low + 1), high + 1)]
        if high >= len(spaced) or not back or not after or wide_high - high > chunk:
            high, next_wide = wide_high, wide_high
        else:
            next_wide = back[-1]
        piece = spaced[wide_low:wide_high]
        start = len(spaced[wide_low:low].encode())
        yield piece, start, start + len(spaced[low:high].encode())
        low, wide_low = high, next_wide


_FRAGMENT = (
    "row long, doc_id long, part int, ok boolean, n_a long, n_b long, n_groups long, cut boolean, "
    "head_a array<int>, head_b array<int>, closed string, tail_a array<int>, tail_b array<int>, "
    "pairs array<long>, times array<long>"
)
_ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, groups string, pairs array<long>, "
    "times array<long>"
)
_LISTS = {f"{x}_{s}": pa.list_(pa.int32()) for x in ("head", "tail") for s in "ab"}
_ARROW = {
    "row": pa.int64(), "doc_id": pa.int64(), "part": pa.int32(), "ok": pa.bool_(), "n_a": pa.int64(),
    "n_b": pa.int64(), "n_groups": pa.int64(), "cut": pa.bool_(), "head_a": _LISTS["head_a"],
    "head_b": _LISTS["head_b"], "closed": pa.string(), "tail_a": _LISTS["tail_a"],
    "tail_b": _LISTS["tail_b"], "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int64()),
    "groups": pa.string(),
}


def _batch(rows: list[dict], kinds: str) -> pa.RecordBatch:
    names = [k.split()[0] for k in kinds.split(", ")]
    arrays = [pa.array([r[n] for r in rows], _ARROW[n]) for n in names]
    return pa.RecordBatch.from_arrays(arrays, names)


def _whole(doc_id: int | None, f: Fragment) -> dict:
    if not f.ok:
        f = NEUTRAL
    return vars(f) | {"doc_id": doc_id, "groups": groups_of(f)}


def _cut_long(docs: DataFrame, chunk: int) -> DataFrame:
    """``row, doc_id, part, piece, low, high``: the ranges of long texts."""
    names = ["row", "doc_id", "part", "piece", "low", "high"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches, 2, 1):  # one document at a time
            row, doc_id, text = (c[0].as_py() for c in batch.columns)
            for part, (piece, low, high) in enumerate(ranges(" " + text, chunk)):
                values = (row, doc_id, part, piece, low, high)
                arrays = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(F.monotonically_increasing_id(), "doc_id", "text")
    return rows.mapInArrow(run, "row long, doc_id long, part int, piece string, low long, high long")


def _reduced(parts: DataFrame) -> DataFrame:
    """One fragment for each row: levels of a tree, each composing ``FAN`` neighbours."""

    def node(group: pa.Table) -> pa.Table:
        found = sorted(group.to_pylist(), key=lambda r: r["part"])
        fields = list(vars(NEUTRAL))
        whole = reduce(compose, [Fragment(**{n: r[n] for n in fields}) for r in found], NEUTRAL)
        first = {n: found[0][n] for n in ("row", "doc_id")} | {"part": found[0]["part"] // FAN}
        return pa.Table.from_batches([_batch([vars(whole) | first], _FRAGMENT)])

    last = parts.agg(F.max("part")).first()[0] or 0
    while last > 0:
        level = F.expr(f"part div {FAN}").alias("node")
        parts = written(parts.groupBy("row", level).applyInArrow(node, _FRAGMENT), "alignment_level")
        last //= FAN
    return parts


def align(docs: DataFrame, paths: tuple[str, str] | None = None, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, groups, pairs, times`` of every whole text.

    ``pairs`` are the distinct linked ids (the first's times ``IDS`` plus the second's) and
    ``times`` how often the document links them; a long document may list a pair again.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    is_long = F.char_length("text") > chunk

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(*(paths or default_paths()))
        for batch in text_steps(batches, 1, 1_000_000):
            ids, texts = (c.to_pylist() for c in batch.columns)
            spaced = [" " + t for t in texts]
            out = []
            for doc_id, text, (a, b, ok) in zip(ids, spaced, both.encode(spaced), strict=True):
                usable = ok and len(text) > 1
                found = both.fragment(a, b, 0, len(text.encode())) if usable else NEUTRAL
                out.append(_whole(doc_id, found))
            yield _batch(out, _ALIGNED)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(*(paths or default_paths()))
        for batch in text_steps(batches, 3, 1_000_000):
            given = batch.to_pylist()
            out = []
            for r, (a, b, ok) in zip(given, both.encode([r["piece"] for r in given]), strict=True):
                found = vars(both.fragment(a, b, r["low"], r["high"]) if ok else NEUTRAL)
                out.append(found | {n: r[n] for n in ("row", "doc_id", "part")} | {"ok": ok})
            yield _batch(out, _FRAGMENT)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = list(vars(NEUTRAL))
        for batch in batches:
            for r in batch.to_pylist():
                yield _batch([_whole(r["doc_id"], Fragment(**{n: r[n] for n in fields}))], _ALIGNED)

    short = rows.where(~is_long).mapInArrow(whole, _ALIGNED)
    cut = written(_cut_long(rows.where(is_long), chunk), "alignment_ranges")
    dealt = cut.repartition(parts_of(docs.sparkSession), "row", "part")
    parts = written(dealt.mapInArrow(part, _FRAGMENT), "alignment_parts")
    return short.unionByName(_reduced(parts).mapInArrow(finish, _ALIGNED))


def link_counts(aligned: DataFrame) -> DataFrame:
    """``pair, count, best``: links of each pair of ids, and the most that its second id has."""
    links = aligned.select(F.inline(F.arrays_zip("pairs", "times"))).toDF("pair", "times")
    counts = links.groupBy("pair").agg(F.sum("times").alias("count"))
    second = Window.partitionBy(F.col("pair") % IDS)
    return counts.withColumn("best", F.max("count").over(second))


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    fixed = written(
        aligned.withColumn("groups_sha256", digest)
        .withColumn("row", F.monotonically_increasing_id())
        .drop("groups"),
        "alignment",
    )
    counts = F.broadcast(link_counts(fixed))  # bounded by the vocabularies
    links = fixed.select("row", F.inline(F.arrays_zip("pairs", "times"))).toDF("row", "pair", "times")
    scores = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("count") == F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("count") * F.col("times")).alias("count_sum"),
    )
    return fixed.join(scores, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),  # tokens have bytes, so one pair ends each group
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        "groups_sha256",
    )


QUERIES = {"op11_token_alignment": _query}
ORACLES: dict[str, str] = {}
