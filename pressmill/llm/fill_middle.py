"""Fill-in-middle transformation with a Fenwick tree over blocks of text.

Units are runs of ASCII letters and all other single code points. Texts are cut into
blocks of ``BLOCK`` bytes; a Fenwick tree over the blocks of an Arrow batch holds their
counts of unit starts and of code points. Descending it by binary lifting finds, for all
cuts of the batch at once, the block that holds a cut's unit and the code points before
that block; the cut itself is then located within this one block. A text's units are
never listed.

Defined results: a null text is empty and plain; a null ``doc_id`` is hashed as the empty
string; rows with one ``doc_id`` and text give equal rows; columns other than ``doc_id``
and ``text`` are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.arrow_tasks import text_bytes, text_steps
from pressmill.llm.common import table

BLOCK = 4096
#: Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class Fenwick:
    """Prefix sums of several counters over the same blocks."""

    def __init__(self, *counters: np.ndarray):
        self.size = len(counters[0])
        self.trees = [np.concatenate([[0], c]).astype(np.int64) for c in counters]
        step = 1
        while 2 * step <= self.size:
            at = np.arange(2 * step, self.size + 1, 2 * step)
            for tree in self.trees:
                tree[at] += tree[at - step]
            step *= 2

    def descend(self, wanted: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The most blocks whose first counters sum to ``wanted`` at most, and all their sums."""
        at = np.zeros(len(wanted), np.int64)
        sums = [np.zeros(len(wanted), np.int64) for _ in self.trees]
        step = 1 << max(self.size, 1).bit_length()
        while step:
            next_at = np.minimum(at + step, self.size)
            fits = (at + step <= self.size) & (sums[0] + self.trees[0][next_at] <= wanted)
            for total, tree in zip(sums, self.trees, strict=True):
                total[fits] += tree[next_at[fits]]
            at[fits] += step
            step >>= 1
        return at, sums


@dataclass
class Blocks:
    """Unit starts of texts laid end to end, counted by block."""

    data: np.ndarray
    ends: np.ndarray  # of the texts, from 0

    def __post_init__(self):
        data, ends = self.data, self.ends
        letter = ((data | 32) - np.uint8(97)) < 26
        self.points = (data & 0xC0) != 0x80
        joined = np.zeros(len(data), bool)
        joined[1:] = letter[1:] & letter[:-1]
        first = ends[:-1]
        joined[first[first < len(data)]] = False  # a text begins with a unit
        self.units = self.points & ~joined
        sizes = np.diff(ends)
        blocks = -(-sizes // BLOCK)
        self.owner = np.repeat(np.arange(len(sizes)), blocks)
        nth = np.arange(len(self.owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        self.starts = first[self.owner] + nth * BLOCK
        counted = [
            np.add.reduceat(flags.astype(np.int64), self.starts) if len(self.starts) else sizes[:0]
            for flags in (self.units, self.points)
        ]
        self.counts = [
            np.bincount(self.owner, c, len(sizes)).astype(np.int64) for c in counted
        ]  # units and code points of each text
        self.tree = Fenwick(*counted)

    def locate(self, text: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte offset, from 0 over all texts, and code points of ``text`` before its unit ``after``."""
        units, points = (np.cumsum(c) - c for c in self.counts)
        wanted = units[text] + after
        block, (done, before) = self.tree.descend(wanted)
        bytes_at, points_at = np.empty_like(wanted), before - points[text]
        for i, (b, rest) in enumerate(zip(block.tolist(), (wanted - done).tolist())):
            if b == len(self.starts):
                bytes_at[i] = len(self.data)
                continue
            start = int(self.starts[b])
            place = np.flatnonzero(self.units[start : start + BLOCK])[rest]
            bytes_at[i] = start + place
            points_at[i] += np.count_nonzero(self.points[start : start + place])
        return bytes_at, points_at


def numbers_of(doc_id: int | None, seed: int) -> list[int]:
    """The first four 32-bit numbers of the hash that decides cuts and form."""
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def fill_in_middle(
    docs: DataFrame, seed: int = 1, rate: int = 90, suffix_first: int = 20
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every whole text.

    ``rate`` percent of the documents are transformed, ``suffix_first`` percent of these
    with the suffix in front (``spm``).
    """
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    prefix, suffix, middle = marks
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches, 1):
            data, ends = text_bytes(batch.column(1))
            blocks = Blocks(data, ends)
            ids = batch.column(0).to_pylist()
            n = blocks.counts[0]
            drawn = np.array([numbers_of(i, seed) for i in ids], np.int64).reshape(-1, 4)
            cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
            text = np.arange(len(ids))
            at, points = blocks.locate(np.repeat(text, 2), cuts.ravel())
            raw, rows = data.tobytes(), []
            for i, doc_id in enumerate(ids):
                start, end = int(ends[i]), int(ends[i + 1])
                whole = raw[start:end]
                if not whole or drawn[i, 2] % 100 >= rate or any(m in whole for m in marks):
                    rows.append((doc_id, int(n[i]), "plain", None, None, whole))
                    continue
                a, b = int(at[2 * i]) - start, int(at[2 * i + 1]) - start
                p, m, s = whole[:a], whole[a:b], whole[b:]
                spm = drawn[i, 3] % 100 < suffix_first
                out = [suffix, s, prefix, p] if spm else [prefix, p, suffix, s]
                sizes = int(points[2 * i]), int(points[2 * i + 1] - points[2 * i])
                form = "spm" if spm else "psm"
                rows.append((doc_id, int(n[i]), form, *sizes, b"".join([*out, middle, m])))
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).mapInArrow(
        run,
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restore(output: Column, form: Column) -> Column:
    """The text an output was made of. No mark can begin within a part, so the first one ends it."""

    def parts(second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))
        one = F.substring_index(body, second, 1)
        tail = F.substring(body, F.length(one) + len(second) + 1, F.length(body))
        two = F.substring_index(tail, MIDDLE, 1)
        return one, two, F.substring(tail, F.length(two) + len(MIDDLE) + 1, F.length(tail))

    p, s, m = parts(SUFFIX)
    s2, p2, m2 = parts(PREFIX)
    return (
        F.when(form == "psm", F.concat(p, m, s))
        .when(form == "spm", F.concat(p2, m2, s2))
        .otherwise(output)
    )


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
    ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d
), c AS (
  SELECT *, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
    greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (
  SELECT doc_id, text, len(units) AS n, form, array_to_string(units[1:a], '') AS pre,
    array_to_string(units[a + 1:b], '') AS mid, array_to_string(units[b + 1:], '') AS suf FROM c
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

QUERIES = {"op13_fill_middle": _query}
ORACLES = {"op13_fill_middle": _SQL}
