"""Packing token pieces into fixed windows by non-negative least squares.

1. Every text is tokenised once; a document (its ids and an end id) is cut at multiples
   of the window. Only piece lengths and checksums go on.
2. The histogram of lengths (at most ``window`` rows) comes to the driver. Lengths are
   rounded up to units; all combinations of up to three units that fill the window
   exactly are the strategies. Non-negative least squares finds how often each is used,
   which is rounded down.
3. What the strategies leave over, and the gaps in them, are filled greedily: the
   largest length that fits comes next. A pattern is repeated while its lengths last,
   so the plan's size depends on the window, never on the number of pieces.
4. Pieces are ranked within their length by a distributed sort; rank and plan give each
   its sequence and offset.

Defined results: a null text is empty and has the end id only; equal rows are packed one
by one; ``doc_id`` may be null or repeated; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.arrow_tasks import text_steps
from pressmill.llm.common import ranked, table
from pressmill.llm.speculative_bpe import default_path
from pressmill.session import written

WINDOW = 2048
#: Lengths are rounded up to multiples of this in the least squares.
UNIT = 16
END_ID = 1
#: A special token of the file, and how many chunks or words are joined in one call.
SPECIAL_ID, JOINED = 49_407, 500
#: Chunks and words of one generation; a worker remembers the current and the last one.
ENTRIES = 300_000
#: Longer ones (unbroken text) are encoded each time.
LONGEST = 48
#: Bytes of text of one vectorised step.
STEP_BYTES = 8_000_000
WORD_END = "</w>"
#: White space, the letters and numbers up to U+00FF, and the tokenizer file's pattern of words.
_WIDE = "[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_WHITE = f"[\t-\r {_WIDE[1:-1]}]+"
_LETTERS, _NUMBERS = "a-zA-ZªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+")

Pattern = tuple[tuple[int, ...], int]


def _simple(chunk: str) -> bool:
    """Whether the pattern above splits it as the library does: no special token, no character
    that combines with another."""
    if "<|" in chunk:
        return False
    try:
        chunk.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Library:
    """The library's ids of whole texts, through those of their distinct words.

    No token reaches across white space, so Arrow splits texts there and codes the chunks;
    simple chunks are split on into words, and only new words go to the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(WORD_END)]] = True
        # A special token between chunks keeps them apart, so many are encoded at once.
        self.mark = self.tokenizer.id_to_token(SPECIAL_ID)
        self.known: dict[str, bytes] = {}
        self.last: dict[str, bytes] = {}

    def _joined(self, parts: list[str], between: str) -> Iterator[np.ndarray]:
        texts = [between.join(parts[i : i + JOINED]) for i in range(0, len(parts), JOINED)]
        for done in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(done.ids, "<u4")

    def _learned(self, words: list[str]) -> dict[str, bytes]:
        """The last token of a word, and no other, carries the end of the word."""
        out: list[bytes] = []
        for ids in self._joined(words, " "):
            cuts, raw = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist(), ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *cuts], cuts)]
        return dict(zip(words, out, strict=True))

    def _by_words(self, chunks: list[str]) -> list[bytes]:
        if len(self.known) > ENTRIES:
            self.known, self.last = {}, self.known
        known, last = self.known, self.last
        new = [c for c in chunks if c not in known]
        again = [c for c in new if c in last]
        known.update((c, last[c]) for c in again)
        new = [c for c in new if c not in known]
        split = [_WORDS.findall(c.lower()) for c in new]
        words = set().union(*split).difference(known) if split else set()
        known.update(self._learned(list(words)))
        known.update(zip(new, [b"".join(map(known.__getitem__, parts)) for parts in split]))
        out = list(map(known.__getitem__, chunks))
        for long in [x for x in words.union(new) if len(x) > LONGEST]:
            del known[long]
        return out

    def _by_chunks(self, chunks: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for ids in self._joined(chunks, self.mark):
            cuts, raw = np.flatnonzero(ids == SPECIAL_ID) * 4, ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *(cuts + 4)], [*cuts, len(raw)], strict=True)]
        return out

    def chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks, as little-endian 32-bit bytes."""
        simple = [c for c in chunks if _simple(c)]
        found = dict(zip(simple, self._by_words(simple), strict=True))
        other = [c for c in chunks if c not in found]
        plain = [c for c in other if "<|" not in c]
        found.update(zip(plain, self._by_chunks(plain), strict=True))
        rest = [c for c in other if "<|" in c]
        for chunk, done in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            found[chunk] = np.array(done.ids, "<u4").tobytes()
        return [found[c] for c in chunks]

    def texts(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        # Lower case, as the tokenizer has it, where each character stands alone.
        plain = pa.array([t.lower() if _simple(t) else t for t in texts], pa.string())
        if pc.any(pc.match_substring_regex(plain, _WIDE)).as_py():
            split = pc.split_pattern_regex(plain, _WHITE)
        else:
            split = pc.ascii_split_whitespace(plain)  # the same there, and much faster
        coded = split.flatten().dictionary_encode()
        ids = self.chunk_ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
        flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat).take(coded.indices)
        raw = lists.flatten().to_numpy().tobytes()
        bounds = lists.offsets.to_numpy()[split.offsets.to_numpy()].tolist()
        for a, b in zip(bounds, bounds[1:]):
            yield raw[4 * a : 4 * b]


@lru_cache(maxsize=2)
def _library(path: str) -> Library:
    return Library(path)


def cut(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``: the pieces of every document."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _library(path or default_path())
        end = END_ID.to_bytes(4, "little")
        for batch in text_steps(batches, 1, STEP_BYTES):
            texts = batch.column(1).to_pylist()
            rows, starts, lengths, sums, totals = [], [], [], [], []
            for row, ids in enumerate(encoder.texts(texts)):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(total)
            columns = [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]
            owner = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([owner, *columns], names)

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).mapInArrow(
        run, ", ".join(f"{n} long" for n in names)
    )


def strategies(units: int) -> list[tuple[int, ...]]:
    """All multisets of one to three units that sum to ``units``."""
    out: list[tuple[int, ...]] = [(units,)]
    out += [(units - b, b) for b in range(1, units // 2 + 1)]
    out += [
        (units - b - c, b, c)
        for c in range(1, units // 3 + 1)
        for b in range(c, (units - c) // 2 + 1)
    ]
    return out


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-8) -> np.ndarray:
    """x >= 0 that minimises |ax - b|, by an active set on the normal equations."""
    gram, target = a.T @ a, a.T @ b
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    limit = tolerance * max(1.0, float(np.abs(target).max()))
    for _ in range(3 * a.shape[0]):
        slope = np.where(active, -np.inf, target - gram @ x)
        if active.all() or slope.max() <= limit:
            break
        active[slope.argmax()] = True
        while True:
            at = np.flatnonzero(active)
            part = gram[np.ix_(at, at)] + 1e-9 * np.eye(len(at))  # strategies may depend
            best = np.linalg.solve(part, target[at])
            if best.min() > 0:
                x[:] = 0
                x[at] = best
                break
            low = best <= 0
            step = np.min(x[at][low] / np.maximum(x[at][low] - best[low], 1e-300))
            x[at] += step * (best - x[at])
            gone = at[low & (x[at] <= limit * 1e-3 + 1e-12)]
            if not len(gone):
                gone = at[[np.where(low, x[at], np.inf).argmin()]]
            active[gone], x[gone] = False, 0
            if not active.any():
                break
    return x


def plan(histogram: dict[int, int], window: int = WINDOW, unit: int = UNIT) -> list[Pattern]:
    """Patterns of exact lengths and how often each is repeated; all pieces are in one."""
    left = dict(histogram)
    units = window // unit
    bins: dict[int, list[int]] = {}
    for length in sorted(left, reverse=True):
        bins.setdefault(-(-length // unit), []).append(length)
    wanted = np.array([sum(left[x] for x in bins.get(u + 1, ())) for u in range(units)], float)
    shapes = strategies(units)
    a = np.zeros((units, len(shapes)))
    for k, shape in enumerate(shapes):
        for u in shape:
            a[u - 1, k] += 1
    repeats = np.floor(nnls(a, wanted) + 1e-6).astype(np.int64)

    opened: list[Pattern] = []
    for k in np.argsort(-repeats, kind="stable"):
        shape = shapes[k]
        rest = {u: sum(left[x] for x in bins.get(u, ())) for u in shape}
        times = min(int(repeats[k]), *(rest[u] // shape.count(u) for u in set(shape)))
        if times <= 0:
            continue
        runs = [_take(left, bins[u], times) for u in shape]
        opened += _zipped(runs)
    return _fill(opened, left, window)


def _take(left: dict[int, int], lengths: list[int], times: int) -> list[list[int]]:
    """``times`` pieces of a bin, longest first, as [length, count] runs."""
    out = []
    for length in lengths:
        n = min(times, left[length])
        if n:
            out.append([length, n])
            left[length] -= n
            times -= n
    return out


def _zipped(runs: list[list[list[int]]]) -> list[Pattern]:
    # The first slot from its longest on, the others from their shortest.
    runs = [list(run) if i else list(reversed(run)) for i, run in enumerate(runs)]
    out = []
    while runs[0]:
        n = min(run[-1][1] for run in runs)
        out.append((tuple(run[-1][0] for run in runs), n))
        for run in runs:
            run[-1][1] -= n
            if not run[-1][1]:
                run.pop()
    return out


def _fill(opened: list[Pattern], left: dict[int, int], window: int) -> list[Pattern]:
    """Greedy: the largest remaining length that fits comes next."""
    lengths = sorted((x for x, n in left.items() if n), reverse=True)
    done = []
    todo = sorted(opened, key=lambda p: sum(p[0]))  # the widest gap last, so first out
    todo.reverse()
    while todo or lengths:
        shape, times = todo.pop() if todo else ((), None)
        gap, uses = window - sum(shape), {}
        grown = list(shape)
        for length in lengths:
            if length > gap:
                continue
            n = min(gap // length, left[length])
            grown += [length] * n
            uses[length] = n
            gap -= n * length
            if not gap:
                break
        if not uses:
            done.append((shape, times))
            continue
        fits = min(left[x] // n for x, n in uses.items())
        if times is None:
            times = fits
        elif fits < times:
            todo.append((shape, times - fits))
            times = fits
        for x, n in uses.items():
            left[x] -= n * times
        lengths = [x for x in lengths if left[x]]
        done.append((tuple(grown), times))
    return done


def _slots(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Rows (length, first rank, uses, first sequence, offset), by length and rank."""
    rows, used, sequence = [], {}, 0
    for shape, times in patterns:
        offset = 0
        for length in dict.fromkeys(shape):
            uses = shape.count(length)
            rows.append((length, used.get(length, 0), uses, sequence, offset))
            used[length] = used.get(length, 0) + uses * times
            offset += uses * length
        sequence += times
    rows.sort()
    columns = np.array(rows or np.empty((0, 5)), np.int64).T
    return dict(zip(("length", "rank", "uses", "sequence", "offset"), columns, strict=True))


def pack(pieces: DataFrame, window: int = WINDOW, unit: int = UNIT) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; a piece is at most a window long."""
    counts = pieces.groupBy("length").count().collect()  # at most one row for each length
    slots = _slots(plan({r["length"]: r["count"] for r in counts}, window, unit))
    order = [F.col(c) for c in pieces.columns if c != "length"]  # tells unequal rows apart
    numbered = ranked(pieces, ["length"], order, "packing")
    given = pieces.columns
    names = [*given, "sequence_id", "offset"]
    # One sorted key for (length, rank): ranks stay far below 2^48.
    keys = slots["length"] * 2**48 + slots["rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank_").to_numpy()
            at = np.searchsorted(keys, length * 2**48 + rank, side="right") - 1
            nth, uses = rank - slots["rank"][at], slots["uses"][at]
            sequence = slots["sequence"][at] + nth // uses
            offset = slots["offset"][at] + nth % uses * length
            kept = [batch.column(n) for n in given]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names
            )

    kinds = ", ".join(f"`{n}` {k}" for n, k in pieces.dtypes)
    return numbered.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame) -> DataFrame:
    return pack(written(cut(docs), "pieces"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: the pieces of all documents with their places."""
    return pack_documents(docs)


QUERIES = {
    "op9_nnls_packing": lambda spark, sf_dir: pack_documents(table(spark, sf_dir, "documents"))
}
ORACLES: dict[str, str] = {}
