"""BPE encoding and decoding by speculating and verifying.

For each distinct word, greedy longest match proposes tokens. A proposal is the right
encoding exactly if every adjacent pair of tokens is compatible, that is, if merging
the text of the two alone gives the two again. All pairs of all words of a step are
tested at once with numpy, by undoing merges at the border between the two tokens.
Only words with a failing pair are merged exactly.

Defined results: a null text is empty and has no ids; ids decode as the tokens joined
by one space, as the library does for a file without a decoder; special tokens' strings
in a text are those tokens; repeated rows stay; further columns are not read, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
import regex
import unicodedata

from pressmill.llm.chunk_ids import CACHE_ENTRIES, ChunkEncoder, id_lists, steps
from pressmill.llm.common import table

WORD_END = "</w>"
FILE = "word_bpe_49k.json"
#: The tokenizer file's pattern of words.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Up to here no character combines with another, and lower case needs no context.
_PLAIN = regex.compile("[\0-ɏ]*")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(FILE)


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Exact encoder of one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.vocab: dict[str, int] = model["model"]["vocab"]
        self.library = Tokenizer.from_file(path)  # normalises and splits unusual scripts
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.chars = _byte_chars()
        self.longest = max(map(len, self.vocab))
        size = len(self.vocab)
        self.rank_of: dict[tuple[int, int], tuple[int, int]] = {}
        self.born = np.full(size, -1, np.int64)  # the merge that makes a token
        self.left, self.right = np.arange(size), np.arange(size)
        for rank, (a, b) in enumerate(model["model"]["merges"]):
            x, y, made = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.rank_of[x, y] = rank, made
            self.born[made], self.left[made], self.right[made] = rank, x, y
        self.size = size
        pairs = np.array([x * size + y for x, y in self.rank_of], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], order
        merged = np.flatnonzero(self.born >= 0)
        self.reachable = np.ones(size, bool)
        self.reachable[merged] = self._apart(
            self.left[merged], self.right[merged], self.born[merged]
        )
        self.words: dict[str, bytes] = {}

    def tokens(self) -> pa.Array:
        """The tokens by id."""
        return _by_id(self.vocab | self.special)

    # Compatibility of adjacent tokens

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merge of each pair, or the number of merges where there is none."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.ranks[at], len(self.pairs))

    def _apart(self, a: np.ndarray, b: np.ndarray, until: np.ndarray) -> np.ndarray:
        """Whether no merge before ``until`` joins each pair of tokens across its border.

        Walks back in time: ``until`` is the earliest undone merge on either side. The
        tokens that touch at the border then existed together, and a merge of the two
        that comes earlier would have joined them. On equal ranks the left one is first.
        """
        a, b, until = a.copy(), b.copy(), until * 2  # times two: a tie's order fits in
        apart = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            joined = 2 * self._rank(x, y) < until[live]
            apart[live[joined]] = False
            live, x, y = live[~joined], x[~joined], y[~joined]
            bx, by = self.born[x], self.born[y]
            live, x, y, bx, by = (v[(bx >= 0) | (by >= 0)] for v in (live, x, y, bx, by))
            undo_left = bx > by  # the younger of the two; on a tie the right one, made last
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
            # A pair right of the border is merged after the border's own of equal rank.
            until[live] = np.where(undo_left, 2 * bx, 2 * by + 1)
        return apart

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        never = np.full(len(a), len(self.pairs), np.int64)
        return self._apart(a, b, never) & self.reachable[a] & self.reachable[b]

    # Words

    def _propose(self, word: str) -> list[int]:
        """Greedy longest match."""
        vocab, n, at, out = self.vocab, len(word), 0, []
        while at < n:
            end = min(n, at + self.longest)
            if end == n:
                token = vocab.get(word[at:] + WORD_END)
                if token is not None:
                    out.append(token)
                    break
                end -= 1
            while (token := vocab.get(word[at:end])) is None:
                end -= 1
            out.append(token)
            at = end
        return out

    def _merge(self, word: str) -> list[int]:
        """Exact merging, in n log n steps."""
        vocab, rank_of = self.vocab, self.rank_of
        ids = [vocab[c] for c in word[:-1]] + [vocab[word[-1] + WORD_END]]
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(rank_of[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rank_of]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or (found := rank_of.get((ids[i], ids[j]))) is None:
                continue
            if found[0] != rank:
                continue
            ids[i], ids[j], after[i] = found[1], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
                if (new := rank_of.get((ids[i], ids[after[i]]))) is not None:
                    heapq.heappush(heap, (new[0], i))
            if before[i] >= 0 and (new := rank_of.get((ids[before[i]], ids[i]))) is not None:
                heapq.heappush(heap, (new[0], before[i]))
        return [x for x in ids if x >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of words written in the vocabulary's characters."""
        proposed = [self._propose(w) for w in words]
        sizes = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        keys, place = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        fits = self.compatible(keys // self.size, keys % self.size)[place]
        failed = np.unique(np.r_[owner[inner[~fits]], owner[~self.reachable[flat]]])
        for i in failed.tolist():
            proposed[i] = self._merge(words[i])
        return proposed

    # Chunks of text without white space

    def _pieces(self, chunk: str) -> list[str | int]:
        """Words in the vocabulary's characters; special tokens as ids."""
        if "<|" in chunk and self.special_pattern.search(chunk):
            parts = self.special_pattern.split(chunk)
            return [
                piece
                for part in parts
                if part
                for piece in ([self.special[part]] if part in self.special else self._pieces(part))
            ]
        if chunk.isascii():
            return [self._mapped(w) for w in _WORDS.findall(chunk.lower())]
        if _PLAIN.fullmatch(chunk):
            return [self._mapped(w) for w in _WORDS.findall(chunk.lower())]
        normal = self.library.normalizer.normalize_str(chunk)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal) if w]

    def _mapped(self, word: str) -> str:
        if word.isascii() and word.isprintable():
            return word
        return "".join([self.chars[b] for b in word.encode()])

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        if len(self.words) > CACHE_ENTRIES:
            self.words.clear()
        split = [self._pieces(c) for c in chunks]
        fresh = list({w for p in split for w in p if not isinstance(w, int)}.difference(self.words))
        for word, ids in zip(fresh, self.encode_words(fresh) if fresh else (), strict=True):
            self.words[word] = np.array(ids, "<i4").tobytes()
        known = self.words
        return [
            b"".join(w.to_bytes(4, "little") if isinstance(w, int) else known[w] for w in pieces)
            for pieces in split
        ]


@lru_cache(maxsize=2)
def _encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(WordBpe(path).encode_chunks)


def _by_id(ids: dict[str, int]) -> pa.Array:
    names = [""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        names[i] = token
    return pa.array(names)


@lru_cache(maxsize=2)
def _tokens(path: str) -> pa.Array:
    """The tokens by id; decoding needs nothing else of the file."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    return _by_id(file["model"]["vocab"] | {t["content"]: t["id"] for t in file["added_tokens"]})


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(path)
    for batch in steps(batches):
        texts = [t or "" for t in batch.column(1).to_pylist()]
        ids = id_lists(list(encoder.texts(texts)))
        yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokens = _tokens(path)
    for batch in batches:
        ids = batch.column(1)
        ends = pc.subtract(ids.offsets, ids.offsets[0])
        words = pa.ListArray.from_arrays(ends, tokens.take(ids.flatten()))
        text = pc.binary_join(words, " ")
        yield pa.RecordBatch.from_arrays([batch.column(0), ids, text], ["doc_id", "ids", "text"])


_IDS, _BOTH = "doc_id long, ids array<int>", "doc_id long, ids array<int>, text string"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` (array of int) of every whole text."""
    file = path or default_path()
    return _texts(docs).mapInArrow(lambda batches: _encoded(batches, file), _IDS)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, text``: the tokens of ``ids`` joined by one space."""
    file = path or default_path()
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda batches: _decoded(steps(batches), file), _BOTH
    )


def encode_and_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``decode(encode(docs))`` by one worker per task, not two."""
    file = path or default_path()
    return _texts(docs).mapInArrow(lambda batches: _decoded(_encoded(batches, file), file), _BOTH)


def _digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = encode_and_decode(table(spark, sf_dir, "documents"))
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


QUERIES = {"op10_speculative_bpe": _digest}
ORACLES: dict[str, str] = {}
