"""Token ids of whole texts, from the ids of their white-space-free chunks.

The tokenizer of ``word_bpe_49k.json`` drops white space and no token reaches across
it, so a text's ids are those of its chunks in order. A chunk is encoded once per
Python worker and kept in a bounded cache.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
import re

import numpy as np
import pyarrow as pa

#: Chunks of one generation; a worker remembers the current and the last one.
CACHE_ENTRIES = 400_000
#: Longer chunks (unbroken text) are encoded each time.
CACHE_CHARS = 48
#: Texts of one vectorised step, in code points.
STEP_CHARS = 2_000_000

#: Rows of one step; Spark's own batches hold up to 10,000 texts.
STEP_ROWS = 500

# str.split() also cuts at U+001C to U+001F, which are no white space to the tokenizer.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")


def _plain(text: str) -> bool:
    """Whether lower case changes no id: each character stands alone and none is special."""
    if "<|" in text:
        return False
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def chunks_of(text: str) -> list[str]:
    if _plain(text):
        text = text.lower()  # the tokenizer does the same; fewer chunks are new
    if _SEPARATORS.search(text):
        return [c for c in _WHITE.split(text) if c]
    return text.split()


class ChunkEncoder:
    """``encode(chunks)`` gives the ids of each chunk as little-endian 32-bit bytes."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode, self.known, self.last = encode, {}, {}

    def texts(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        step: list[list[str]] = []
        chars = 0
        for text in texts:
            step.append(chunks_of(text))
            chars += len(text)
            if chars >= STEP_CHARS:
                yield from self._step(step)
                step, chars = [], 0
        yield from self._step(step)

    def _step(self, split: list[list[str]]) -> Iterator[bytes]:
        if len(self.known) > CACHE_ENTRIES:
            self.known, self.last = {}, self.known
        known, last = self.known, self.last
        new = set().union(*split).difference(known) if split else set()
        kept = new.intersection(last)
        known.update(zip(kept, map(last.__getitem__, kept)))
        fresh = list(new.difference(kept))
        if fresh:
            known.update(zip(fresh, self.encode(fresh), strict=True))
        once = [chunk for chunk in fresh if len(chunk) > CACHE_CHARS]
        for chunks in split:
            yield b"".join(map(known.__getitem__, chunks))
        for chunk in once:
            del known[chunk]


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, STEP_ROWS):
            yield batch.slice(start, STEP_ROWS)


def id_lists(encoded: list[bytes]) -> pa.Array:
    """An Arrow array of int lists."""
    ends = np.cumsum([0, *(len(x) // 4 for x in encoded)])
    flat = np.frombuffer(b"".join(encoded), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
