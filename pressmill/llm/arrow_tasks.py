"""Pieces of work as runs of rows within sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def by_task(batches: Iterator[pa.RecordBatch], column: str = "task") -> Iterator[pa.RecordBatch]:
    """One batch for each run of equal values in ``column``, which sorts the rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        tasks = batch.column(column).dictionary_encode().indices.to_numpy()
        if not len(tasks):
            continue
        cuts = [0, *(np.flatnonzero(np.diff(tasks)) + 1).tolist(), len(tasks)]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[0].column(column)[0] != batch.column(column)[a]:
                yield _joined(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield _joined(held)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts laid end to end, and where each begins and the last ends."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    first, last = int(ends[0]), int(ends[-1])
    raw = np.frombuffer(data, np.uint8)[first:last] if data else np.empty(0, np.uint8)
    return raw, ends.astype(np.int64) - first


def text_steps(
    batches: Iterator[pa.RecordBatch], column: int, size: int = 4_000_000
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``size`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = text_bytes(batch.column(column))[1]
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(ends, ends[start] + size, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
