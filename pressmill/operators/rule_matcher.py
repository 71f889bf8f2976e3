"""Rules of a table tried on batches of folded texts, within one Python worker.

The places of all needed texts come from hashed grams of the batch: a place is taken if the
gram and then the whole text have the hash of a needed one. A place only says where a rule
is tried, so hashes that clash cost a try and decide nothing. A rule whose text stands at few
distances from the start of a match is tried at these starts in their order; any other
is searched for from the first place at which a match may begin.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pressmill.functions import rules as rx

#: Characters of a gram, for texts of at least as many.
GRAMS = (5, 3)
#: Characters of a batch of texts, hits that are handed on at once, and their characters.
CHARS, HITS, FRAGMENTS = 250_000, 200_000, 1 << 26
#: Starts of a match that are tried one by one for a place of its text.
NEAR = 8
#: Rules that a place of a text is given to at once.
SHARE = 64
_MIX, _PICK = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BITS = 20
#: Ways to try a rule: at the starts its places tell; from the first of them on; anywhere.
FIXED, FROM, ANYWHERE = range(3)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


def _hash(codes: np.ndarray) -> np.uint64:
    """Sum of the codes times rising powers."""
    powers = np.cumprod(np.full(len(codes), _MIX), dtype=np.uint64)
    return (codes * powers).sum(dtype=np.uint64)


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    n = max(len(codes) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _MIX + codes[k : k + n]
    return out


def _slot(grams: np.ndarray) -> np.ndarray:
    return ((grams * _PICK) >> np.uint64(64 - _BITS)).astype(np.int64)


class TextFinder:
    """Places of ``texts`` (of at least three characters) in batches of texts."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        codes = [_codes(t) for t in texts]
        self.length = np.array([len(c) for c in codes], np.int64)
        self.hash = np.array([_hash(c) for c in codes], np.uint64)
        self.tables = [self._table(codes, size) for size in GRAMS]

    def _table(self, codes: list[np.ndarray], size: int) -> tuple:
        """Grams, where the texts of each begin in a list, these texts, and the gram's place in them."""
        own = [t for t, c in enumerate(codes) if len(c) >= size and not any(size < g <= len(c) for g in GRAMS)]
        each = [_grams(codes[t], size) for t in own]
        known, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *[np.unique(e) for e in each]]), return_counts=True)
        # A text is found by its gram that the fewest texts have.
        at = np.array([int(counts[np.searchsorted(known, e)].argmin()) for e in each], np.int64)
        gram = np.array([e[a] for e, a in zip(each, at)], np.uint64)
        order = np.argsort(gram, kind="stable")
        grams, first = np.unique(gram[order], return_index=True)
        held = np.zeros(1 << _BITS, bool)
        held[_slot(grams)] = True
        return size, held, grams, np.append(first, len(order)), np.array(own, np.int64)[order], at[order]

    def places(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``row, text, place`` of texts laid end to end with one character after each; sorted."""
        rows, texts, places = [], [], []
        powers = np.cumprod(np.full(len(codes), _MIX), dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers, dtype=np.uint64)])
        powers = np.concatenate([np.ones(1, np.uint64), powers])
        for size, held, grams, first, own, offset in self.tables:
            if not len(grams):
                continue
            found = _grams(codes, size)
            at = np.flatnonzero(held[_slot(found)])
            found = found[at]
            gram = np.searchsorted(grams, found)
            gram[gram == len(grams)] = 0
            true = grams[gram] == found
            at, gram = at[true], gram[true]
            many = first[gram + 1] - first[gram]
            which = np.repeat(first[gram], many) + _counted(many)
            text, place = own[which], np.repeat(at, many) - offset[which]
            inside = (place >= 0) & (place + self.length[text] <= len(codes))
            text, place = text[inside], place[inside]
            same = sums[place + self.length[text]] - sums[place] == self.hash[text] * powers[place]
            text, place = text[same], place[same]
            row = np.searchsorted(ends, place, side="right")
            inside = place + self.length[text] <= ends[row]
            rows.append(row[inside])
            texts.append(text[inside])
            places.append(place[inside])
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate([none, *x]) for x in (rows, texts, places))


def _counted(many: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count."""
    ends = np.cumsum(many)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many, many)


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each with one more after it, and where each text ends."""
    codes = _codes("\0".join([*texts, ""]))
    return codes, np.cumsum(np.array([len(t) + 1 for t in texts], np.int64)) - 1


def text_steps(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The rows in batches of some ``CHARS`` bytes of text, or of one row."""
    sizes = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        end = max(int(np.searchsorted(sizes, base + CHARS, side="right")), start + 1)
        yield batch.slice(start, end - start)
        start = end


def _admits(chars: str | None) -> np.ndarray:
    """Which of the first 128 characters a class has; all others are let through."""
    out = np.ones(129, bool)
    if chars is not None:
        has = re.compile(chars).match
        out[:128] = [has(chr(c)) is not None for c in range(128)]
    return out


class Matcher:
    """Rules as rows ``pattern, needed, places, folded`` with the other columns of a hit."""

    def __init__(self, rows: list[dict], told: list[bool], columns: pa.RecordBatch):
        self.columns = columns
        self.patterns = [r["folded"] for r in rows]
        self.needed = [r["needed"] for r in rows]
        self.anywhere = [n for n in range(len(rows)) if not told[n]]
        self.calls: dict[int, Callable[..., re.Match | None]] = {}
        ids: dict[str, int] = {}
        classes: dict[str | None, int] = {None: 0}
        self.way = np.full(len(rows), ANYWHERE, np.int8)
        blocks: list[list[tuple]] = []
        shares: dict[int, int] = {}
        for rule, row in enumerate(rows):
            if not told[rule]:
                continue
            places = row["places"]
            texts = [ids.setdefault(t, len(ids)) for t in row["needed"]]
            fixed = all(p["high"] is not None and p["high"] - p["low"] <= NEAR for p in places)
            self.way[rule] = FIXED if fixed else FROM
            block = max(shares.get(t, 0) for t in texts) // SHARE
            blocks += [[] for _ in range(block + 1 - len(blocks))]
            for t, p in zip(texts, places):
                shares[t] = block * SHARE + max(shares.get(t, 0) - block * SHARE, 0) + 1
                left, right = (classes.setdefault(p[k], len(classes)) for k in ("left", "right"))
                most = p["high"] if p["high"] is not None else -1
                ways = [(n, n) for n in range(p["low"], most + 1)] if fixed else [(p["low"], most)]
                blocks[block] += [(t, rule, *w, left, right) for w in ways]
        self.finder = TextFinder(list(ids))
        self.admits = np.stack([_admits(c) for c in classes])
        self.blocks = []
        for block in blocks:
            cells = np.array(block, np.int64).reshape(-1, 6)
            cells = cells[np.argsort(cells[:, 0], kind="stable")]
            first = np.searchsorted(cells[:, 0], np.arange(len(ids) + 1))
            self.blocks.append((first, *cells[:, 1:].T))

    def _call(self, rule: int) -> Callable[..., re.Match | None]:
        """Tries a rule: at a place, or from it on."""
        if rule not in self.calls:
            pattern = re.compile(self.patterns[rule])
            self.calls[rule] = pattern.match if self.way[rule] == FIXED else pattern.search
        return self.calls[rule]

    def _tries(self, texts: list[str]) -> Iterator[tuple]:
        """Per block of rules ``row, rule, start``, sorted: where a match may begin, in the row."""
        codes, ends = joined(texts)
        begins = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])
        low_codes = np.minimum(codes, np.uint64(128)).astype(np.int64)
        row, text, place = self.finder.places(codes, ends)
        for first, rule, low, high, left, right in self.blocks:
            many = first[text + 1] - first[text]
            cell = np.repeat(first[text], many) + _counted(many)
            at, own, of = np.repeat(place, many), np.repeat(row, many), np.repeat(text, many)
            may = at - low[cell] >= begins[own]
            may &= self.admits[right[cell], low_codes[at + self.finder.length[of]]]
            may &= (left[cell] == 0) | self.admits[left[cell], low_codes[np.maximum(at - 1, 0)]]
            at, own, cell = at[may], own[may], cell[may]
            start = np.where(high[cell] < 0, 0, np.maximum(at - high[cell] - begins[own], 0))
            key = own * len(self.patterns) + rule[cell]
            order = np.lexsort((start, key))
            yield own[order], rule[cell[order]], start[order]

    def hits(self, texts: list[str], told: list[bool]) -> Iterator[tuple[list, list, list]]:
        """``row, rule, fragment`` of the rules that match; texts that are not told meet no text."""
        folded = [rx.folded(t) for t in texts]
        rows, rules, parts, size = [], [], [], 0
        known = np.array(told, bool)
        for own, rule, start in self._tries(folded):
            new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (rule[1:] != rule[:-1])][: len(own)])
            stops = np.append(new[1:], len(own))
            meant = known[own[new]]
            new, stops = new[meant], stops[meant]
            starts, calls = start.tolist(), self.calls
            groups = (own[new], rule[new], self.way[rule[new]] == FIXED, new, stops)
            for r, n, fixed, a, b in zip(*(x.tolist() for x in groups)):
                text, call = folded[r], calls.get(n) or self._call(n)
                found = call(text, starts[a])
                if found is None:
                    if not fixed:
                        continue
                    for s in starts[a + 1 : b]:
                        if found := call(text, s):
                            break
                    else:
                        continue
                s, e = found.span()
                rows.append(r)
                rules.append(n)
                parts.append(texts[r][s:e])
                size += e - s
                if len(rows) >= HITS or size >= FRAGMENTS:
                    yield rows, rules, parts
                    rows, rules, parts, size = [], [], [], 0
        for n in self.anywhere:
            search, needed = self._call(n), self.needed[n]
            for r, text in enumerate(folded):
                if (not needed or any(t in text for t in needed)) and (found := search(text)):
                    s, e = found.span()
                    rows.append(r)
                    rules.append(n)
                    parts.append(texts[r][s:e])
                    size += e - s
                    if len(rows) >= HITS or size >= FRAGMENTS:
                        yield rows, rules, parts
                        rows, rules, parts, size = [], [], [], 0
        if rows:
            yield rows, rules, parts
