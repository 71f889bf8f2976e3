"""Alignment, line dedup and fill-in-middle against plain Python."""

from collections import Counter
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
import sentencepiece
from tokenizers import Tokenizer

from pressmill.llm import fill_middle, line_dedup, token_alignment
from pressmill.llm.speculative_bpe import _byte_chars
from pressmill.llm.token_alignment import NEUTRAL, compose, groups_of, ranges


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Alignment


class Plain:
    """Both libraries as they are, and groups by sets of offsets."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(
            model_file=public_tokenizers.path("piece_bpe_32k.model")
        )
        self.byte = {c: i for i, c in enumerate(_byte_chars())}

    def _piece(self, i):
        name = self.b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()

    def document(self, text):
        """None, or counts, links and groups."""
        raw = (" " + (text or "")).encode()
        a = self.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = self.b.encode(text or "")
        parts_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        parts_b = [self._piece(i) for i in b]
        if not text or b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            return None
        ends_a, ends_b = (np.cumsum([len(p) for p in x]) for x in (parts_a, parts_b))
        low, groups, links = 0, [], []
        for high in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            one, two = (
                x[np.searchsorted(e, low, "right") : np.searchsorted(e, high, "right")]
                for x, e in ((a, ends_a), (b, ends_b))
            )
            groups.append(",".join(map(str, one)) + "|" + ",".join(map(str, two)))
            links.append((one[-1], two[-1]))
            low = high
        return len(a), len(b), links, ";".join(groups)


@pytest.fixture(scope="module")
def plain():
    return Plain()


def _rows_of(plain, docs):
    found = [(i, plain.document(t)) for i, t in docs]
    counts = Counter(link for _, d in found if d for link in d[2])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for i, d in found:
        if d is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = d
        highest = sum(counts[x] == best[x[1]] for x in links)
        total = sum(counts[x] for x in links)
        out.append((i, n_a, n_b, len(links), len(links), highest, total, _sha(groups)))
    return sorted(out, key=repr)


def test_alignment_of_the_given_documents(spark, folder, plain):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, token_alignment._query(spark, folder).collect()), key=repr)
    assert got == _rows_of(plain, docs)


ODD = [
    "",
    None,
    " ",
    "   two  spaces   ",
    "a literal ▁ is lost",
    "<|endoftext|> is <s> plain </s> text",
    "中文没有空格。" * 90 + " und ñandú \n\n\t x\x00y \U0001f600" * 40,
    "x" * 700,
    "word " * 400,
    "a b" * 500 + "  c   d",
]


@pytest.mark.parametrize("chunk", [7, 64, 1000])
def test_alignment_in_ranges_of_any_size(spark, plain, chunk):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    got = token_alignment.align(docs, chunk=chunk).collect()
    found = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.groups, _summed(r)) for r in got}
    wanted = {}
    for i, text in enumerate(ODD):
        d = plain.document(text)
        links = Counter(a * token_alignment.IDS + b for a, b in d[2]) if d else Counter()
        wanted[i] = (d[0], d[1], len(d[2]), d[3], links) if d else (0, 0, 0, "", links)
    assert found == wanted


def _summed(row):
    out = Counter()
    for pair, times in zip(row.pairs, row.times, strict=True):
        out[pair] += times
    return out


def test_composition_is_associative_and_has_a_neutral_element():
    both = token_alignment._tokenizers(*token_alignment.default_paths())
    text = " " + "können, naïve it's 1234 ünter¿Qué? " * 6
    ((a, b, ok),) = both.encode([text])
    assert ok
    size = len(text.encode())
    whole = both.fragment(a, b, 0, size)
    rng, open_both = random.Random(3), 0
    for _ in range(60):
        cuts = sorted(rng.sample(range(1, size), 5))
        parts = [both.fragment(a, b, x, y) for x, y in zip([0, *cuts], [*cuts, size])]
        left, right = NEUTRAL, NEUTRAL
        for part in parts:
            left = compose(left, part)
        for part in reversed(parts):
            right = compose(part, right)
        pairwise = compose(
            compose(parts[0], compose(parts[1], parts[2])),
            compose(compose(parts[3], parts[4]), parts[5]),
        )
        for tree in (left, right, pairwise):
            assert groups_of(tree) == groups_of(whole)
            assert (tree.n_a, tree.n_b, tree.n_groups) == (whole.n_a, whole.n_b, whole.n_groups)
        open_both += any(p.cut and p.head_a and p.tail_a for p in parts)
    assert open_both


def test_ranges_cover_a_text_once():
    for text in (" " + "word " * 300, " " + "x" * 2000, " " + "ü ñ" * 400, " a"):
        size = 0
        for piece, low, high in ranges(text, 50):
            raw = piece.encode()
            assert 0 <= low <= high <= len(raw)
            size += high - low
        assert size == len(text.encode())


# Line dedup


def _plain_dedup(docs, min_docs, min_chars, first):
    """docs: (doc_id, text) in order."""
    key = lambda line: re.sub("^[ \t-\r]+|[ \t-\r]+$", "", line).translate(
        {c: c + 32 for c in range(65, 91)}
    )
    lines = [(t or "").split("\n") for _, t in docs]
    held = Counter(k for d in lines for k in {key(x) for x in d})
    seen, out = Counter(), []
    for d in lines:
        keep = []
        for line in d:
            k = key(line)
            often = len(k) >= min_chars and held[k] >= min_docs
            seen[k] += 1
            if not often or seen[k] <= first:
                keep.append(line)
        out.append((len(d), len(d) - len(keep), "\n".join(keep)))
    return out


LINES = [
    (1, "Title\nShared line \n\nown 1\nSHARED LINE\nTail"),
    (2, "\tshared line\nown 2\n"),
    (2, "\tshared line\nown 2\n"),
    (3, None),
    (4, ""),
    (5, "\n\n"),
    (6, "ÄRGER\nshared line\r"),
    (7, "ärger\n\x0b\nTail"),
    (8, "\n".join(["Tail"] * 50)),
    (None, "Tail\nx\nTail"),
    (9, "\n".join(f"line {i % 7}" for i in range(3000))),
]


@pytest.mark.parametrize("first", [0, 1, 2])
@pytest.mark.parametrize("min_docs,min_chars", [(2, 1), (3, 5), (1, 1)])
def test_lines_against_plain_python(spark, first, min_docs, min_chars):
    docs = spark.createDataFrame(LINES, "doc_id long, text string").coalesce(1)
    docs = docs.withColumn("pos", F.lit("clash")).withColumn("rank_", F.lit(0))
    rows = line_dedup.numbered(docs)
    done = line_dedup.apply_bitmaps(rows, line_dedup.keep_bitmaps(rows, min_docs, min_chars, first))
    got = {r.row: (r.n_lines, r.n_dropped, r.kept) for r in done.collect()}
    order = {r.row: (r.doc_id, r.text) for r in rows.collect()}
    in_order = sorted(order, key=lambda r: (order[r][0] is None, order[r][0] or 0, r))
    wanted = _plain_dedup([order[r] for r in in_order], min_docs, min_chars, first)
    assert [got[r] for r in in_order] == wanted


def test_bitmaps_are_runs(spark):
    docs = spark.createDataFrame([(1, "a\nb\nb\nc\nd\nb"), (2, "b\nd")], "doc_id long, text string")
    rows = line_dedup.numbered(docs)
    got = {r.doc_id: [tuple(x) for x in r.keep] for r in line_dedup.keep_bitmaps(rows).collect()}
    assert got == {1: [(0, 2), (3, 2)], 2: []}


# Fill in middle


def _plain_fim(doc_id, text, rate=90, first=20):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = _sha("1:" + ("" if doc_id is None else str(doc_id)))
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < first:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_against_plain_python(spark):
    rng = random.Random(5)
    letters = ["a", "Zz", "ñ", " ", "\n", "<", "P>", "<P", "S>", "M>", "\U0001f600", "\x00", "word" * 9]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(400)]
    texts += [None, "", "x" * 20_000, "ab " * 9000, "é" * 9001, "<S", "a<P>b", "z" * 4096 + " " + "y" * 4095]
    docs = [*enumerate(texts), (None, "no id here"), (7, "a repeated id")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("clash"))
    done = fill_middle.fill_in_middle(frame)
    back = fill_middle.restore(F.col("output"), F.col("form"))
    got = [tuple(r) for r in done.withColumn("back", back).collect()]
    wanted = [(i, *_plain_fim(i, t), t or "") for i, t in docs]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("size", [1, 2, 3, 8, 13, 100])
def test_fenwick_descent(size):
    rng = np.random.default_rng(size)
    units, points = rng.integers(0, 4, size), rng.integers(0, 9, size)
    tree = fill_middle.Fenwick(units, points)
    sums, all_points = np.r_[0, np.cumsum(units)], np.r_[0, np.cumsum(points)]
    wanted = np.arange(int(sums[-1]) + 1)
    at, (done, before) = tree.descend(wanted)
    expected = np.searchsorted(sums, wanted, side="right") - 1
    assert at.tolist() == expected.tolist()
    assert done.tolist() == sums[expected].tolist()
    assert before.tolist() == all_points[expected].tolist()
