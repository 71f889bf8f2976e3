"""Operators against brute-force versions, exact round trips and held-out accuracy."""

from collections import Counter
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pressmill.llm import (
    catalog,
    chat_format,
    cross_polytope,
    disclosure,
    html_blocks,
    lsh_forest,
    merkle,
    nnls_packing,
    speculative_bpe,
    toxicity,
)
from pressmill.llm.chunk_ids import ChunkEncoder


@pytest.fixture(scope="module")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(speculative_bpe.default_path())


@pytest.fixture(scope="module")
def strange_texts():
    pick = random.Random(1)
    letters = "abcdeéèßñ İΣσςǰJ̌ \x1c\x1f\x85\xa0　'sll'tAÄ漢字한국어١²½_-.…😀👍🏽‍\n\tтестЖ"
    special = ["<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", "x", " ", "a<|endoftext|>b"]
    return [
        *["".join(pick.choices(letters, k=pick.randint(0, 40))) for _ in range(3000)],
        *["".join(pick.choices("thinger!.", k=pick.randint(1, 40))) for _ in range(3000)],
        *["".join(pick.choices(special, k=5)) for _ in range(300)],
        "a" * 3000, "!" * 500, "aaaaaaaa " * 9, "it's we'll I'D", "",
    ]


@pytest.mark.parametrize("kind", ["speculative", "library"])
def test_chunk_ids_are_the_librarys(documents, library, strange_texts, kind):
    path = speculative_bpe.default_path()
    encoder = (
        ChunkEncoder(speculative_bpe.WordBpe(path).encode_chunks)
        if kind == "speculative"
        else nnls_packing._library(path)
    )
    texts = [r.text for r in documents] + strange_texts
    wanted = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.texts(texts)]
    assert got == wanted


def test_compatibility_is_that_of_merging(library):
    bpe = speculative_bpe.WordBpe(speculative_bpe.default_path())
    names = bpe.tokens().to_pylist()
    pick = random.Random(2)
    inner = [i for i in range(512, 20_000) if not names[i].endswith("</w>")]
    pairs = [(pick.choice(inner), pick.randrange(512, 20_000)) for _ in range(3000)]
    fits = bpe.compatible(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    for (a, b), fit in zip(pairs, fits):
        word = names[a] + names[b]
        if word.endswith("</w>"):
            assert (bpe._merge(word[:-4]) == [a, b]) == fit


def test_encoding_query(spark, folder, documents, library):
    got = {r.doc_id: r for r in catalog.QUERIES["op10_speculative_bpe"](spark, folder).collect()}
    for row in documents:
        ids = library.encode(row.text, add_special_tokens=False).ids
        mine = got[row.doc_id]
        assert mine.n_tokens == len(ids)
        assert mine.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert mine.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_one_worker_gives_what_two_give(spark, library, strange_texts):
    texts = [*strange_texts, None, "", "one <|endoftext|> two", "long " * 50_000]
    rows = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, ids string"
    )  # a further column with the name of a result
    plan = speculative_bpe.encode_and_decode(rows)._jdf.queryExecution().toString()
    assert plan.split("Physical Plan")[1].count("MapInArrow") == 1
    both = {r.doc_id: r for r in speculative_bpe.encode_and_decode(rows).collect()}
    apart = speculative_bpe.decode(speculative_bpe.encode(rows)).collect()
    assert len(both) == len(apart) == len(texts)
    for r in apart:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.ids, r.text) == (both[r.doc_id].ids, both[r.doc_id].text)
        assert r.ids == ids and r.text == library.decode(ids, skip_special_tokens=False)
    assert speculative_bpe.encode_and_decode(rows.where("false")).count() == 0


def test_packing_holds_every_id_once(spark, folder, documents, library):
    pieces = catalog.QUERIES["op9_nnls_packing"](spark, folder).collect()
    ids = {r.doc_id: [*library.encode(r.text, add_special_tokens=False).ids, 1] for r in documents}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
        part = np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4")
        assert (len(part), zlib.crc32(part.tobytes())) == (p.length, p.ids_crc32)
        assert p.doc_tokens == len(ids[p.doc_id])
    for doc, parts in by_doc.items():
        parts.sort(key=lambda p: p.start)
        assert [p.start for p in parts] == list(np.cumsum([0, *[p.length for p in parts]])[:-1])
        assert sum(p.length for p in parts) == len(ids[doc])
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == list(np.cumsum([0, *[p.length for p in parts]])[:-1])
        assert sum(p.length for p in parts) <= 2048


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_the_histogram_exactly(seed):
    pick = np.random.default_rng(seed)
    lengths = pick.integers(1, [2049, 40, 2049, 1100, 3, 2049][seed], [3000, 5000, 1, 800, 400, 0][seed])
    wanted = Counter(int(x) for x in lengths)
    used = Counter()
    for shape, times in nnls_packing.plan(dict(wanted)):
        assert sum(shape) <= 2048
        for x in shape:
            used[x] += times
    assert used == wanted


def test_nnls_minimises():
    pick = np.random.default_rng(3)
    a, b = pick.random((20, 40)), pick.random(20) * 10
    x = nnls_packing.nnls(a, b)
    slope = a.T @ (a @ x - b)
    assert x.min() >= 0 and slope.min() > -1e-4 and np.abs(slope[x > 0]).max() < 1e-4


def _shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def test_join_against_all_pairs(spark, folder, documents):
    pick = random.Random(4)
    base = [r.text for r in documents]
    near = []
    for i in range(60):  # one hot group of near copies, larger than a block below
        words = base[3].split()
        for _ in range(pick.randint(0, 4)):
            words[pick.randrange(len(words))] = f"new{i}{pick.random()}"
        near.append(" ".join(words))
    texts = base + near + [near[0], near[0].upper(), "", None, "a b", "a b c", "A B"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = lsh_forest.similar_documents(docs, block=16).collect()
    sets = [_shingles(t) for t in texts]
    links, parent = Counter(), list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = {r.doc_id: (r.class_id, r.n_links) for r in rows}
    assert got == {i: (root(i), links[i]) for i in range(len(texts))}


def test_prefix_depth_reaches_the_recall():
    depth = lsh_forest.depth_for()
    miss = (1 - 0.8**depth) ** lsh_forest.TREES
    assert miss <= 1e-4 < (1 - 0.8 ** (depth + 1)) ** lsh_forest.TREES


def test_neighbours_recall_and_blocks(spark, folder, monkeypatch):
    monkeypatch.setattr(cross_polytope, "ROW_BLOCK", 7)
    monkeypatch.setattr(cross_polytope, "QUERY_BLOCK", 2)
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    data = {r.id: np.array(r.vector, float) for r in rows.collect()}
    found = {}
    for r in cross_polytope.nearest(rows, rows.where("id % 50 = 0")).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q in (i for i in data if i % 50 == 0):
        score = {i: data[q] @ v / np.sqrt((data[q] @ data[q]) * (v @ v)) for i, v in data.items() if i != q}
        best = sorted(score, key=lambda i: (-score[i], i))[:5]
        hits += len(set(best) & {v for _, v, _ in found[q]})
        total += 5
        assert [r for r, _, _ in sorted(found[q])] == [1, 2, 3, 4, 5]
        for _, v, s in found[q]:
            assert s == pytest.approx(score[v], abs=1e-14)
    assert hits / total >= 0.9


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, match):
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        twice = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return True


def _base(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text)
        if _valid(kind, m[0])
    ]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    pick = random.Random(3)
    bits = [
        "a@b.co", "x_y@q.org.", "@", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8.9", "4111 1111 1111 1111",
        "4111-1111-1111-1111 ", "4111111111111112", "+1 (988) 555-2485", "+49 30 1234", "+1", "é", " ",
        "-", "..", "a@b", "😀", "0000255.1.1.1", "+12345678901234567", "a@b.com_x@y.org", "\n",
        "99999999999999999999.1.1.1", "foo",
    ]
    texts = ["".join(pick.choices(bits, k=pick.randint(0, 12))) for _ in range(1500)]
    texts += ["a" * 100_000, "+(" * 20_000, "1 2" * 10_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for r in rows.select("doc_id", disclosure.base_spans(F.col("text")).alias("s")).collect():
        if len(texts[r.doc_id]) < 5000:
            assert [tuple(s) for s in r.s] == _base(texts[r.doc_id])
        else:
            assert r.s == []


def test_disclosing_terms_and_generalised_text(spark):
    docs = [f"{'abcdefgh'[i] * 4} Zorvex wrote from boss@corp.org about the matter" for i in range(4)]
    docs += ["the matter about nothing wrote from here"] * 20 + ["Zorvex alone is not near"] * 0
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    out = disclosure.sanitise(rows).orderBy("doc_id").collect()
    assert out[0].text == "aaaa <term> wrote from <email> about the matter"
    assert out[10].text == docs[10]
    copies = spark.createDataFrame([(i, docs[0]) for i in range(9)] + [(99, "x")], "doc_id long, text string")
    same = disclosure.sanitise(copies).where("doc_id = 3").first()
    assert same.text == docs[0].replace("boss@corp.org", "<email>")  # copies show nothing new


def test_small_tables_give_all_candidates(spark):
    pick = np.random.default_rng(4)
    for n in (4, 20):
        vectors = pick.standard_normal((n, 64))
        rows = spark.createDataFrame(
            [(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vector array<double>"
        )
        got = cross_polytope.nearest(rows, rows).collect()
        assert len(got) == n * min(n - 1, 5)
        assert len({(r.query_id, r["rank"]) for r in got}) == len(got)


def test_disclosing_terms_far_from_the_entity(spark):
    pad = "the matter about nothing wrote from here " * 6
    docs = [f"{'abcdefgh'[i] * 4} Zorvex {pad}boss@corp.org" for i in range(4)]
    docs += [f"{'abcdefgh'[i] * 4} {pad}ip 10.0.0.{i}" for i in range(4)] + ["Zorvex walks alone"]
    docs += [pad] * 40
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    out = [r.text for r in disclosure.sanitise(rows).orderBy("doc_id").collect()]
    assert out[0] == f"aaaa <term> {pad}<email>"
    assert out[8] == "<term> walks alone"  # the term alone tells the entity
    assert out[4] == f"aaaa {pad}ip <ip>" and out[9:] == docs[9:]
    twice = rows.union(rows)  # rows are the documents of all counts
    again = disclosure.sanitise(twice).where("doc_id = 8").collect()
    assert [r.text for r in again] == ["<term> walks alone"] * 2


def test_merkle_edits_and_likeness(spark):
    a, b = "one\ntwo\n\nthree\nfour", "one\nTWO\n\nthree\nfour\nfive"
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        merkle.root(merkle.tree(F.col("a"))).alias("ra"),
        merkle.root(merkle.tree(F.col("b"))).alias("rb"),
        merkle.edits(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("edits"),
        merkle.likeness(merkle.nodes(F.col("a")), merkle.nodes(F.col("b"))).alias("near"),
    )
    got = row.first()
    assert got.ra != got.rb
    assert [tuple(e) for e in got.edits] == [(0, 1), (1, 2)]
    assert got.near == pytest.approx(_plain_likeness(a, b))


def _plain_nodes(text):
    leaves, held = [], ""
    for c in text:
        held += "" if c == "\n" else c
        if c == "\n" or c in "dkгж" or "\u3000" <= c <= "\udfff" and ord(c) % 4096 < 128 or len(held) == 64:
            leaves.append(held)
            held = ""
    levels = enumerate([[*leaves, held], text.split("\n"), text.split("\n\n")])
    return {(i, part) for i, parts in levels for part in parts if part}


def _plain_likeness(a, b):
    x, y = _plain_nodes(a), _plain_nodes(b)
    if max(len(a), len(b)) <= 128:
        x, y = ({("\n\n" + t)[i : i + 3] for i in range(len(t))} for t in (a, b))
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0


def test_merkle_likeness_follows_the_content(spark):
    words = [f"{'aeiou'[i % 5]}w{i * 7919 % 1000}d" for i in range(300)]
    long, solid = " ".join(words), "".join(words)
    han = "".join(chr(0x4E00 + i * 7907 % 20000) for i in range(900))
    pairs = [(t, "x" + t) for t in (long, solid, han)]  # one more code point in front
    halves = ["ab", "hello", "Short one.", long, solid, han, "aaaa" * 50, "q" * 129]
    pairs += [(t, t[: len(t) - len(t) // 2] + "#" * (len(t) // 2)) for t in halves]
    pairs += [("", ""), ("", "a"), ("\n\n\n", "\n\nab"), (long, words[0])]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    near = merkle.likeness(merkle.nodes(F.col("a")), merkle.nodes(F.col("b")))
    got = {r.i: r.near for r in rows.select("i", near.alias("near")).collect()}
    for i, (a, b) in enumerate(pairs):
        assert got[i] == pytest.approx(_plain_likeness(a, b)), (i, a[:20])
    assert min(got[i] for i in range(3)) > 0.85
    assert min(got[3 + i] for i in range(len(halves))) > 0
    assert got[11] == 1 and got[12] == 0


def test_chat_merges_and_reads_back(spark):
    rows = [
        (1, 1, "user", "hi <|im_end|>"), (1, 2, "assistant", "<\\|x"), (1, 3, "assistant", "more"),
        (1, 4, "user", "a<|im_sep|>b"),
    ]
    done = chat_format.format_conversations(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    )
    got = done.select(
        "formatted",
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).first()
    assert got.formatted.count(chat_format.START) == 3 and got.formatted.count(chat_format.SEP) == 1
    assert [tuple(t) for t in got.turns] == [(r, t) for _, _, r, t in rows]
    assert got.loss == "<\\|xmore"


def test_shards_match_the_mixture(spark):
    rows = catalog.QUERIES["op6_interleaved_shards"](spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    sizes, mixture, slots = Counter(), Counter(), {}
    for r in rows:
        text = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
        sizes[r["shard"]] += 1
        mixture[docs[r.doc_id].source, r["shard"]] += 1
        slots.setdefault(r["shard"], []).append(r.slot)
    assert len(rows) == len(docs) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    for source in {d.source for d in docs.values()}:
        counts = [mixture[source, k] for k in range(8)]
        assert max(counts) - min(counts) <= 2


def test_shards_against_a_plain_ranking(spark):
    from pressmill.llm import interleave

    # One source holds most rows, one is null, rows repeat.
    data = [(i, [None, "a", "b", "b", "b", "b", "c"][i % 7]) for i in range(400)] + [(3, "b")] * 2
    rows = spark.createDataFrame(data, "doc_id long, source string")
    mix = F.xxhash64(F.lit(interleave.SEED), "doc_id").alias("mix")
    groups = {}
    for r in rows.select("doc_id", "source", mix).collect():
        groups.setdefault(r.source, []).append((r.mix, r.doc_id))
    order = sorted(
        ((n + 0.5) / len(held), source is not None, source or "", *row)
        for source, held in groups.items()
        for n, row in enumerate(sorted(held))
    )
    total, want = len(order), []
    for place, (_, _, _, _, doc_id) in enumerate(order):
        s = next(s for s in range(8) if place < -(-(s + 1) * total // 8))
        want.append((doc_id, s, place - -(-s * total // 8)))
    got = interleave.shard(rows, ["doc_id"], "source").collect()
    assert sorted((r.doc_id, r["shard"], r.slot) for r in got) == sorted(want)


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = catalog.QUERIES["op7_toxicity_trees"](spark, folder).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    bad, good = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert auc > 0.97
    assert np.mean([(s >= 0.5) == bool(y) for s, y in held]) > 0.97


def test_lexicon_pattern():
    terms = ["idiot", "id*", "scum", "scumbag"]
    pattern = re.compile(toxicity._any_of(terms).replace(r"\p{L}", "[a-z]"))
    assert pattern.match("scum ") and pattern.match("scumbag") and pattern.match("idx")
    assert not pattern.match("scums") and not pattern.match("id ")


def test_main_text_of_an_unmarked_page():
    para = "This paragraph is long enough to be seen as running text, with many words in it."
    page = f"""<html><head><title>t</title></head><body><header><h1>Site</h1></header>
    <div id="cookie-notice">{para}</div><div class="layout"><div class="sidebar"><p>{para}</p></div>
    <div><h2>Title &amp; more</h2></div><div class="content"><p>{para}&nbsp;</p><p>short</p>
    <form>Search</form><p class="ad">Buy<p>end</div><div class="comments">{para}</div>
    <div><a href=x>{para}</a></div><footer>&copy;</footer></body></html>"""
    assert html_blocks.main_text(page) == f"Title & more\n{para}\nshort\nend"


def test_main_text_keeps_short_beginnings_and_ends():
    para = "This paragraph is long enough to be seen as running text, with many words in it."
    menu = "<div><a href=x>Home</a></div>"

    def page(body):
        return f"<html><body>{menu}<div id=page>{menu}{body}<div>Imprint of us</div></div></body></html>"

    part = f"<p>Short start.</p><ul><li>x</li></ul><p>{para}</p><ul><li>y</li></ul><p>Short end.</p>"
    whole = f"Short start.\nx\n{para}\ny\nShort end."
    assert html_blocks.main_text(page(f"<div class=content>{part}</div>")) == whole
    quoted = part.replace(f"<p>{para}</p>", f"<blockquote><p>{para}</p><p>q</p></blockquote>")
    assert html_blocks.main_text(page(f"<div>{quoted}</div>")) == whole.replace(para, f"{para}\nq")
    boxed = part.replace(f"<p>{para}</p>", f"<div><div><p>{para}</p><p>q</p></div></div>")
    assert html_blocks.main_text(f"<div>{boxed}</div>") == whole.replace(para, f"{para}\nq")
    divs = f"<div>Short start.</div><div>{para}</div><div>{para}</div><div>Short end.</div>"
    each = f"Short start.\n{para}\n{para}\nShort end."
    assert html_blocks.main_text(page(f"<div class=content>{divs}</div>")) == each
    one = "<div>Short start.</div><div>" + para + "</div><div>Short end.</div>"
    assert html_blocks.main_text(page(f"<div>{one}</div>")) == f"Short start.\n{para}\nShort end."
    links = f"<ul><li><a href=x>first</a></li></ul><p>{para}</p><ul><li><a href=y>last</a></li></ul>"
    for name in ("article", "div"):
        assert html_blocks.main_text(page(f"<{name}>{links}</{name}>")) == f"first\n{para}\nlast"
    deep = "<div>" * 2_000 + f"<p>{para}</p>" + "</div><p>end</p>" * 2_000
    assert html_blocks.main_text(deep).count("end") == 2_000


STORY = "Running text of some length, with commas, that tells what happened and to whom. " * 3


def _page(body):
    return f"<html><body><nav><a href=x>menu</a></nav>{body}<footer>Imprint</footer></body></html>"


def test_main_text_weighs_marked_elements():
    story, own = STORY.strip(), f"<p>{STORY}</p>"
    for body in (
        f"<main>{own}<section><article class='comment'>{own}</article></section></main>",
        f"<article>{own}</article><section><article class='teaser'><p>{STORY[:60]}</p></article></section>",
        f"<div>{own}</div><article class='card'><p>{STORY[:90]}</p></article>",
        f"<main hidden>{own}</main><div>{own}</div>",
        f"<article>{own}<article><p>first!</p></article></article>",
        f"<main><article><article>{own}</article></article><article><p>more news</p></article></main>",
    ):
        assert html_blocks.main_text(_page(body)) == story, body
    titled = f"<main><h1>Title</h1><article class='post comments-open'>{own}</article></main>"
    assert html_blocks.main_text(_page(titled)) == f"Title\n{story}"
    several = "".join(f"<article><p>{n} {STORY}</p></article>" for n in range(3))
    assert html_blocks.main_text(_page(f"<main>{several}</main>")).count("\n") == 2
    assert html_blocks.main_text(_page("<article></article><div>short</div>")) == "short"
    assert html_blocks.main_text(_page("<article><p>short</p></article>")) == "short"


def test_surge_and_dive_against_all_windows():
    rng = np.random.default_rng(5)
    for _ in range(50):
        lines = html_blocks._Lines()
        for _ in range(rng.integers(0, 12)):
            for _ in range(rng.integers(1, 6)):
                lines.parts.append("x" * int(rng.integers(0, 70)))
                lines.end(False, 0)
            lines.border()
        got = html_blocks._stretches(lines)
        texts, weights = lines.texts, lines.weights
        runs = [i for i in range(len(texts)) if texts[i] and (i == 0 or not texts[i - 1])]
        assert [s.begin for s in got] == runs
        for s in got:
            assert all(texts[s.begin : s.dive]) and not any(texts[s.dive : s.dive + 1])
            windows = [sum(weights[max(i - html_blocks.WINDOW + 1, 0) : i + 1]) for i in range(s.begin, s.dive)]
            assert s.peak == max(windows) and s.weight == sum(weights[s.begin : s.dive])


def test_main_text_of_the_given_pages(spark, folder):
    rows = catalog.QUERIES["op1_html_blocks"](spark, folder).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    import html as library

    for r in rows:
        body = html[r.page_id].partition("<article>")[2].partition("</article>")[0]
        body = re.sub(r"<[^>]*$", "", body)
        blocks = re.split(r"</?(?:p|h1|br)>", body)
        lines = [" ".join(library.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        assert r.text == "\n".join(line for line in lines if line)
        assert r.n_chars == len(r.text)


def _plain_clean(text):
    spans = sorted((a, b, kind) for kind, a, b in _base(text))
    out, at = "", 0
    for a, b, kind in spans:
        if a >= at:
            out += text[at:a] + f"<{kind}>"
        at = max(at, b)
    return out + text[at:]


def test_pipeline_against_plain_steps(spark, folder, library):
    import corpus_pipeline

    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "personal_data", "packing"]
    given = {r.doc_id: r.text for r in documents.collect()}

    calm = stages["toxicity"](spark, documents, folder).cache()
    kept = {r.doc_id: r.text for r in calm.collect()}
    clean = [i for i in given if labels.get(i) == 0]
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)
    assert calm.columns == documents.columns and kept.items() <= given.items()

    one = stages["near_duplicates"](spark, calm, folder).cache()
    sets, parent = {i: _shingles(t) for i, t in kept.items()}, {i: i for i in kept}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            shared = len(sets[i] & sets[j])
            if j < i and shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared) - 1e-9:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    left = {r.doc_id: r.text for r in one.collect()}
    assert left == {i: kept[i] for i in kept if root(i) == i}

    clean_docs = stages["personal_data"](spark, one, folder).cache()
    texts = {r.doc_id: (r.text, r.n_chars) for r in clean_docs.collect()}
    assert texts == {i: (_plain_clean(t), len(_plain_clean(t))) for i, t in left.items()}

    pieces = stages["packing"](spark, clean_docs, folder).collect()
    sizes = Counter()
    for p in pieces:
        sizes[p.doc_id] += p.length
    ids = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, (t, _) in texts.items()}
    assert sizes == ids


def test_chat_turns_of_one_long_conversation(spark):
    n = 20_000
    rows = spark.range(n).select(
        F.lit(7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("é<|im_end|> "), F.col("id").cast("string")).alias("text"),
    )
    done = chat_format.format_conversations(rows)
    got = done.select(
        "formatted",
        "loss_spans",
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).first()
    want = [("assistant" if i % 3 else "user", f"é<|im_end|> {i}") for i in range(n)]
    assert [tuple(t) for t in got.turns] == want
    assert got.loss == "".join(text for role, text in want if role == "assistant")
    spans = [got.formatted[s.start : s.start + s.length] for s in got.loss_spans]
    assert spans == [chat_text for role, text in want if role == "assistant" for chat_text in [text.replace("<|", "<\\|")]]
