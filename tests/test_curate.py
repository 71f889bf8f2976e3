"""The composed run against a plain re-computation on a small corpus."""

import re

from pyspark.sql import functions as F
import pytest

from pressmill.operators.dedupe import dedupe_greedy
from pressmill.operators.rules import profile_fanout
from pressmill.operators.similarity import hashed_vectors
from pressmill.plans.curate import curate
from pressmill.plans.standins import PACKS, articles
from tests.test_dedupe import sequential
from tests.test_similarity import brute, closure


def _hits(rules, text):
    found = ((r.label, re.search(r.pattern, text, re.I)) for r in rules)
    return [(label, m.group(0)) for label, m in found if m]


def _selected(profile, text):
    if _hits(profile.exclude, text):
        return None
    core, secondary = _hits(profile.core, text), []
    if not profile.context or re.search(profile.context, text, re.I):
        secondary = _hits(profile.secondary, text)
    if not core and (profile.require_core or not secondary):
        return None
    return core + secondary


@pytest.mark.parametrize("threshold", [0.995, 0.9])
def test_curate_equals_plain_computation(spark, folder, threshold):
    items = articles(spark, folder)
    out = curate(items, list(PACKS), threshold=threshold).collect()
    rows = [r.asDict() for r in items.collect()]
    expected = set()
    for profile in PACKS:
        held = {}
        for r in rows:
            hits = _selected(profile, f"{r['title']} {r['text']}")
            if hits is not None:
                held[r["ord"]] = (r, hits)
        kept = sequential([(o, r["source"], r["url"], r["title"]) for o, (r, _) in held.items()])
        score = {o: min(30 * len(held[o][1]), 100) for o in kept}
        texts = spark.createDataFrame([(o, held[o][0]["text"]) for o in kept], "id long, text string")
        vectors = {r.id: r.vec for r in hashed_vectors(texts, "id", "text", 64).collect() if r.vec}
        group = closure(brute([(o, "t", vectors[o]) for o in vectors], threshold))
        best = {}
        for o in sorted(group):
            root = group[o]
            if root not in best or score[o] > score[best[root]]:
                best[root] = o
        left = [o for o in kept if o not in group or best[group[o]] == o]
        ranked = sorted((o for o in left if score[o] >= 30), key=lambda o: (-score[o], o))[:15]
        expected |= {(profile.name, o, n + 1, n < 10, score[o]) for n, o in enumerate(ranked)}
    assert {(r.topic, r.ord, r.top_rank, r.is_top, r.score) for r in out} == expected


def test_held_rows_are_not_added_again(spark, folder):
    profile = PACKS[1]
    items = articles(spark, folder).withColumn("url", F.concat("url", F.lit("/"), "topic"))
    held = profile_fanout(items.filter("ord < 100"), [profile]).withColumn("topic", F.col("profile"))
    held = dedupe_greedy(held, ["topic"])
    first = {r.url for r in held.collect()}
    out = curate(items, [profile], held.withColumn("title", F.lit("held")), top_n=200, reserve_n=0).collect()
    assert first and all(r.title == "held" for r in out if r.url in first)


def test_vectors_depend_on_the_words_only(spark):
    rows = [(1, "One two, two!"), (2, "two ONE two"), (3, "three"), (4, "")]
    out = hashed_vectors(spark.createDataFrame(rows, "id long, t string"), "id", "t", 32)
    vec = {r.id: r.vec and tuple(r.vec) for r in out.collect()}
    assert vec[1] == vec[2] != vec[3] and vec[4] is None
    assert abs(sum(x * x for x in vec[1]) - 1) < 1e-6


def test_an_article_without_text_stays(spark):
    rows = [(n, "s", f"u{n}", f"licence {n}", text) for n, text in ((1, "some words"), (2, ""), (3, None))]
    items = spark.createDataFrame(rows, "ord long, source string, url string, title string, text string")
    out = curate(items.withColumn("topic", F.lit("t")), [PACKS[0]], top_n=9, reserve_n=0)
    assert sorted(r.ord for r in out.collect()) == [1, 2, 3]
