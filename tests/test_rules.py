import re

import pytest
from pyspark.sql import functions as F

from pressmill.functions import rules as rx
from pressmill.functions.rules import Rule, RuleProfile
from pressmill.operators import rules as ru

PATTERNS = [
    r"(?<![а-яё])цб(?![а-яё])",
    r"цифров\w+\s+рубл",
    r"\bналог\w*",
    r"ставк.{0,10}рост",
    r"крипто|майнинг",
    r"\d{2,}\s?%",
    r"straße",
    r"(?:^|\W)ии(?:\W|$)",
    r"пошлин\w*\b",
    r"kin[gs]",
]
TEXTS = [
    "ЦБ поднял ставку",
    "цбр и ацб",
    "Цифрового рубля ждут",
    "НАЛОГИ, налоги-2024",
    "ставка\rи рост",
    "ставка\nрост",
    "ставка рост",
    "КРИПТОВАЛЮТА и Майнинг",
    "рост 15% и 7 %",
    "STRASSE straße STRAßE",
    "наш ИИ.",
    "пошлины",
    "KINGS and King",
    "ſkinſ",
    "",
]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_same_matches_as_python(spark, pattern):
    profile = RuleProfile("p", "P", core=(Rule("r", pattern),))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "ord long, t string")
    folded = df.withColumn("f", rx.fold(F.col("t"), [profile]))
    text = F.col("t")
    out = folded.select(
        "ord", rx.core_hits(text, profile).alias("a"), rx.core_hits(text, profile, F.col("f")).alias("b"),
        rx.matches(text, pattern, F.col("f")).alias("m"),
    ).collect()
    compiled = re.compile(pattern, re.IGNORECASE | re.UNICODE)
    for row in out:
        found = compiled.search(TEXTS[row.ord])
        expected = [("r", found.group(0))] if found and TEXTS[row.ord] else []
        assert [tuple(h) for h in row.a] == expected, (pattern, TEXTS[row.ord])
        assert [tuple(h) for h in row.b] == expected, (pattern, TEXTS[row.ord])
        assert row.m == (found is not None)


@pytest.mark.parametrize("pattern", PATTERNS + [r"a?b*", r"(ab|cd)?ef", r"x{0,3}yz", r"(?=foo)bar", r"[ab]cd"])
def test_needed_texts_occur_in_every_match(pattern):
    needed = rx.needed_texts(pattern)
    for text in TEXTS + ["ef", "abef", "yz", "xxyz", "acd", "bar"]:
        found = re.search(pattern, text, re.IGNORECASE)
        if needed and found:
            folded = text.upper().lower()
            assert any(n in folded for n in needed)


def _select(spark, profile, rows):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "ord long, title string, text string")
    return {r.ord: r.matched_keyword for r in ru.apply_profile(df, profile).collect()}


def test_exclusion_core_and_gated_secondary(spark):
    base = dict(
        core=(Rule("c", "core"), Rule("c", "core"), Rule("d", "ore")),
        secondary=(Rule("s", "second"),),
        exclude=(Rule("e", "never"),),
        context="ctx",
    )
    rows = [
        ("core", "text"),
        ("core", "never"),
        ("second", ""),
        ("second", "ctx"),
        ("core second", "CTX"),
        ("", ""),
    ]
    loose = _select(spark, RuleProfile("p", "P", **base), rows)
    assert loose == {0: "c: «core»; d: «ore»", 3: "s: «second»", 4: "c: «core»; d: «ore»; s: «second»"}
    strict = _select(spark, RuleProfile("p", "P", **base, require_core=True), rows)
    assert strict == {k: v for k, v in loose.items() if k != 3}


def test_rule_that_matches_nothing_counts(spark):
    profile = RuleProfile("p", "P", core=(Rule("any", "x*"), Rule("y", "y")))
    assert _select(spark, profile, [("abc", ""), ("y", "")]) == {0: "any: «»", 1: "any: «»; y: «y»"}


def test_matches_without_width_count(spark):
    from pressmill.functions import rules as rx
    from pyspark.sql import functions as F

    rules = [rx.Rule("ahead", "(?=foo)"), rx.Rule("java", r"\p{Lu}bar"), rx.Rule("none", "(?=zzz)")]
    row = spark.createDataFrame([("a foo Xbar",)], "t string")
    hits = F.array(*[rx.is_hit(rx.first_hit(F.col("t"), r), rules) for r in rules])
    assert row.select(hits.alias("h")).first().h[:2] == [True, True]
    assert not row.select(hits[2].alias("h")).first().h
