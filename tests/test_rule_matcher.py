"""Rules tried on folded texts in workers, against the literal form that Java runs."""

import pytest

from pressmill.functions import rules as rx
from pressmill.functions.rules import Rule, RuleProfile
from pressmill.operators import rule_index as ri
from pressmill.operators import rule_matcher as rm
from pressmill.operators import rules as ru
from pressmill.plans.standins import PACKS, articles

TABLE = "profile string, kind string, seq int, label string, pattern string"
PATTERNS = [
    "kiss", "[a-z]+kiss", "kiss[a-z]*", "[^a-z]kiss", "[^k]iss", "[ks]iss", "k[i-t]ss", "[A-Za-z]{2}iss", "[A-Z]iss",
    "(?:kiss|sink)[a-z]?", "(?:kiss|sink|kissing) {0,3}[0-9]+", "[0-9]+ kiss", r"\d+\skiss", r"kiss\s+\d{2,}", "^kiss",
    "(^|[^a-z])kiss", "kiss.{0,9}sink", "kiss.*?sink", "(kiss|kisses)+s", "(?:si|ki)+nk", "été", "[éà]t[éè]", "σας",
    "straße", r"kiss\b", r"\w+kiss", "(?=kiss)", "k?i?", r"\.kiss", "kiss[.]", "[^.]kiss[^.]", "(?:ab){2,3}kiss", "xkiss|kissx",
]
TEXTS = [
    "Kiss KISS kiſs KİSS kıss",
    "12 kiss 34 KISS 56 ١٢ kiss 7\x1ckiss  789",
    "sinkSINK kisses kissss kississ sikink abABabKISSx",
    "ÉTÉ àtè ΣΑΣ σας straße STRASSE",
    "k.kiss.kiss\nsink kiss \n sink",
    "\U0001f600kiss\U0001f600 \U00010400kiss x\U0001f6001 kiss",
    "." * 5000 + "0kiss" + " sink" * 40 + "KISS 1234",
    "", None, "kis", "iss", "skiss\0kiss\0sink9",
]


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _table(spark, profile):
    rows = [(profile.name, k, n, r.label, r.pattern) for k, n, r in profile.rules()]
    return spark.createDataFrame(rows, TABLE)


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, "kiss" if i % 3 else "", t) for i, t in enumerate(TEXTS)], "ord long, title string, text string")


def test_folded_patterns_find_what_java_finds(spark, texts):
    profile = RuleProfile("p", "P", core=tuple(Rule(f"r{n}", p) for n, p in enumerate(PATTERNS)))
    index = ri.RuleIndex(_table(spark, profile))
    assert index.n_folded > 20 and index.n_java > 3
    assert _sorted(index.hits(texts)) == _sorted(ru.rule_hits_long(texts, [profile]))


def test_no_article_is_shuffled_or_joined(spark, folder):
    rules = spark.createDataFrame([(p.name, k, n, r.label, r.pattern) for p in PACKS for k, n, r in p.rules()], TABLE)
    hits = ri.RuleIndex(rules).hits(articles(spark, folder))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_many_rules_share_a_text(spark, texts, monkeypatch):
    monkeypatch.setattr(rm, "SHARE", 4)
    monkeypatch.setattr(ri, "SLICE_RULES", 9)
    rules = tuple(Rule(f"r{n}", f"(?:kiss|sink{n % 3})[a-z ]{{0,{n}}}") for n in range(30))
    profile = RuleProfile("p", "P", core=rules)
    assert _sorted(ri.RuleIndex(_table(spark, profile)).hits(texts)) == _sorted(ru.rule_hits_long(texts, [profile]))


def test_places_of_needed_texts():
    inf = rx._parsed("a+").getwidth()[1]
    digit = rx.folded_pattern("[0-9]")
    assert rx.needed_places("[0-9]{2}kiss") == [(2, 2, digit, None)]
    assert rx.needed_places("[0-9]+ kiss") == [(1, inf, digit, None)]
    assert rx.needed_places("(?:kiss|sink)[0-9]") == [(0, 0, None, digit)] * 2
    assert rx.needed_places("x?kiss") == [(0, 1, None, None)]
    assert rx.needed_places("(?:kiss[0-9])+") == [(0, 0, None, digit)]
    assert [rx.folded_pattern(p) for p in (r"\bkiss", "(?i)kiss", "[a[b]]", "x{,3}", "straße", "[A-Z]", "q++")] == [None] * 7


def test_finder_gives_every_place():
    texts = ["kiss", "kissing", "sin", "ssi", "kisskiss"]
    rows = ["kisskissing", "ki", "ss in", "", "asinkiss"]
    found = rm.TextFinder(texts).places(*rm.joined(rows))
    ends = rm.joined(rows)[1]
    got = {(int(r), texts[t], int(p) - (int(ends[r - 1]) + 1 if r else 0)) for r, t, p in zip(*found)}
    wanted = {(r, t, p) for r, row in enumerate(rows) for t in texts for p in range(len(row)) if row.startswith(t, p)}
    assert got == wanted
