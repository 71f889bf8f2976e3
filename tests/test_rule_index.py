"""The inverted rule index against the literal form of the same rules."""

import pytest
from pyspark.sql import functions as F

from pressmill.functions.rules import Rule, RuleProfile
from pressmill.operators import rule_index as ri
from pressmill.operators import rules as ru
from pressmill.plans.standins import PACKS, articles

TABLE = "profile string, kind string, seq int, label string, pattern string"
ODD = RuleProfile(
    "odd",
    "Odd",
    core=(
        Rule("no text", r"[0-9]{3,}"),
        Rule("short", r"ab"),
        Rule("short or long", r"x|kraken"),
        Rule("look ahead", r"(?=zebra)"),
        Rule("may be empty", r"q*"),
        Rule("cyrillic", r"\bналог\w*"),
        Rule("kelvin", r"kilo"),
        Rule("either", r"zebra|kraken|\bnothing like it\b"),
        Rule("java only", r"\p{Lu}{4,}+"),
        Rule("long s", r"straße"),
    ),
    exclude=(Rule("spam", r"buy\s+now"),),
)
TEXTS = [
    "Zebra and KRAKEN 1234",
    "НАЛОГОВАЯ служба",
    "Kilo and kilo, ſtraße STRASSE straße",
    "ab",
    "BUY  now \nbuy  now",
    "",
    None,
    "x" * 30_000 + " zebra",
    "\U0001f600 kra\U0001f600ken kraken",
]


def _rows(profiles):
    return [(p.name, k, n, r.label, r.pattern) for p in profiles for k, n, r in p.rules()]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, None if i % 2 else "title", t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "ord long, title string, text string").withColumn("rule", F.lit("clash"))


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_same_hits_as_literals(spark, texts, folder):
    for profiles, rows in (([ODD], texts), (list(PACKS), articles(spark, folder))):
        index = ri.RuleIndex(spark.createDataFrame(_rows(profiles), TABLE))
        assert _sorted(index.hits(rows)) == _sorted(ru.rule_hits_long(rows, profiles))
        assert _sorted(ri.hit_counts(index.hits(rows))) == _sorted(ru.rule_hit_counts(rows, profiles))


def test_same_verdicts_as_literals(spark, texts, folder):
    kinds = "profile string, context string, require_core boolean"
    for profiles, rows in (([ODD], texts), (list(PACKS), articles(spark, folder))):
        heads = spark.createDataFrame([(p.name, p.context, p.require_core) for p in profiles], kinds)
        got = ri.fanout(rows, spark.createDataFrame(_rows(profiles), TABLE), heads)
        wanted = ru.profile_fanout(rows, profiles).select("ord", "profile", "matched_keyword")
        assert _sorted(got) == _sorted(wanted)


def test_the_plan_does_not_grow_with_the_rules(spark, texts):
    sizes = []
    for n in (5, 5000):
        rules = spark.range(n).select(
            F.lit("p").alias("profile"),
            F.lit("core").alias("kind"),
            F.col("id").cast("int").alias("seq"),
            F.lit("l").alias("label"),
            F.concat(F.lit("word"), F.col("id").cast("string"), F.lit("x")).alias("pattern"),
        )
        hits = ri.RuleIndex(rules).hits(texts)
        plan = hits._jdf.queryExecution().optimizedPlan().toString()
        assert "Cartesian" not in hits._jdf.queryExecution().executedPlan().toString()
        sizes.append(len(plan))
    assert abs(sizes[0] - sizes[1]) < 200


def test_few_pairs_run_a_pattern(spark, folder):
    """Rules that demand a rare text meet few articles."""
    rows = articles(spark, folder)
    words = rows.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{9,}"), 0)).alias("w"))
    rules = words.distinct().limit(1000).select(
        F.lit("p").alias("profile"), F.lit("core").alias("kind"), F.lit(0).alias("seq"), "w", F.col("w").alias("pattern")
    )
    index = ri.RuleIndex(rules.withColumnRenamed("w", "label"))
    pairs = index.candidates(rows.select("ord", F.lower("text").alias("folded"))).count()
    assert pairs < 0.25 * rows.count() * 1000


def test_an_article_without_the_text_is_no_candidate(spark):
    """Its trigrams are all there, the text is not."""
    index = ri.RuleIndex(spark.createDataFrame([("p", "core", 0, "l", "kraken[a-z]")], TABLE))
    rows = [(0, "kra rak ake ken"), (1, "a krakens")]
    found = index.candidates(spark.createDataFrame(rows, "ord long, folded string")).collect()
    assert [tuple(r) for r in found] == [(1, "kraken")]


def test_matches_across_the_parts_of_an_article(spark):
    """Local patterns find the first match of the whole text, wherever parts begin."""
    patterns = ["kraken[a-z]{1,3}", "[a-z]{2}kraken", "(?:kraken|zebra)[a-z]", "kraken.{0,40}zebra", "kraken ", "[a-z]*kraken"]
    profile = RuleProfile("p", "P", core=tuple(Rule(f"r{n}", p) for n, p in enumerate(patterns)))
    texts = ["-" * at + "xyKRAKENabcd kraken" + "." * 30 + "zebras kraken" for at in range(930, 1010, 3)]
    texts += ["\U0001f600" * 990 + t[900:] for t in texts[:6]] + ["kraken" * 400, "kraken-" * 400 + "krakenq"]
    rows = spark.createDataFrame([(n, "", t) for n, t in enumerate(texts)], "ord long, title string, text string")
    index = ri.RuleIndex(spark.createDataFrame(_rows([profile]), TABLE))
    assert _sorted(index.hits(rows)) == _sorted(ru.rule_hits_long(rows, [profile]))
    assert index.rules.filter("local").count() == 5


def test_no_rules_and_no_articles(spark, texts):
    none = ri.RuleIndex(spark.createDataFrame([], TABLE))
    assert none.hits(texts).count() == 0
    some = ri.RuleIndex(spark.createDataFrame(_rows([ODD]) + [("odd", "core", 9, "null", None)], TABLE))
    assert some.hits(texts.limit(0)).count() == 0
