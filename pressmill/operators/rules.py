"""Rule profiles applied to articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressmill.functions import rules as rx
from pressmill.functions.rules import Rule, RuleProfile
from pressmill.functions.text import search_text

TEXT, FOLDED = "_search_text", "_folded"


def with_search_text(articles: DataFrame, profiles: list[RuleProfile]) -> DataFrame:
    """Adds the searched text and its folded form, each computed once per row."""
    texts = articles.withColumn(TEXT, search_text(F.col("title"), F.col("text")))
    return texts.withColumn(FOLDED, rx.fold(F.col(TEXT), profiles))


def apply_profile(articles: DataFrame, profile: RuleProfile) -> DataFrame:
    """Rows that pass one profile, with ``matched_keyword`` set to the evidence."""
    return profile_fanout(articles, [profile]).drop("profile")


def profile_fanout(
    articles: DataFrame, profiles: list[RuleProfile], first: str | None = None
) -> DataFrame:
    """A row per article and profile it passes, evaluated in one scan.

    Exclusions are tested first and the hit arrays are built only where none
    hits; verdict and evidence both come from those arrays. ``first`` names a column
    that marks one row of each article that passes at all.
    """
    text, folded = F.col(TEXT), F.col(FOLDED)
    hits = []
    for profile in profiles:
        found = F.struct(
            F.lit(profile.name).alias("profile"),
            F.lit(profile.require_core).alias("require_core"),
            rx.core_hits(text, profile, folded).alias("core"),
            rx.secondary_hits(text, profile, folded).alias("secondary"),
        )
        hits.append(F.when(~rx.excluded(text, profile, folded), found))
    keep = [c for c in articles.columns if c != "matched_keyword"]
    core, secondary = F.col("hit.core"), F.col("hit.secondary")

    def passed(hit: Column) -> Column:
        return (F.size(hit["core"]) > 0) | (~hit["require_core"] & (F.size(hit["secondary"]) > 0))

    mark = []
    if first is not None:
        earliest = F.get(F.filter("_verdicts", passed), F.lit(0))["profile"]
        mark = [(F.col("hit.profile") == earliest).alias(first)]
    return (
        with_search_text(articles, profiles)
        .withColumn("_verdicts", F.array(*hits))
        .withColumn("hit", F.explode_outer("_verdicts"))
        .filter(passed(F.col("hit")))
        .select(
            *keep,
            *mark,
            F.col("hit.profile").alias("profile"),
            rx.evidence(core, secondary).alias("matched_keyword"),
            (F.size(core) + F.size(secondary)).alias("n_hits"),
        )
    )


def excluded_rows(articles: DataFrame, profiles: list[RuleProfile]) -> DataFrame:
    """Audit of exclusions: a row per article and profile with the labels that hit."""
    text, folded = F.col(TEXT), F.col(FOLDED)
    found = F.array(
        *[
            F.struct(F.lit(p.name).alias("profile"), rx.exclude_hits(text, p, folded).alias("hits"))
            for p in profiles
        ]
    )
    return (
        with_search_text(articles, profiles)
        .select("ord", F.explode(found).alias("x"))
        .filter(F.size("x.hits") > 0)
        .select(
            "ord",
            "x.profile",
            F.array_join(F.transform("x.hits", lambda h: h["label"]), "; ").alias("labels"),
        )
    )


def verdict_counts(articles: DataFrame, profiles: list[RuleProfile], by: list[str]) -> DataFrame:
    """Kept and total articles per profile and ``by``, with subtotals (rollup)."""
    text, folded = F.col(TEXT), F.col(FOLDED)
    verdicts = F.array(
        *[
            F.struct(
                F.lit(p.name).alias("profile"),
                rx.passes(
                    text, rx.core_hits(text, p, folded), rx.secondary_hits(text, p, folded), p, folded
                ).alias("kept"),
            )
            for p in profiles
        ]
    )
    flags = with_search_text(articles, profiles).select(*by, F.explode(verdicts).alias("v"))
    return (
        flags.select("v.profile", *by, "v.kept")
        .rollup("profile", *by)
        .agg(
            F.count_if("kept").alias("kept"),
            F.count(F.lit(1)).alias("total"),
            F.count_if(~F.col("kept")).alias("skipped"),
        )
    )


def profiles_from_table(rules: DataFrame, heads: list[RuleProfile]) -> list[RuleProfile]:
    """Compile a rule table ``(profile, kind, seq, label, pattern)``.

    ``heads`` give name, title, context and the core requirement. Rules are code:
    they become the literals of a plan, whatever their number.
    """
    held = rules.select("profile", "kind", "seq", "label", "pattern").collect()
    held.sort(key=lambda r: r["seq"])

    def pack(name: str, kind: str) -> tuple[Rule, ...]:
        return tuple(
            Rule(r["label"], r["pattern"]) for r in held if r["profile"] == name and r["kind"] == kind
        )

    return [
        RuleProfile(
            head.name,
            head.title,
            *(pack(head.name, kind) for kind in ("core", "secondary", "exclude")),
            head.context,
            head.require_core,
        )
        for head in heads
    ]


def _all_hits(articles: DataFrame, profiles: list[RuleProfile]) -> DataFrame:
    """``(ord, hits)``: all rules that match, in one array per article.

    To be unnested with ``explode_outer``: from a plain ``explode`` the planner
    derives a filter on the array's size, and evaluates all rules for it once more.
    """
    text, folded = F.col(TEXT), F.col(FOLDED)
    cells = []
    for profile in profiles:
        for kind, seq, rule in profile.rules():
            hit = rx.first_hit(text, rule, folded)
            cells.append(
                F.struct(
                    F.lit(profile.name).alias("profile"),
                    F.lit(kind).alias("kind"),
                    F.lit(seq).alias("seq"),
                    hit["label"].alias("label"),
                    hit["fragment"].alias("fragment"),
                )
            )
    rules = [rule for profile in profiles for _, _, rule in profile.rules()]
    found = F.filter(F.array(*cells), lambda c: rx.is_hit(c, rules))
    return with_search_text(articles, profiles).select("ord", found.alias("hits"))


def rule_hits_long(articles: DataFrame, profiles: list[RuleProfile]) -> DataFrame:
    """``(ord, profile, kind, seq, label, fragment)``, a row per rule that matches.

    Context and exclusion are not applied: this is the raw evidence per rule.
    """
    cells = _all_hits(articles, profiles).select("ord", F.explode_outer("hits").alias("h"))
    return cells.filter("h is not null").select("ord", "h.*")


def rule_hit_counts(articles: DataFrame, profiles: list[RuleProfile]) -> DataFrame:
    """Articles per profile and rule label.

    An article counts once per label even if several rules share it; repeats are
    removed inside the row, so only partial counts are shuffled.
    """
    labels = F.array_distinct(
        F.transform("hits", lambda h: F.struct(h["profile"], h["kind"], h["label"]))
    )
    return (
        _all_hits(articles, profiles)
        .select(F.explode_outer(labels).alias("l"))
        .filter("l is not null")
        .groupBy("l.profile", "l.kind", "l.label")
        .agg(F.count(F.lit(1)).alias("n_articles"))
    )


def hit_column(articles: DataFrame, hits: Column, profiles: list[RuleProfile], out: str = "hit") -> DataFrame:
    """Long form of a hit array: ``(ord, pos, label, fragment)``."""
    return (
        with_search_text(articles, profiles)
        .select("ord", F.posexplode(hits).alias("pos", out))
        .select("ord", "pos", f"{out}.label", f"{out}.fragment")
    )
