"""Queries of the rule profiles and article filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressmill.functions import rules as rx
from pressmill.functions import text as tx
from pressmill.operators import articles as ar
from pressmill.operators import quality as ql
from pressmill.operators import rule_index as ri
from pressmill.operators import rules as ru
from pressmill.operators import windows as wn
from pressmill.plans.registry import query
from pressmill.plans.standins import (
    ART,
    HITS,
    LABELLED,
    PACKS,
    ST,
    VERDICTS,
    articles,
    sql_text,
    table,
)

_LONG = """SELECT ord, CAST(pos - 1 AS INTEGER) AS pos, hit.label AS label, hit.fragment AS fragment
  FROM (SELECT ord, unnest({hits}) AS hit, generate_subscripts({hits}, 1) AS pos FROM hits WHERE profile = '{name}')"""


@query("rule_core_match", f"WITH {HITS} " + _LONG.format(hits="core", name="alpha"))
def rule_core_match(spark, d):
    return ru.hit_column(articles(spark, d, heavy=True), rx.core_hits(F.col(ru.TEXT), PACKS[0], F.col(ru.FOLDED)), [PACKS[0]])


@query(
    "rule_secondary_match",
    f"WITH {HITS} " + _LONG.format(hits="(core || secondary)", name="alpha"),
)
def rule_secondary_match(spark, d):
    text, folded = F.col(ru.TEXT), F.col(ru.FOLDED)
    both = F.concat(rx.core_hits(text, PACKS[0], folded), rx.secondary_hits(text, PACKS[0], folded))
    return ru.hit_column(articles(spark, d, heavy=True), both, [PACKS[0]])


@query(
    "rule_exclude",
    f"""WITH {HITS} SELECT ord, profile, array_to_string([x.label FOR x IN excl], '; ') AS labels
    FROM hits WHERE len(excl) > 0""",
)
def rule_exclude(spark, d):
    return ru.excluded_rows(articles(spark, d, heavy=True), list(PACKS))


@query(
    "profile_filter",
    f"WITH {VERDICTS} SELECT a.ord, a.source, a.title FROM verdicts v JOIN art a USING (ord) WHERE kept AND profile = 'beta'",
)
def profile_filter(spark, d):
    return ru.apply_profile(articles(spark, d, heavy=True), PACKS[1]).select("ord", "source", "title")


_EVIDENCE = """array_to_string([(core || secondary)[i].label || ': «' || (core || secondary)[i].fragment || '»'
      FOR i IN range(1, len(core || secondary) + 1)
      IF list_position(core || secondary, (core || secondary)[i]) = i], '; ')"""


@query(
    "matched_keywords",
    f"WITH {VERDICTS} SELECT ord, {_EVIDENCE} AS matched_keyword FROM verdicts WHERE kept AND profile = 'beta'",
)
def matched_keywords(spark, d):
    return ru.apply_profile(articles(spark, d, heavy=True), PACKS[1]).select("ord", "matched_keyword")


@query(
    "profile_fanout",
    f"WITH {VERDICTS} SELECT ord, profile, {_EVIDENCE} AS matched_keyword FROM verdicts WHERE kept",
)
def profile_fanout(spark, d):
    return ru.profile_fanout(articles(spark, d, heavy=True), list(PACKS)).select("ord", "profile", "matched_keyword")


_ALL_HITS = (
    ST
    + ", long AS ("
    + " UNION ALL ".join(
        f"SELECT ord, {sql_text(p.name)} AS profile, {sql_text(kind)} AS kind, {seq} AS seq, "
        f"{sql_text(r.label)} AS label, regexp_extract(txt, {sql_text('(?i)' + r.pattern)}, 0) AS fragment FROM st"
        for p in PACKS
        for kind, seq, r in p.rules()
    )
    + ")"
)


@query("rule_hits_long", f"WITH {_ALL_HITS} SELECT * FROM long WHERE fragment <> ''")
def rule_hits_long(spark, d):
    rows = [(p.name, k, n, r.label, r.pattern) for p in PACKS for k, n, r in p.rules()]
    rules = spark.createDataFrame(rows, "profile string, kind string, seq int, label string, pattern string")
    heads = [rx.RuleProfile(p.name, p.title, context=p.context, require_core=p.require_core) for p in PACKS]
    return ru.rule_hits_long(articles(spark, d, heavy=True), ru.profiles_from_table(rules, heads))


#: Patterns made of each longer word of ``benchmark``; some 5,000 rules at sf0.01.
_VARIANTS = (
    "{w}",
    "{w}[a-z]{{1,3}}",
    "[a-z]{{2}}{w}",
    "{w}[ ,.]+[a-z]+",
    "(?:{w}|{r})[a-z]",
    "{s}[a-z]*",
    "[0-9]+ {w}",
    "(?:un|re|ge|de){s}",
)


def _word_rules(spark, d):
    words = table(spark, d, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0)).alias("w")
    )
    words = words.distinct().filter("length(w) >= 5")
    parts = {"w": F.col("w"), "r": F.reverse("w"), "s": F.substring("w", 1, 5)}
    cells = []
    for seq, form in enumerate(_VARIANTS):
        pattern = F.lit(form.replace("{{", "{").replace("}}", "}"))
        for name, value in parts.items():
            pattern = F.replace(pattern, F.lit(f"{{{name}}}"), value)
        kind = ("core", "secondary", "exclude")[seq % 3]
        cells.append(F.struct(F.lit(kind).alias("kind"), F.lit(seq).alias("seq"), pattern.alias("pattern")))
    rules = words.select(F.substring("w", 1, 1).alias("profile"), F.col("w").alias("label"), F.inline(F.array(*cells)))
    return rules.select("profile", "kind", "seq", "label", "pattern")


_SQL_VARIANTS = ", ".join(
    "{'kind': '%s', 'seq': %d, 'pattern': %s}"
    % (
        ("core", "secondary", "exclude")[seq % 3],
        seq,
        "replace(replace(replace('%s', '{w}', w), '{r}', reverse(w)), '{s}', substr(w, 1, 5))"
        % form.replace("{{", "{").replace("}}", "}"),
    )
    for seq, form in enumerate(_VARIANTS)
)
_WORD_HITS = (
    ST
    + f""", words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM benchmark),
  rules AS (SELECT substr(w, 1, 1) AS profile, w AS label, unnest([{_SQL_VARIANTS}], recursive := true)
    FROM words WHERE length(w) >= 5),
  tried AS (SELECT ord, profile, kind, CAST(seq AS INTEGER) AS seq, label,
      regexp_extract(txt, '(?i)' || pattern, 0) AS fragment
    FROM st JOIN rules ON contains(lower(txt), substr(label, 1, 5)) OR contains(lower(txt), substr(reverse(label), 1, 5))),
  long AS (SELECT * FROM tried WHERE fragment <> '')"""
)


@query("rule_hits_indexed", f"WITH {_WORD_HITS} SELECT * FROM long")
def rule_hits_indexed(spark, d):
    """Thousands of rules as rows: an inverted index instead of plan literals."""
    return ri.RuleIndex(_word_rules(spark, d)).hits(articles(spark, d, heavy=True))


@query(
    "rule_hit_counts_indexed",
    f"WITH {_WORD_HITS} SELECT profile, kind, label, count(DISTINCT ord) AS n_articles FROM long GROUP BY ALL",
)
def rule_hit_counts_indexed(spark, d):
    return ri.hit_counts(rule_hits_indexed(spark, d))


def _pack_table(spark):
    rows = [(p.name, k, n, r.label, r.pattern) for p in PACKS for k, n, r in p.rules()]
    return spark.createDataFrame(rows, "profile string, kind string, seq int, label string, pattern string")


@query(
    "profile_fanout_indexed",
    f"WITH {VERDICTS} SELECT ord, profile, {_EVIDENCE} AS matched_keyword FROM verdicts WHERE kept",
)
def profile_fanout_indexed(spark, d):
    """All profiles from a rule table."""
    heads = [(p.name, p.context, p.require_core) for p in PACKS]
    heads = spark.createDataFrame(heads, "profile string, context string, require_core boolean")
    return ri.fanout(articles(spark, d, heavy=True), _pack_table(spark), heads)


@query(
    "rule_hit_counts",
    f"""WITH {_ALL_HITS} SELECT profile, kind, label, count(DISTINCT ord) AS n_articles
    FROM long WHERE fragment <> '' GROUP BY ALL""",
)
def rule_hit_counts(spark, d):
    return ru.rule_hit_counts(articles(spark, d, heavy=True), list(PACKS))


@query(
    "filter_pass_rate",
    f"""WITH {VERDICTS} SELECT profile, news_date, count(*) FILTER (kept) AS kept, count(*) AS total,
    count(*) FILTER (NOT kept) AS skipped FROM verdicts JOIN art USING (ord) GROUP BY ROLLUP (profile, news_date)""",
)
def filter_pass_rate(spark, d):
    return ru.verdict_counts(articles(spark, d, heavy=True), list(PACKS), ["news_date"])


TODAY = "2024-01-25"

DAYS = """keys AS (
  SELECT event_type, CAST(ts AS DATE) AS day, event_id % 4 AS form, count(*) AS n FROM events GROUP BY ALL)"""


def _day_keys(spark, d):
    """Day keys as sources write them: dashes, slashes and unreadable ones."""
    day, form = F.to_date("ts"), F.col("event_id") % 4
    key = (
        F.when(form == 0, F.date_format(day, "yyyy/MM/dd"))
        .when(form == 3, F.lit("not a day"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    return table(spark, d, "events").select("event_type", key.alias("key"), "event_id")


@query(
    "date_window_exact",
    f"""WITH {DAYS}, k AS (SELECT *, CASE form WHEN 0 THEN strftime(day, '%Y/%m/%d') ELSE strftime(day, '%Y-%m-%d') END AS key FROM keys)
    SELECT event_type, key, CAST(sum(n) AS BIGINT) AS n FROM k
    WHERE day BETWEEN DATE '{TODAY}' - 9 AND DATE '{TODAY}' AND ((event_type = 'view' AND form = 0) OR (event_type <> 'view' AND form IN (1, 2)))
    GROUP BY ALL""",
)
def date_window_exact(spark, d):
    keys = _day_keys(spark, d)
    fmt = F.when(F.col("event_type") == "view", "yyyy/MM/dd").otherwise("yyyy-MM-dd")
    keep = wn.in_source_window(F.col("key"), fmt, 10, F.lit(TODAY).cast("date"))
    return keys.filter(keep).groupBy("event_type", "key").agg(F.count(F.lit(1)).alias("n"))


@query(
    "date_window_cutoff",
    f"""WITH {DAYS} SELECT event_type, strftime(day, '%Y-%m-%d') AS key, CAST(sum(n) AS BIGINT) AS n FROM keys
    WHERE day >= DATE '{TODAY}' - 10 AND form IN (1, 2) GROUP BY ALL""",
)
def date_window_cutoff(spark, d):
    keys = _day_keys(spark, d)
    keep = wn.in_source_window(F.col("key"), "", 10, F.lit(TODAY).cast("date"))
    return keys.filter(keep).groupBy("event_type", "key").agg(F.count(F.lit(1)).alias("n"))


INCOMPLETE = (
    ART
    + """, parts AS (
  SELECT ord, source, CAST(substr(source, 4) AS INTEGER) AS s,
    CASE WHEN ord % 17 = 0 THEN ' ' ELSE url END AS url,
    CASE WHEN ord % 13 = 0 THEN '' ELSE title END AS title,
    CASE WHEN ord % 7 = 0 THEN '' ELSE text END AS text,
    CASE WHEN ord % 19 = 0 THEN '' ELSE CAST(news_date AS VARCHAR) END AS date FROM art),
  reasons AS (SELECT *, CASE WHEN trim(url) = '' THEN 'empty_url'
    WHEN s < 10 AND s % 2 = 0 AND text = '' THEN 'empty_text' WHEN date = '' THEN 'empty_date'
    WHEN title = '' THEN 'empty_title' END AS kind FROM parts)"""
)


def incomplete(spark, d):
    def blank(name, every, value=""):
        return F.when(F.col("ord") % every == 0, F.lit(value)).otherwise(F.col(name).cast("string"))

    return articles(spark, d).select(
        "ord",
        "source",
        blank("url", 17, " ").alias("url"),
        blank("title", 13).alias("title"),
        blank("text", 7).alias("text"),
        blank("news_date", 19).alias("date"),
    )


@query("drop_incomplete", f"WITH {INCOMPLETE} SELECT ord, source, url FROM reasons WHERE kind IS NULL")
def drop_incomplete(spark, d):
    return ar.drop_incomplete(incomplete(spark, d), LABELLED).select("ord", "source", "url")


@query(
    "run_stats",
    f"WITH {INCOMPLETE} SELECT kind, count(*) AS n, count(DISTINCT url) AS n_targets FROM reasons WHERE kind IS NOT NULL GROUP BY kind",
)
def run_stats(spark, d):
    return ql.run_stats(ar.reject_rows(incomplete(spark, d), LABELLED))


_REASONS = ["empty_url", "empty_text", "empty_date", "empty_title", "digest"]
_OUTCOMES = (
    INCOMPLETE
    + """, outcomes AS (SELECT ord, source, CASE WHEN kind IS NOT NULL THEN kind
    WHEN contains(lower(title), 'and the') THEN 'digest' END AS reason FROM reasons)"""
)


def _outcomes(spark, d):
    digest = F.when(ar.is_digest(F.col("title"), ("and the",)), "digest")
    return ql.split_rows(incomplete(spark, d), F.coalesce(ar.incomplete_reason(LABELLED), digest), _REASONS)


@query(
    "reject_channel",
    f"WITH {_OUTCOMES} SELECT ord, source, reason FROM outcomes",
)
def reject_channel(spark, d):
    """Kept and rejected rows of one pass, each side read from its own folder."""
    kept, rejected, _ = _outcomes(spark, d)
    kept = kept.select("ord", "source", F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(rejected.select("ord", "source", "reason"))


@query(
    "reject_counts",
    f"""WITH {_OUTCOMES}, names AS (SELECT unnest({["kept", *_REASONS]}) AS reason)
    SELECT reason, count(ord) AS n FROM names
    LEFT JOIN (SELECT ord, coalesce(reason, 'kept') AS reason FROM outcomes) USING (reason) GROUP BY reason""",
)
def reject_counts(spark, d):
    """The counts that the write of the reject channel takes."""
    return _outcomes(spark, d)[2]


@query(
    "drop_digests",
    f"""WITH {ART} SELECT ord, title FROM art
    WHERE NOT (contains(lower(title), 'and the') OR contains(lower(title), 'der die') OR contains(lower(title), ' é'))""",
)
def drop_digests(spark, d):
    phrases = ("and the", "der die", " é")
    return articles(spark, d).filter(~ar.is_digest(F.col("title"), phrases)).select("ord", "title")


_CATEGORIES = ("THE", "DER", "LA")


@query(
    "category_filter",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
    h AS (SELECT *, length(line) < 40 AS heading, CASE WHEN contains(upper(line), 'THE') THEN 'THE'
        WHEN contains(upper(line), 'DER') THEN 'DER' WHEN contains(upper(line), 'LA') THEN 'LA' ELSE '' END AS named FROM l),
    c AS (SELECT *, last_value(CASE WHEN heading THEN named END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS category FROM h)
    SELECT doc_id, CAST(pos AS INTEGER) AS pos, category, md5(line) AS line_md5 FROM c
    WHERE NOT heading AND category <> '' AND length(line) > 60""",
)
def category_filter(spark, d):
    entries = ar.category_lines(F.split("text", "\n"), _CATEGORIES, r"^.{0,39}$", 60)
    out = table(spark, d, "documents").select("doc_id", F.explode(entries).alias("e"))
    return out.select("doc_id", "e.pos", "e.category", F.md5("e.line").alias("line_md5"))


@query(
    "min_length_filter",
    """SELECT doc_id, CAST(len([x FOR x IN string_split(text, chr(10)) IF length(trim(x)) > 10]) AS INTEGER) AS n_kept,
    md5(array_to_string([x FOR x IN string_split(text, chr(10)) IF length(trim(x)) > 10], chr(10))) AS text_md5
    FROM documents""",
)
def min_length_filter(spark, d):
    kept = tx.long_paragraphs(F.split("text", "\n"), 10)
    out = table(spark, d, "documents").select("doc_id", kept.alias("k"))
    return out.select("doc_id", F.size("k").alias("n_kept"), F.md5(F.array_join("k", "\n")).alias("text_md5"))
