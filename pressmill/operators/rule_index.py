"""Rule tables of any size: an inverted index from required texts to rules.

Rules are rows, not plan literals. From each pattern come the texts of which every match
holds one, and where in a match they stand. The articles pass once through workers that find
all places of all these texts (``rule_matcher``) and try a rule only there, as a Python
pattern on the folded article; no text is shuffled. Rules that demand no text of three
characters can match any article and are tried on each. The rules come to the workers in
slices of some ``SLICE_RULES``.

A pattern that Python is not known to match as Java does stays with Java: its candidates are
joined with the articles, and the pattern is a column. One of bounded width that looks at its
match alone runs on the article's parts that hold the text.

Defined results: those of the literal form (``rules.rule_hits_long``); rules that are
equal rows hit as often as they occur; a null pattern never hits; an article needs a
unique ``ord``; without rules or articles there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pressmill.functions import rules as rx
from pressmill.functions.text import search_text
from pressmill.operators.rule_matcher import Matcher, TextFinder, joined, text_steps
from pressmill.session import written

SLICES = 16
#: Rules whose index is sent to the workers at once.
SLICE_RULES = 100_000
#: Characters of a text that tells where a rule is tried.
SHORT = 3
#: Characters at which a match may start in a part of an article, and the widest match.
STEP, WIDTH = 1000, 60
_RULE = ["profile", "kind", "seq", "label", "pattern"]


def _demands(rules: DataFrame) -> DataFrame:
    """``rules`` with ``needed`` (texts of which a match holds one) and their ``places``,
    ``may_be_empty``, ``local`` and the pattern for folded texts, null where Java is needed."""

    def place(low: int, high: int, left: str | None, right: str | None) -> dict:
        return {"low": low, "high": high if high < 2**31 else None, "left": left, "right": right}

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part["needed"] = [list(rx.needed_texts(p)) for p in part["pattern"]]
            part["places"] = [[place(*at) for at in rx.needed_places(p)] for p in part["pattern"]]
            part["may_be_empty"] = [rx.may_be_empty(p) for p in part["pattern"]]
            part["local"] = [rx.is_local(p, WIDTH) for p in part["pattern"]]
            part["folded"] = [rx.folded_pattern(p) for p in part["pattern"]]
            yield part

    kinds = ", ".join(f"{n} {k}" for n, k in rules.dtypes)
    places = "places array<struct<low:long,high:long,left:string,right:string>>"
    return rules.mapInPandas(
        read, f"{kinds}, needed array<string>, {places}, may_be_empty boolean, local boolean, folded string"
    )


def _parts(text: Column) -> Column:
    """Overlapping parts of a text; each match of a local pattern lies in that of its start.

    Places in a part are told in UTF-16 units, so a text with wider characters is one part.
    """
    wide = F.regexp_like(text, F.lit(r"[\x{10000}-\x{10FFFF}]"))
    step = F.when(wide, F.greatest(F.length(text), F.lit(1))).otherwise(F.lit(STEP))
    last = F.floor(F.greatest(F.length(text) - 1, F.lit(0)) / step)
    cut = F.transform(
        F.sequence(F.lit(0).cast("long"), last),
        lambda i: F.substr(text, (i * step + 1).cast("int"), (step + WIDTH).cast("int")),
    )
    limit = F.when(wide, F.lit(2**31 - 1)).otherwise(F.lit(STEP))
    return F.transform(cut, lambda p: F.struct(p.alias("text"), rx.fold_all(p).alias("folded"), limit.alias("limit")))


def _starts_in(part: Column, pattern: Column) -> Column:
    return F.call_function("regexp_instr", part["text"], pattern).between(F.lit(1), part["limit"])


def _local_fragment(near: Column, pattern: Column) -> Column:
    """First match of a local pattern in the parts that hold its text; mostly in the first."""
    first = F.get(near, F.lit(0))
    rest = F.get(F.filter(near, lambda p: _starts_in(p, pattern)), F.lit(0))

    def found(part: Column) -> Column:
        return F.call_function("regexp_extract", part["text"], pattern, F.lit(0))

    return F.when(_starts_in(first, pattern), found(first)).otherwise(F.coalesce(found(rest), F.lit("")))


class RuleIndex:
    """An index of ``rules`` (``profile, kind, seq, label, pattern``), written once."""

    def __init__(self, rules: DataFrame):
        numbered = rules.filter("pattern is not null").select(
            F.monotonically_increasing_id().alias("rule"), *_RULE
        )
        # Parsing is the work here, and the rules may come in one small partition.
        dealt = numbered.repartition(rules.sparkSession.sparkContext.defaultParallelism)
        self.rules = written(_demands(dealt), "rules")
        told = (F.size("needed") > 0) & F.forall("needed", lambda t: F.length(t) >= SHORT)
        self.sorted = self.rules.withColumn("told", told)
        sizes = self.sorted.agg(
            F.count_if(F.col("folded").isNotNull()), F.count_if(F.col("folded").isNull())
        ).first()
        self.n_folded, self.n_java = sizes
        java = self.sorted.filter("folded is null").drop("places", "folded", "told")
        #: A row per rule and text: the rules to try where ``one`` is found.
        self.told = java.filter(told).withColumn("one", F.explode("needed"))
        self.anywhere = java.filter(~told).withColumn(
            "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long")))
        )

    def candidates(self, articles: DataFrame, java_only: bool = False) -> DataFrame:
        """``(ord, one)``: needed texts that an article has; it has ``ord, folded``."""
        rules = self.sorted.filter("told")
        rules = rules.filter("folded is null") if java_only else rules
        texts = sorted(r[0] for r in rules.select(F.explode("needed")).distinct().collect())
        held = articles.sparkSession.sparkContext.broadcast(TextFinder(texts))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            every = pa.array(texts, pa.string())
            for batch in batches:
                for part in text_steps(batch, "folded"):
                    rows, found, _ = held.value.places(*joined(part.column("folded").to_pylist()))
                    pairs = sorted(set(zip(rows.tolist(), found.tolist())))
                    of, one = (pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1))
                    yield pa.RecordBatch.from_arrays([part.column("ord").take(of), every.take(one)], ["ord", "one"])

        kind = articles.schema["ord"].dataType.simpleString()
        told = articles.select("ord", "folded").filter("ord is not null and folded is not null")
        return told.mapInArrow(run, f"ord {kind}, one string").distinct()

    def hits(self, articles: DataFrame) -> DataFrame:
        """``(ord, profile, kind, seq, label, fragment)``, a row for each rule that matches."""
        text = search_text(F.col("title"), F.col("text"))
        texts = articles.select("ord", text.alias("searched"))
        slices = max(-(-self.n_folded // SLICE_RULES), 1)
        found = self._folded_hits(texts, 0, slices)
        for n in range(1, slices):
            found = found.unionByName(self._folded_hits(texts, n, slices))
        return found.unionByName(self._java_hits(texts)) if self.n_java else found

    def _folded_hits(self, texts: DataFrame, n: int, slices: int) -> DataFrame:
        """Hits of one slice of the rules that run on folded texts."""
        mine = F.pmod(F.xxhash64("rule"), F.lit(slices)) == n
        rules = self.sorted.filter("folded is not null").filter(mine)
        rules = [r.asDict(recursive=True) for r in rules.collect()]
        kinds = {c: self.rules.schema[c].dataType for c in _RULE[:-1]}
        columns = [pa.array([r[c] for r in rules], to_arrow_type(k)) for c, k in kinds.items()]
        columns = pa.RecordBatch.from_arrays(columns, list(kinds))
        matcher = Matcher(rules, [r["told"] for r in rules], columns)
        held = texts.sparkSession.sparkContext.broadcast(matcher)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = held.value
            for batch in batches:
                for part in text_steps(batch, "searched"):
                    ids = part.column("ord")
                    # A row without ``ord`` meets only the rules that are tried on every row.
                    known = ids.is_valid().to_pylist()
                    for rows, numbers, fragments in matcher.hits(part.column("searched").to_pylist(), known):
                        own = matcher.columns.take(pa.array(numbers, pa.int64())).columns
                        own = [ids.take(pa.array(rows, pa.int64())), *own, pa.array(fragments, pa.string())]
                        yield pa.RecordBatch.from_arrays(own, names)

        names = ["ord", *kinds, "fragment"]
        kinds = [texts.schema["ord"].dataType, *kinds.values()]
        out = ", ".join(f"{c} {k.simpleString()}" for c, k in zip(names, kinds))
        return texts.mapInArrow(run, f"{out}, fragment string")

    def _java_hits(self, articles: DataFrame) -> DataFrame:
        """Hits of the rules whose patterns only Java is known to match."""
        texts = articles.withColumn("folded", rx.fold_all(F.col("searched")))
        holds = F.contains(F.col("folded"), F.col("one"))
        present = F.filter("needed", lambda t: F.contains(F.col("folded"), t))
        # A rule with several needed texts is tried once, at the first of them that is there.
        once = (F.size("needed") == 1) | (F.get(present, F.lit(0)) == F.col("one"))
        cut = texts.withColumn("parts", _parts(F.col("searched")))
        found_in = cut.join(self.candidates(texts, java_only=True), "ord").filter(holds)
        near = F.filter("parts", lambda p: F.contains(p["folded"], F.col("one")))
        found_in = found_in.withColumn("near", near).drop("parts")
        by_text = found_in.join(self.told, "one").filter(once).drop("one")
        possible = (F.size("needed") == 0) | (F.size(present) > 0)
        sliced = texts.withColumn("slice", F.pmod(F.xxhash64("ord"), F.lit(SLICES)))
        by_slice = sliced.join(self.anywhere, "slice").filter(possible).drop("slice")
        pattern = F.concat(F.lit(rx.FLAGS), F.col("pattern"))
        whole = F.call_function("regexp_extract", F.col("searched"), pattern, F.lit(0))
        # Parts are told by one text, so a rule with several runs on the whole article.
        by_part = F.col("local") & (F.size("needed") == 1)
        part_or_whole = F.when(by_part, _local_fragment(F.col("near"), pattern)).otherwise(whole)
        found = by_text.withColumn("fragment", part_or_whole).drop("near")
        found = found.unionByName(by_slice.withColumn("fragment", whole))
        matched = (F.col("fragment") != "") | (
            F.col("may_be_empty") & F.regexp_like("searched", pattern)
        )
        return found.filter(matched).select("ord", "profile", "kind", "seq", "label", "fragment")


def hit_counts(hits: DataFrame) -> DataFrame:
    """Articles per profile and rule label."""
    one = hits.select("ord", "profile", "kind", "label").distinct()
    return one.groupBy("profile", "kind", "label").agg(F.count(F.lit(1)).alias("n_articles"))


def fanout(articles: DataFrame, rules: DataFrame, heads: DataFrame) -> DataFrame:
    """``(ord, profile, matched_keyword)`` of each profile an article passes.

    ``heads`` (``profile, context, require_core``) says when secondary rules count, as a
    pattern, and whether a core rule must hit.
    """
    contexts = heads.filter("context <> ''").select(
        "profile", F.lit("context").alias("kind"), F.lit(0).alias("seq"), F.lit("").alias("label"), F.col("context").alias("pattern")
    )
    every = RuleIndex(rules.select(*_RULE).unionByName(contexts))
    # One article's matching rules, at most the rules of its profile.
    cell = F.struct("seq", "label", "fragment")
    verdicts = (
        every.hits(articles)
        .groupBy("ord", "profile")
        .agg(
            *[F.count_if(F.col("kind") == k).alias(k) for k in ("exclude", "context")],
            *[
                F.sort_array(F.collect_list(F.when(F.col("kind") == k, cell))).alias(k)
                for k in ("core", "secondary")
            ],
        )
        .filter("exclude = 0")
        .join(heads.withColumnRenamed("context", "context_pattern"), "profile")
    )
    counts = (F.col("context_pattern") == "") | (F.col("context") > 0)
    none = F.array().cast("array<struct<seq:int,label:string,fragment:string>>")
    parts = verdicts.withColumn("secondary", F.when(counts, F.col("secondary")).otherwise(none))
    wanted = (F.size("core") > 0) | (~F.col("require_core") & (F.size("secondary") > 0))
    plain = [
        F.transform(k, lambda h: F.struct(h["label"].alias("label"), h["fragment"].alias("fragment")))
        for k in ("core", "secondary")
    ]
    return parts.filter(wanted).select("ord", "profile", rx.evidence(*plain).alias("matched_keyword"))
