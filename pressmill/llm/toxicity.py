"""Toxicity by gradient-boosted trees over dense features, calibrated isotonically.

The model is fitted on at most ``SAMPLE_ROWS`` labelled documents (the smallest seeded
hashes of their ids). From them come a lexicon of insulting words and word beginnings
that are far more frequent in toxic texts, added to a fixed base list; boosted trees
over densities, not over words; and, on a quarter kept apart, an isotonic curve that
turns tree scores into probabilities. Every whole text is then scored with expressions
of the JVM; labels, language, source and ids are no inputs of a score.

Defined results: a null text is empty; a text without words gets the score of its
(zero) features; repeated rows are scored alike; labels of one document count as toxic
if one of them does, null labels do not count; without labels of both kinds every score
is the share of toxic labels (0 without any); an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
import math

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.functions.text import bind
from pressmill.llm.common import table
from pressmill.session import written

#: Labelled rows that the model is fitted on, at most.
SAMPLE_ROWS = 12_000
SEED = 7
#: A learned term occurs in this share of the toxic texts at least, and at least this
#: many times as often in them as in the others.
TERM_SHARE, TERM_LIFT, TERM_ROWS = 0.01, 12.0, 4
PREFIXES = (4, 5, 6, 7, 8)

# General insults and words of address.
BASE_TERMS = (
    "idiot moron stupid loser scum trash pathetic worthless disgusting clown dumb jerk "
    "bastard imbecile retard filth vermin freak creep pig"
).split()
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine ihr euch tu toi te ton ta vous votre "
    "tú ti tus usted ustedes vosotros"
).split()

CAPITALS = "".join(chr(c) for c in range(0x250) if chr(c).isupper())
SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "¡¿«»„“”‘’–—…"

#: Each counted character and the one that stands for its kind.
KINDS = (
    dict.fromkeys(CAPITALS, "A")
    | dict.fromkeys(SIGNS, ".")
    | dict.fromkeys("!?", "!")
    | dict.fromkeys("0123456789", "0")
    | dict.fromkeys(" \n\t\r", " ")
)

FEATURES = (
    "hits words_log hit_density distinct_hits near_you second_person capitals shouting "
    "punctuation exclamations obfuscated digits mean_word"
).split()


def _any_of(terms: list[str]) -> str:
    """One pattern for all terms, with common beginnings factored out.

    A term that ends in ``*`` stands for all longer words that begin so.
    """
    tree: dict = {}
    for term in terms:
        node = tree
        for char in term:
            node = node.setdefault(char, {})
        node.setdefault("", {})

    def pattern(node: dict) -> str:
        parts = []
        for char in sorted(node, reverse=True):
            if char == "*":
                return r"\p{L}+"
            parts.append(char + pattern(node[char]) if char else r"(?!\p{L})")
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    firsts = "".join(sorted(tree))
    return f"(?=[{firsts}])" + pattern(tree)


def _word(pattern: str) -> str:
    return rf"(?<![\p{{L}}])(?:{pattern})"


def features(text: Column, terms: list[str]) -> Column:
    """The dense features of a text, in the order of ``FEATURES``.

    Every pattern and count is evaluated once for a row, also where the score stands in
    a filter and Spark would write it out once for each use.
    """
    text = F.coalesce(text, F.lit(""))
    lexicon, person = _any_of(terms), _any_of(SECOND_PERSON)
    gap = r"[^\p{L}]+(?:\p{L}+[^\p{L}]+){0,3}"
    near = f"{_word(person)}{gap}(?:{lexicon})|{_word(lexicon)}{gap}(?:{person})"

    def measured(p: Column) -> Column:
        def among(kind: str) -> Column:
            rest = F.replace(p["kinds"], F.lit(kind), F.lit(""))
            return (F.length(p["kinds"]) - F.length(rest)).cast("double")

        counts = {
            "text": p["text"],
            "low": p["low"],
            "hits": F.regexp_extract_all(p["low"], F.lit("(" + _word(lexicon) + ")"), 1),
            "person": F.regexp_count(p["low"], F.lit(_word(person))).cast("double"),
            "chars": F.greatest(F.length(p["text"]), F.lit(1)).cast("double"),
            "words": among(" ") + 1,
            "capitals": among("A"),
            "signs": among(".") + among("!"),
            "calls": among("!"),
            "digits": among("0"),
        }
        return bind(counts, _values)

    def _values(c: Column) -> Column:
        def count(pattern: str, when: Column, source: str = "text") -> Column:
            found = F.regexp_count(c[source], F.lit(pattern)).cast("double")
            return F.when(when, found).otherwise(0.0)

        n, words, chars, signs = F.size(c["hits"]).cast("double"), c["words"], c["chars"], c["signs"]
        letters = F.greatest(chars - words - signs - c["digits"], F.lit(1.0))
        return F.array(
            n,
            F.log1p(words),
            n / words,
            F.size(F.array_distinct(c["hits"])).cast("double"),
            count(near, n > 0, "low") / words,
            c["person"] / words,
            c["capitals"] / letters,
            count(r"(?<!\p{L})\p{Lu}{3,}(?!\p{L})", c["capitals"] > 2) / words,
            signs / chars,
            c["calls"] / chars,
            count(r"\p{L}[0-9@$*#]+\p{L}", signs + c["digits"] > 0) / words,
            c["digits"] / chars,
            letters / words,
        )

    kinds = F.translate(text, "".join(KINDS), "".join(KINDS.values()))
    return bind({"text": text, "low": F.lower(text), "kinds": kinds}, measured)


@dataclass
class ToxicityModel:
    terms: list[str]
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    share: float

    def rows_scored(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``row`` (all columns of ``docs`` as a struct, so that no name clashes), ``score``."""
        row = F.struct(*docs.columns).alias("row")
        if self.trees is None:
            return docs.select(row, F.lit(self.share).alias("score"))
        vector = array_to_vector(features(F.col(text), self.terms)).alias("features")
        raw = self.trees.transform(docs.select(row, vector))
        one = raw.select("row", vector_to_array("probability")[1].alias("one"))
        score = F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0))
        return self.curve.transform(one).select("row", score.alias("score"))


def held_out(doc_id: Column) -> Column:
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, toxic, late`` of at most ``rows`` labelled documents; ``late`` calibrates."""
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("double")).alias("toxic"))
        .withColumn("mix", F.xxhash64(F.lit(SEED), "doc_id"))
        .orderBy("mix", "doc_id")
        .limit(rows)
    )
    known = written(known, "labels")
    both = docs.select("doc_id", "text").join(known, "doc_id")
    return both.select(
        F.coalesce("text", F.lit("")).alias("text"), "toxic", (F.pmod("mix", F.lit(4)) == 0).alias("late")
    )


def _starts(words: Column, n: int) -> Column:
    longer = F.filter(words, lambda w: F.length(w) > n)
    return F.transform(longer, lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))


def learned_terms(rows: DataFrame) -> list[str]:
    """Words and word beginnings far more frequent in the toxic texts."""
    low = F.split(F.lower("text"), r"[^\p{L}]+")
    words = F.filter(F.array_distinct(low), lambda w: F.length(w) >= min(PREFIXES))
    starts = [_starts(words, n) for n in PREFIXES]
    texts = rows.select("text", "toxic").distinct()  # copies carry no further evidence
    kinds = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    bad, good = kinds.get(1.0, 0), kinds.get(0.0, 0)
    least = max(TERM_ROWS, math.ceil(TERM_SHARE * bad))
    found = (
        texts.select("toxic", F.explode(F.array_distinct(F.concat(words, *starts))).alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        .where(F.col("bad") >= least)
        .withColumn("lift", ((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("good") + 0.5) / (good + 1)))
        .where(F.col("lift") >= TERM_LIFT)
        .collect()  # each in TERM_SHARE of the sample's toxic texts, so bounded with the sample
    )
    terms = sorted({r["term"] for r in found} | set(BASE_TERMS))
    starts = tuple(t[:-1] for t in terms if t.endswith("*"))
    return [
        t for t in terms if not any(t.rstrip("*").startswith(s) and t != s + "*" for s in starts)
    ]


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    sample = written(training_rows(docs, labels, rows), "labelled")
    terms = learned_terms(sample)
    vector = array_to_vector(features(F.col("text"), terms))
    ready = written(sample.select(vector.alias("features"), "toxic", "late"), "features")
    ready = ready.coalesce(4)  # a bounded sample: few tasks for many short steps
    kinds = {
        (r["late"], r["toxic"]): r["count"] for r in ready.groupBy("late", "toxic").count().collect()
    }
    total = sum(kinds.values())
    bad = sum(n for (_, toxic), n in kinds.items() if toxic == 1)
    early = {toxic for late, toxic in kinds if not late}
    if early != {0.0, 1.0}:
        return ToxicityModel(terms, None, None, bad / total if total else 0.0)
    both = {toxic for late, toxic in kinds if late} == {0.0, 1.0}
    trees = GBTClassifier(
        featuresCol="features",
        labelCol="toxic",
        maxIter=20,
        maxDepth=3,
        stepSize=0.3,
        seed=SEED,
    ).fit(ready.where(~F.col("late")))
    scored = trees.transform(ready.where(F.col("late")) if both else ready)
    curve = IsotonicRegression(featuresCol="one", labelCol="toxic").fit(
        scored.select("toxic", vector_to_array("probability")[1].alias("one"))
    )
    return ToxicityModel(terms, trees, curve, bad / total)


def toxic_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    scored = model.rows_scored(docs.select("doc_id", "text"))
    return scored.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxic_scores(docs, fit(docs, table(spark, sf_dir, "labels")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: documents predicted as toxic go."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return model.rows_scored(docs).where("score < 0.5").select("row.*")


QUERIES = {"op7_toxicity_trees": _query}
ORACLES: dict[str, str] = {}
