"""Personal data: base patterns, and terms that disclose what they protect.

Protected entities are the addresses and numbers that the base patterns find. A term (a
word outside all entities, at any distance, in a document that holds the entity)
discloses it as far as knowing the term tells the entity: over all documents,
PMI(entity; term) / IC(entity), which is 1 if the term never occurs without the entity.
Terms above ``DISCLOSURE`` that were seen with the entity in ``CONTEXTS`` different texts
at least, or next to it in as many different surroundings (copies of one text show
nothing new), are generalised in every document they occur in, with or without the
entity, as are the entities themselves.

Only DataFrame expressions are used. Only words of documents whose entities are seen often
enough are paired with them, and only those rare enough to tell one. Texts are shuffled
only if the table of disclosing terms is too large for Spark to broadcast.

Defined results: a null text is empty and has no spans; repeated rows get equal results;
rows with equal ``doc_id`` and different texts are different documents; overlapping spans
of different kinds all stay, and the text is replaced from the first start to the last
end; an entity in every document has no information to disclose; an empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.common import table
from pressmill.session import written

DISCLOSURE, CONTEXTS = 0.9, 3
#: Code points on either side of an entity that tell one of its surroundings from another
#: within a text; terms are counted in whole texts.
REACH = 80
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# The base patterns, written so that no start is tried twice and no repeat is undone:
# the same matches, in time that grows with the text.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_SPAN = "struct<kind:string,start:bigint,end:bigint>"


def _digits(match: Column) -> Column:
    return F.translate(match, "+ ().-", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(
            parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)
        )
    if kind == "card":
        n = F.length(_digits(match))
        return F.when((n >= 16) & (n <= 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        n = F.length(_digits(match))
        return (n >= 8) & (n <= 15)
    return F.lit(True)


def _spans(text: Column, kind: str, pattern: Column, valid) -> Column:
    """Spans of valid matches: the pieces between matches give their places."""
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, pattern, 0)

    def step(acc: Column, part: Column) -> Column:
        start = acc["at"] + F.length(part["piece"])
        end = start + F.coalesce(F.length(part["match"]), F.lit(0))
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"))
        kept = F.when(part["match"].isNotNull() & valid(part["match"]), True).otherwise(False)
        return F.struct(
            end.alias("at"),
            F.when(kept, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    empty = F.array().cast(f"array<{_SPAN}>")
    return F.aggregate(
        F.arrays_zip(pieces.alias("piece"), matches.alias("match")),
        F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans")),
        step,
        lambda acc: acc["spans"],
    )


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end) in code points, by kind as listed, then start."""
    empty = F.array().cast(f"array<{_SPAN}>")
    held = {
        "email": F.contains(text, F.lit("@")),
        "ip": F.contains(text, F.lit(".")),
        "card": text.rlike("[0-9]"),
        "phone": F.contains(text, F.lit("+")),
    }
    return F.concat(
        *[
            F.when(
                held[kind],
                _spans(text, kind, F.lit(PATTERNS[kind]), lambda m, kind=kind: _valid(kind, m)),
            ).otherwise(empty)
            for kind in KINDS
        ]
    )


def _key() -> Column:
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.concat_ws(":", doc_id, F.xxhash64("text")).alias("key")


def _keyed(docs: DataFrame) -> DataFrame:
    """``row`` (all given columns, so that no name clashes), ``key, text, base``."""
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", text)
    return rows.select("row", _key(), "text", base_spans(F.col("text")).alias("base"))


def _keyed_words(docs: DataFrame) -> DataFrame:
    """``key, term``: the words of every text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.select(_key(), F.explode(_words(F.col("text"))).alias("term"))


def _words(text: Column) -> Column:
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+"))
    return F.filter(words, lambda w: F.length(w) > 2)


def _entity(span: Column) -> Column:
    match = F.substr(F.col("text"), (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int"))
    digits = F.when(span["kind"].isin("card", "phone"), _digits(match)).otherwise(F.lower(match))
    return F.concat_ws(":", span["kind"], digits)


def _around(span: Column) -> Column:
    before = F.least(span["start"], F.lit(REACH))
    left = F.substr(F.col("text"), (span["start"] - before + 1).cast("int"), before.cast("int"))
    right = F.substr(F.col("text"), (span["end"] + 1).cast("int"), F.lit(REACH))
    return F.concat_ws("\n", left, right)


def telling_terms(
    docs: DataFrame, disclosure: float = DISCLOSURE, contexts: int = CONTEXTS
) -> DataFrame:
    """``term``: the terms that disclose an entity, counted over whole texts."""
    text = F.col("text")
    unnamed = F.transform("base", lambda s: s.withField("kind", F.lit("")))
    found = written(
        _keyed(docs)
        .where(F.size("base") > 0)
        .select(
            "key",
            F.xxhash64("text").alias("whole"),
            _words(sanitised(text, unnamed)).alias("words"),  # those outside all entities
            F.transform(
                "base",
                lambda s: F.struct(
                    _entity(s).alias("entity"),
                    F.xxhash64(_around(s)).alias("context"),
                    _words(_around(s)).alias("near"),
                ),
            ).alias("places"),
        ),
        "entities",
    )
    # Rows, not distinct texts, are the documents of all counts below.
    rows_of_key = (
        found.select("key", "whole", F.explode(F.array_distinct("places.entity")).alias("entity"))
        .groupBy("key", "whole", "entity")
        .agg(F.count("*").alias("rows"))
    )
    held = (
        rows_of_key.groupBy("entity", "whole")
        .agg(F.sum("rows").alias("rows"))
        .groupBy("entity")
        .agg(F.sum("rows").alias("n_entity"), F.count("*").alias("n_texts"))
    )
    places = found.select(F.explode("places").alias("place")).select("place.*")
    surroundings = (
        places.groupBy("entity", "context")
        .agg(F.lit(1).alias("one"))
        .groupBy("entity")
        .agg(F.sum("one").alias("n_contexts"))
    )
    # No term is seen more often with an entity than the entity is seen.
    repeated = written(
        held.join(surroundings, "entity")
        .where((F.col("n_texts") >= contexts) | (F.col("n_contexts") >= contexts))
        .select("entity", "n_entity"),
        "repeated",
    )
    entities = written(rows_of_key.join(repeated, "entity"), "entities_of_documents")
    words = (
        found.join(entities.select("key").distinct(), "key", "left_semi")
        .select("key", F.explode("words").alias("term"))
        .distinct()
    )
    terms = words.select("term").distinct()
    everywhere = docs.select(F.explode(_words(F.coalesce("text", F.lit("")))).alias("term"))
    # An inner join stays above the counts; a semi join would be pushed below them.
    known = everywhere.groupBy("term").agg(F.count("*").alias("n_term")).join(terms, "term")
    known = written(known, "known_terms")
    n = F.lit(float(max(docs.count(), 1)))
    # Of a term in more documents the share with the entity is too small, as n_both <= n_entity.
    most = F.col("n_entity") * F.pow(n / F.col("n_entity"), F.lit(1.0 - disclosure)) * (1 + 1e-9)
    both = (
        words.join(known, "term")
        .join(entities, "key")
        .where(F.col("n_term") <= most)
        .groupBy("entity", "term", "whole")
        .agg(
            F.sum("rows").alias("rows"),
            F.max("n_entity").alias("n_entity"),
            F.max("n_term").alias("n_term"),
        )
        .groupBy("entity", "term")
        .agg(
            F.sum("rows").alias("n_both"),
            F.count("*").alias("n_texts"),
            F.max("n_entity").alias("n_entity"),
            F.max("n_term").alias("n_term"),
        )
    )
    near = (
        places.join(repeated.select("entity"), "entity", "left_semi")
        .select("entity", "context", F.explode("near").alias("term"))
        .groupBy("entity", "term", "context")
        .agg(F.lit(1).alias("one"))
        .groupBy("entity", "term")
        .agg(F.sum("one").alias("n_contexts"))
    )
    information = -F.log2(F.col("n_entity") / n)
    pmi = F.log2(F.col("n_both") * n / (F.col("n_entity") * F.col("n_term")))
    return (
        both.join(near, ["entity", "term"], "left")
        .where((F.col("n_texts") >= contexts) | (F.col("n_contexts") >= contexts))
        .where((information > 0) & (pmi / information >= disclosure))
        .select("term")
        .distinct()
    )


def disclosing_terms(
    docs: DataFrame, disclosure: float = DISCLOSURE, contexts: int = CONTEXTS
) -> DataFrame:
    """``key, terms``: for each document with telling terms, these, with or without the entity."""
    telling = written(telling_terms(docs, disclosure, contexts), "telling")
    words = _keyed_words(docs)
    return (
        words.join(telling, "term")
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("term")).alias("terms"))  # words of one text
    )


def with_spans(docs: DataFrame) -> DataFrame:
    """``row, text, base, spans``; ``row`` holds the given columns, ``spans`` are the base ones and those of terms."""
    terms = written(disclosing_terms(docs.select("doc_id", "text")), "terms")
    both = _keyed(docs).join(terms, "key", "left")
    pattern = F.concat(
        F.lit(r"(?i)(?u)(?<![\p{L}])(?:"), F.array_join("terms", "|"), F.lit(r")(?![\p{L}])")
    )
    more = _spans(F.col("text"), TERM, pattern, lambda m: F.lit(True))
    empty = F.array().cast(f"array<{_SPAN}>")
    added = F.when(F.col("terms").isNotNull(), more).otherwise(empty)
    return both.select("row", "text", "base", F.concat("base", added).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with the stretches that spans cover replaced by ``<kind>``."""
    order = F.array_sort(
        F.transform(
            spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        )
    )

    def step(acc: Column, s: Column) -> Column:
        before = F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        mark = F.concat(F.lit("<"), s["kind"], F.lit(">"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"])
            .otherwise(F.concat(acc["out"], before, mark))
            .alias("out"),
        )

    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(
            order,
            F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
            step,
            lambda acc: F.concat(
                acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), F.length(text))
            ),
        )
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with entities and disclosing terms generalised in ``text``."""
    clean = sanitised(F.col("text"), F.col("spans")).alias("clean")
    given = docs.columns
    return with_spans(docs).select("row", clean).select(
        *[F.col("clean").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in given]
    )


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def _number(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return with_spans(docs).select(
        "row.doc_id",
        *[_number(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def clean_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: personal data is generalised in every text; ``n_chars`` follows the text."""
    given = docs.columns
    clean = sanitise(docs)
    if "n_chars" not in given:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


QUERIES = {"op8_disclosure": _query}
ORACLES: dict[str, str] = {}
