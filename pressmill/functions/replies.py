"""Model replies: JSON recovery and column coercion."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pressmill.functions.text import bind, strip, text_or_empty

REPLY_MAP = "map<string,string>"
_STRICT = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}

# The shapes a reply is searched for when its JSON is broken.
SUMMARY_SCORE_OBJECT = r'\{[^{}]*"summary"\s*:\s*"[^"]*"[^{}]*"score"\s*:\s*\d+[^{}]*\}'
SUMMARY_OBJECT = r'\{[^{}]*"summary"[^{}]*\}'
SUMMARY_VALUE = r'"summary"\s*:\s*"(.+?)"\s*,\s*"score"'
SCORE_VALUE = r'"score"\s*:\s*(\d+)'


def _object_at_start(text: Column) -> Column:
    """The JSON object ``text`` begins with; what follows it is ignored."""
    return F.when(text.startswith("{"), F.from_json(text, REPLY_MAP, _STRICT))


def _last_object(text: Column, pattern: str) -> Column:
    """The last match of ``pattern`` that is valid JSON."""
    found = F.regexp_extract_all(text, F.lit("(?sU)" + pattern), F.lit(0))
    parsed = F.filter(F.transform(found, _object_at_start), lambda m: m.isNotNull())
    return F.try_element_at(parsed, F.lit(-1))


def reply_text(col: Column) -> Column:
    """Reply without its reasoning part and without a code fence."""
    text = strip(text_or_empty(col))
    tail = strip(F.substring_index(text, "</think>", -1))
    bare = strip(F.replace(F.replace(tail, F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))
    return F.when(tail.startswith("```"), bare).otherwise(tail)


def parse_reply(text: Column) -> Column:
    """``struct(found_by, fields)`` for a cleaned reply.

    The ways are tried in order: an object at the start, an object further in,
    the last object with summary and score, the last object with a summary, the
    two values pulled out by pattern. ``found_by`` is ``"none"`` when all fail.
    """
    return bind({"text": text}, lambda p: _parse_bound(p["text"]))


def _pulled_fields(p: Column) -> Column:
    summary = F.replace(F.replace(strip(p["summary"]), F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(""))
    return F.when(
        (p["summary"] != "") & (p["score"] != ""),
        F.create_map(F.lit("summary"), summary, F.lit("score"), p["score"]),
    )


def _parse_bound(text: Column) -> Column:
    whole_list = text.rlike(r"(?s)^\[.*\]$") & F.try_parse_json(text).isNotNull()
    at_start = _object_at_start(text)
    first_brace = F.instr(text, "{")
    inside = F.when(
        first_brace > 1,
        _object_at_start(F.substring(text, first_brace, F.length(text))),
    )
    with_score = _last_object(text, SUMMARY_SCORE_OBJECT)
    with_summary = _last_object(text, SUMMARY_OBJECT)
    pulled = bind(
        {
            "summary": F.regexp_extract(text, "(?sU)" + SUMMARY_VALUE, 1),
            "score": F.regexp_extract(text, "(?U)" + SCORE_VALUE, 1),
        },
        _pulled_fields,
    )

    def result(name: str, fields: Column) -> Column:
        return bind(
            {"fields": fields},
            lambda p: F.when(
                p["fields"].isNotNull(),
                F.struct(F.lit(name).alias("found_by"), p["fields"].alias("fields")),
            ),
        )

    none = F.struct(
        F.lit("none").alias("found_by"), F.lit(None).cast(REPLY_MAP).alias("fields")
    )
    # coalesce stops at the first hit, so the costly ways run on the rest only.
    return F.when(whole_list, none).otherwise(
        F.coalesce(
            result("object", at_start),
            result("embedded", inside),
            result("summary_score", with_score),
            result("summary", with_summary),
            result("pulled", pulled),
            none,
        )
    )


# The texts that count as true.
TRUE_WORDS = ("1", "true", "yes", "да")
DEFAULT_SUBJECT = "not_relevant"
CANDIDATE_SCORE = 60


def as_bool(col: Column) -> Column:
    return F.lower(strip(text_or_empty(col))).isin(*TRUE_WORDS)


def _number(col: Column) -> Column:
    text = strip(text_or_empty(col))
    plain = text.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$")
    return F.when(plain, text.try_cast("double"))


def as_int(col: Column) -> Column:
    """Whole part of a number, 0 for anything else."""
    number = F.coalesce(_number(col), F.lit(0.0))
    return F.greatest(F.least(number, F.lit(2.0e9)), F.lit(-2.0e9)).cast("int")


def clean_score(col: Column) -> Column:
    return F.greatest(F.least(as_int(col), F.lit(100)), F.lit(0))


def score_columns(fields: Column) -> dict[str, Column]:
    """Score, candidate flag, subject, summary and reason from a field map."""

    def field(name: str) -> Column:
        return F.try_element_at(fields, F.lit(name))

    score = clean_score(field("score"))
    flag = F.when(
        F.map_contains_key(fields, "is_candidate"), as_bool(field("is_candidate"))
    ).otherwise(score >= CANDIDATE_SCORE)

    def first_filled(*names: str, default: str = "") -> Column:
        return F.coalesce(*[F.nullif(field(n), F.lit("")) for n in names], F.lit(default))

    return {
        "score": score,
        "is_candidate": flag,
        "subject": first_filled("topic", default=DEFAULT_SUBJECT),
        "summary": strip(first_filled("summary", "short_summary")),
        "reason": strip(first_filled("reason")),
    }


# The ranked list of a reply of the second pass.
RANKED_LIST = "ranked_top15"
RANKING_SCHEMA = f"struct<{RANKED_LIST}:array<struct<rank:string,row_id:string>>>"


def ranked_items(text: Column) -> Column:
    """``array<struct<rank,row_id>>`` of a ranking reply, empty when absent."""
    whole = F.from_json(text, RANKING_SCHEMA, _STRICT)
    return F.coalesce(
        whole[RANKED_LIST], F.array().cast("array<struct<rank:string,row_id:string>>")
    )
