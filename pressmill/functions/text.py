"""String normalisation as Columns (JVM side, no Python workers)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
import re

from pyspark.sql import Column, functions as F

# White space as Unicode defines it, with the four ASCII separators U+001C..1F.
WS = r"[\s\x1c-\x1f]"
WHITE = "".join(
    map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)])
) + "\u2028\u2029\u202f\u205f\u3000"


def bind(values: dict[str, Column], use: Callable[[Column], Column]) -> Column:
    """``use`` applied to a struct of values, each value evaluated once per row.

    Without it a value used in several branches is written out, and evaluated,
    once per use.
    """
    one = F.array(F.struct(*[col.alias(name) for name, col in values.items()]))
    return F.get(F.transform(one, use), F.lit(0))


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def falsy_fallback(*cols: Column) -> Column:
    """The first value that is neither null nor empty, else ``""``."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITE))


def normalize_whitespace(col: Column) -> Column:
    """Every run of white space becomes one space; null becomes ``""``."""
    return F.trim(F.regexp_replace(text_or_empty(col), rf"(?U){WS}+", " "))


def search_text(title: Column, text: Column) -> Column:
    return F.concat(text_or_empty(title), F.lit(" "), text_or_empty(text))


def url_key(col: Column) -> Column:
    """Comparison form of a URL: outer space and all trailing slashes removed."""
    return F.regexp_replace(strip(text_or_empty(col)), "/+$", "")


def resolve_url(href: Column, base: str | Column) -> Column:
    """Absolute form of a link; only site-rooted and absolute links occur."""
    base_col = F.lit(base) if isinstance(base, str) else base
    site = r"[A-Za-z][A-Za-z0-9+.-]*:"
    parts = {
        "base": base_col,
        "href": href,
        "scheme": F.regexp_extract(base_col, rf"^({site})", 1),
        "root": F.regexp_extract(base_col, rf"^({site}//[^/?#]*)", 1),
        "folder": F.regexp_extract(base_col, rf"^({site}//[^/?#]*/(?:[^?#]*/)?)", 1),
    }

    def absolute(p: Column) -> Column:
        near = F.when(p["folder"] == "", F.concat(p["root"], F.lit("/"))).otherwise(p["folder"])
        return (
            F.when(p["href"].rlike("^" + site), p["href"])
            .when(p["href"].startswith("//"), F.concat(p["scheme"], p["href"]))
            .when(p["href"].startswith("/"), F.concat(p["root"], p["href"]))
            .when(p["href"] == "", p["base"])
            .otherwise(F.concat(near, p["href"]))
        )

    return bind(parts, absolute)


def url_domain(url: Column) -> Column:
    """Network location without a leading ``www.``; ``""`` when there is none."""
    host = F.regexp_extract(text_or_empty(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.regexp_replace(host, r"^www\.", "")


@dataclass(frozen=True)
class CleanProfile:
    """Boilerplate removal for one source, applied in the order of the fields."""

    collapse_space: bool = False
    drop_leading_title: bool = False
    drop_patterns: tuple[str, ...] = field(default=())
    cut_at: str = ""
    late_replacements: tuple[tuple[str, str], ...] = field(default=())


# The phrases the sites put into their article texts.
CLEAN_PROFILES = {
    "banki": CleanProfile(cut_at="Читать по теме"),
    "interfax": CleanProfile(
        collapse_space=True,
        drop_leading_title=True,
        drop_patterns=(r"^.*?INTERFAX\.RU\s*-\s*",),
    ),
    "nalog": CleanProfile(
        drop_patterns=(
            r"Дата публикации:\s*\d{2}\.\d{2}\.\d{4}\s*",
            r"Дата публикации:\s*\d{2}\.\d{2}\.\d{4}\s*\d{2}:\d{2}\s*",
            r"Это архивная публикация - она может содержать устаревшую информацию\.\s*",
            r"^\s+|\s+$",
        ),
        late_replacements=((r"\s+", " "), ("&nbsp;", " "), ("&[a-z]+;", "")),
    ),
}


def _without_lead(p: Column) -> Column:
    rest = F.substring(p["text"], F.length(p["lead"]) + 1, F.length(p["text"]))
    has_lead = (p["lead"] != "") & p["text"].startswith(p["lead"])
    return F.when(has_lead, strip(rest)).otherwise(p["text"])


def strip_boilerplate(text: Column, profile: CleanProfile, title: Column | None = None) -> Column:
    out = text_or_empty(text)
    if profile.collapse_space:
        out = F.regexp_replace(out, rf"(?U){WS}+", " ")
    if profile.drop_leading_title and title is not None:
        out = bind({"text": out, "lead": text_or_empty(title)}, _without_lead)
    for pattern in profile.drop_patterns:
        out = F.regexp_replace(out, "(?Ud)" + pattern, "")
    if profile.cut_at:
        out = F.regexp_replace(
            F.substring_index(out, profile.cut_at, 1), rf"(?U){WS}+$", ""
        )
    for pattern, replacement in profile.late_replacements:
        out = F.regexp_replace(out, "(?Ud)" + pattern, replacement)
    return out


# The two captions of the text that is embedded.
EMBED_CAPTIONS = ("Заголовок: ", "Краткое содержание: ")


def embedding_text(
    title: Column,
    summary: Column,
    full_text: Column,
    captions: tuple[str, str] = EMBED_CAPTIONS,
    fallback_chars: int | None = None,
) -> Column:
    """Title and summary, or the whole text (its first ``fallback_chars`` if given)."""
    short = normalize_whitespace(summary)
    whole = normalize_whitespace(full_text)
    body = F.when(short != "", short).otherwise(
        whole if fallback_chars is None else F.substring(whole, 1, fallback_chars)
    )
    return strip(
        F.concat(
            F.lit(captions[0]), normalize_whitespace(title), F.lit("\n" + captions[1]), body
        )
    )


def fill_template(template: str, fields: dict[str, Column]) -> Column:
    """``template`` with each ``{name}`` replaced by its column, in one concat.

    Values are never scanned for placeholders again.
    """
    parts = []
    for piece in re.split(r"(\{\w+\})", template):
        name = piece[1:-1]
        if piece.startswith("{") and piece.endswith("}") and name in fields:
            parts.append(text_or_empty(fields[name]))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")


def prompt_for_topic(
    topic: Column, templates: dict[str, str], fields: dict[str, Column], text_chars: int | None = None
) -> Column:
    """The scoring prompt of each row's topic; null for a topic without one.

    The text goes in whole unless ``text_chars`` bounds it.
    """
    compact = {name: strip(text_or_empty(col)) for name, col in fields.items()}
    if "text" in compact and text_chars is not None:
        compact["text"] = F.substring(compact["text"], 1, text_chars)
    out = F.lit(None).cast("string")
    for topic_id, template in templates.items():
        out = F.when(topic == topic_id, fill_template(template, compact)).otherwise(out)
    return out


def keyword_list(col: Column) -> Column:
    """Keyword cell as an array: empty, one value, or a bracketed list."""

    def unquote(part: Column) -> Column:
        bare = F.regexp_replace(strip(part), "^'+|'+$", "")
        return F.regexp_replace(bare, '^"+|"+$', "")

    def read(p: Column) -> Column:
        cell = p["cell"]
        inner = F.regexp_replace(cell, r"(?s)^\[(.*)\]$", "$1")
        parts = F.transform(F.split(inner, ","), unquote)
        is_list = cell.startswith("[") & cell.endswith("]") & (F.length(cell) > 1)
        return F.when(is_list, parts).otherwise(F.array(cell))

    listed = bind({"cell": strip(text_or_empty(col))}, read)
    return F.filter(listed, lambda x: x != "")


def long_paragraphs(paragraphs: Column, min_chars: int) -> Column:
    """Keep the paragraphs longer than ``min_chars`` after trimming."""
    return F.filter(paragraphs, lambda p: F.length(strip(p)) > min_chars)
