"""Date text to dates and back, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pressmill.functions.text import bind, normalize_whitespace, strip, text_or_empty

# Genitive month names.
MONTHS = {
    "января": "01",
    "февраля": "02",
    "марта": "03",
    "апреля": "04",
    "мая": "05",
    "июня": "06",
    "июля": "07",
    "августа": "08",
    "сентября": "09",
    "октября": "10",
    "ноября": "11",
    "декабря": "12",
}

_ISO = r"(?<![0-9])[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}(?![0-9])"
_DOTTED = r"(?U)\b[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4}\b"
_NAMED = r"(?U)\b[0-9]{1,2}\s+[а-яё]+\s+[0-9]{4}\b"


def _month_number(name: Column, months: dict[str, str]) -> Column:
    pairs = [F.lit(x) for item in months.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), name)


def _first_dates(col: Column) -> dict[str, Column]:
    text = strip(text_or_empty(col))
    return {
        "text": text,
        "iso": F.regexp_extract(text, _ISO, 0),
        "dotted": F.regexp_extract(text, _DOTTED, 0),
    }


def format_news_date(col: Column, months: dict[str, str] = MONTHS) -> Column:
    """``DD.MM.YYYY`` for the first date found, else the trimmed input."""

    def two(x: Column) -> Column:
        return F.lpad(x, 2, "0")

    def shown(p: Column) -> Column:
        d, n = F.split(p["dotted"], "[.]"), F.split(p["named"], r"(?U)\s+")
        month = _month_number(F.get(n, F.lit(1)), months)
        reordered = F.regexp_replace(p["iso"], "^(....).(..).(..)$", "$3.$2.$1")
        padded = F.concat_ws(".", two(F.get(d, F.lit(0))), two(F.get(d, F.lit(1))), F.get(d, F.lit(2)))
        spelled = F.concat(two(F.get(n, F.lit(0))), F.lit("."), month, F.lit("."), F.get(n, F.lit(2)))
        return (
            F.when(p["iso"] != "", reordered)
            .when(p["dotted"] != "", padded)
            .when(p["named"] != "", F.coalesce(spelled, p["text"]))
            .otherwise(p["text"])
        )

    named = F.regexp_extract(F.lower(strip(text_or_empty(col))), _NAMED, 0)
    return bind({**_first_dates(col), "named": named}, shown)


def parse_news_date(col: Column) -> Column:
    """First dotted date, else first ISO date; an impossible date gives null."""
    return bind(
        _first_dates(col),
        lambda p: F.when(p["dotted"] != "", F.try_to_date(p["dotted"], "d.M.y")).when(
            p["iso"] != "", F.try_to_date(F.translate(p["iso"], "/", "-"), "y-M-d")
        ),
    )


def _rewrite(text: Column, *forms: tuple[str, str]) -> Column:
    """Bring a matching form to ``#y-m-d``; a rewritten text matches no later form.

    Two-digit years are read as POSIX does: 69..99 are 19xx, the others 20xx.
    """
    for pattern, target in forms:
        if "YY" in pattern:
            for digits, century in (("(69|[7-9][0-9])", "19"), ("([0-9]{2})", "20")):
                year_at = target.index("$")
                text = F.regexp_replace(
                    text, pattern.replace("YY", digits), target[:year_at] + century + target[year_at:]
                )
        else:
            text = F.regexp_replace(text, pattern, target)
    return text


_DAY = r"([0-9]{1,2})\.([0-9]{1,2})\."
_CLOCK = r"(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9]"
_YMD = "'#'y-M-d"


def _mail_date(col: Column) -> Column:
    head, clock = r"(?i)^(?:[a-z]{3,9},? )?([0-9]{1,2}) ([a-z]{3})[a-z]* ", r" [0-9]{1,2}:[0-9]{2}.*$"
    text = _rewrite(
        normalize_whitespace(col),
        (head + "([0-9]{4})" + clock, "@$3 $2 $1"),
        (head + "YY" + clock, "@$3 $2 $1"),
        (rf"^{_DAY}([0-9]{{4}})$", "#$3-$2-$1"),
        (r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})$", "#$1"),
    )
    return F.coalesce(F.try_to_date(text, "'@'y MMM d"), F.try_to_date(text, _YMD))


def _short_dotted(col: Column) -> Column:
    text = _rewrite(
        normalize_whitespace(col),
        (rf"^{_DAY}YY$", "#$3-$2-$1"),
        (rf"^{_DAY}([0-9]{{4}})$", "#$3-$2-$1"),
        (rf"^{_DAY}YY{_CLOCK}$", "#$3-$2-$1"),
        (rf"^{_DAY}([0-9]{{4}}){_CLOCK}$", "#$3-$2-$1"),
        # Otherwise the first thing in the text that looks like such a date.
        (r"(?U)^(?!#).*?\b([0-9]{2}\.[0-9]{2}\.[0-9]{2,4})\b.*$", "?$1"),
        (rf"^\?{_DAY}YY$", "#$3-$2-$1"),
        (rf"^\?{_DAY}([0-9]{{4}})$", "#$3-$2-$1"),
    )
    return F.try_to_date(text, _YMD)


def _long_dotted(col: Column) -> Column:
    form = rf"^([0-9]{{2}})\.([0-9]{{2}})\.([0-9]{{4}})(?: {_CLOCK})?$"
    return F.try_to_date(_rewrite(strip(text_or_empty(col)), (form, "#$3-$2-$1")), _YMD)


def _iso_prefix(col: Column) -> Column:
    text = F.substring(strip(text_or_empty(col)), 1, 19)
    form = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[T ][0-9:.+Z-]*)?$"
    return F.try_to_date(_rewrite(text, (form, "#$1")), _YMD)


def _named_month(col: Column) -> Column:
    def read(p: Column) -> Column:
        month = _month_number(F.lower(F.get(p["w"], F.lit(1))), MONTHS)
        return F.try_to_date(F.concat_ws("-", F.get(p["w"], F.lit(2)), month, F.get(p["w"], F.lit(0))), "y-M-d")

    return bind({"w": F.split(normalize_whitespace(col), " ")}, read)


DATE_STYLES = {
    "mail": _mail_date,
    "short_dotted": _short_dotted,
    "long_dotted": _long_dotted,
    "iso_prefix": _iso_prefix,
    "named_month": _named_month,
}


def parse_source_date(col: Column, style: str) -> Column:
    """Date in the notation of one kind of source; null when it does not fit."""
    return DATE_STYLES[style](col)
