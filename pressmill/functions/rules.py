"""Regex rule packs compiled to Columns.

One scan serves all rules: each rule is a literal pattern inside one array
expression, so there is no join with a rule table and no Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache, reduce
import re

try:  # the parse of a pattern only saves regex runs; without it all rules still run
    from re import _parser
except ImportError:
    _parser = None

from pyspark.sql import Column, functions as F

# Case-insensitive, Unicode case, Unicode classes, and "." stopping only at "\n".
FLAGS = "(?iuUd)"

HIT = "struct<label:string,fragment:string>"


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str


@dataclass(frozen=True)
class RuleProfile:
    name: str
    title: str
    core: tuple[Rule, ...] = ()
    secondary: tuple[Rule, ...] = ()
    exclude: tuple[Rule, ...] = ()
    # Secondary rules count only where this matches; empty means always.
    context: str = ""
    require_core: bool = False

    def rules(self) -> list[tuple[str, int, Rule]]:
        return [
            (kind, seq, rule)
            for kind in ("core", "secondary", "exclude")
            for seq, rule in enumerate(getattr(self, kind))
        ]


def _pattern(raw: str) -> str:
    return FLAGS + raw


@lru_cache(maxsize=1)
def _odd_letters() -> dict[str, str]:
    """Letters whose lower case is not that of their upper case, with the latter."""
    odd = {"İ": "i", "Σ": "σ"}
    for char in map(chr, range(0x80, 0x10000)):
        upper = char.upper()
        if len(upper) == 1 and len(upper.lower()) == 1 and upper.lower() != char.lower():
            odd[char] = upper.lower()
    return odd


def fold(text: Column, profiles: Sequence[RuleProfile]) -> Column:
    """Case-folded text, in which the texts the rules need are looked up.

    Lower case is the right fold but for a few letters. Those that could stand
    for a letter of a needed text are replaced, in the rare text that has one.
    """
    patterns = [rule.pattern for p in profiles for _, _, rule in p.rules()]
    patterns += [p.context for p in profiles if p.context]
    used = {char for raw in patterns for needed in needed_texts(raw) for char in needed}
    odd = {char: plain for char, plain in _odd_letters().items() if plain in used}
    if odd:
        has_odd = reduce(lambda a, b: a | b, [text.contains(char) for char in odd])
        replaced = F.translate(text, "".join(odd), "".join(odd.values()))
        text = F.when(has_odd, replaced).otherwise(text)
    return F.lower(text)


def fold_all(text: Column) -> Column:
    """Case-folded text for rules that are not known yet."""
    odd = _odd_letters()
    replaced = F.translate(text, "".join(odd), "".join(odd.values()))
    has_odd = F.regexp_like(text, F.lit("[" + "".join(odd) + "]"))
    return F.lower(F.when(has_odd, replaced).otherwise(text))


_MAX_NEEDED = 8


@lru_cache(maxsize=4096)
def _parsed(pattern: str):
    """The pattern's parse; None where it is not known (patterns of Java only)."""
    if _parser is None:
        return None
    try:
        return _parser.parse(pattern, re.IGNORECASE)
    except (re.error, RecursionError, OverflowError):
        return None


@lru_cache(maxsize=4096)
def needed_texts(pattern: str) -> tuple[str, ...]:
    """Folded texts of which every match holds at least one; empty if unknown.

    A plain search for them is many times cheaper than the regex, and most rules
    match few articles, so the regex runs on the articles that hold one.
    """
    parsed = _parsed(pattern)
    if parsed is None:
        return ()
    found = _needed(parsed)
    telling = all(len(t) > 1 or not (t.isalnum() or t.isspace()) for t in found)
    if not found or not telling or len(found) > _MAX_NEEDED:
        return ()
    return tuple(sorted(found))


#: Parts of a pattern that look at nothing but the characters they match.
_PLAIN_PARTS = {"LITERAL", "NOT_LITERAL", "ANY", "IN", "BRANCH", "SUBPATTERN", "MAX_REPEAT", "MIN_REPEAT"}


def is_local(pattern: str, width: int) -> bool:
    """No match is wider than ``width``, and none depends on the text around it."""
    parsed = _parsed(pattern)
    # Flags set within the pattern, and classes that Java reads in another way.
    if parsed is None or "(?" in pattern.replace("(?:", "") or re.search(r"\[\[|\[\^?\]|&&", pattern):
        return False
    return parsed.getwidth()[1] <= width and _looks_inside(parsed)


def _looks_inside(sequence) -> bool:
    for op, value in sequence:
        name = str(op)
        if name not in _PLAIN_PARTS:
            return False
        if name == "BRANCH":
            parts = value[1]
        else:
            parts = [value[-1]] if name == "SUBPATTERN" or name.endswith("_REPEAT") else []
        if not all(map(_looks_inside, parts)):
            return False
    return True


#: Least and most characters of a match before a text, and the characters beside it, if told.
Place = tuple[int, int, str | None, str | None]


def _needed(sequence) -> frozenset[str]:
    """The most telling set of alternatives one element of a sequence demands."""
    return frozenset(_needed_at(sequence))


def _needed_at(sequence, before=None, after=None) -> dict[str, Place]:
    """``_needed`` with the place of each text; ``before`` and ``after`` are what stands there."""
    items = [before, *sequence, after]
    options, run, start = [], "", 0
    low, high = [0], [0]  # widths of what stands before each element
    for at in range(len(items) - 2):
        least, most = sequence[at : at + 1].getwidth()
        low.append(low[-1] + least)
        high.append(high[-1] + most)
    for at, item in enumerate([*items[1:-1], (None, None)]):
        op, value = item
        name = str(op)
        if name == "LITERAL":
            char = chr(value)
            # Characters whose case forms differ in length or place end a run.
            if len(char.upper()) == len(char.lower()) == len(char.upper().lower()) == 1:
                start = start if run else at
                run += char.upper().lower()
                continue
        if run:
            options.append({run: (low[start], high[start], _one_char(items[start]), _one_char(items[at + 1]))})
        run = ""
        found: dict[str, Place] = {}
        if name == "SUBPATTERN":
            found = _needed_at(value[-1], items[at], items[at + 2])
        elif name == "ATOMIC_GROUP":
            found = _needed_at(value, items[at], items[at + 2])
        elif name.endswith("_REPEAT") and value[0] > 0:
            found = _needed_at(value[2], items[at])
        elif name == "BRANCH":
            branches = [_needed_at(branch, items[at], items[at + 2]) for branch in value[1]]
            if all(branches):
                for text, (least, most, left, right) in (x for b in branches for x in b.items()):
                    old = found.get(text, (least, most, left, right))
                    same = [x if x == y else None for x, y in zip(old[2:], (left, right))]
                    found[text] = (min(old[0], least), max(old[1], most), *same)
        options.append({t: (low[at] + p[0], high[at] + p[1], *p[2:]) for t, p in found.items()})
    telling = [o for o in options if o]
    return max(telling, key=lambda o: (min(map(len, o)), -len(o)), default={})


def needed_places(pattern: str) -> list[Place]:
    """Where the texts of ``needed_texts`` stand in a match, in their order."""
    texts = needed_texts(pattern)
    places = _needed_at(_parsed(pattern)) if texts else {}
    return [places[t] for t in texts]


class _Unknown(ValueError):
    """An element that is not known to match the same in Python and in Java."""


#: White space as Java's Unicode classes have it; Python's has four control characters more.
_SPACE = r" \t\n\x0b\f\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CLASSES = {"CATEGORY_DIGIT": r"\d", "CATEGORY_SPACE": _SPACE}


def folded_pattern(pattern: str) -> str | None:
    """A Python pattern that finds in a folded text what ``pattern`` finds in the text.

    Both engines try alternatives and repeats in the same order, so matches differ by the
    characters only, and those of the elements let through here fold in the same way. None
    for any other pattern.
    """
    parsed = _parsed(pattern)
    odd = r"\(\?(?!:)|&&|\[\^?\]|\\[0-9A-Za-z](?<!\\[dstnrf])|\{(?!\d+(?:,\d*)?\})"
    if parsed is None or re.search(odd, pattern):
        return None
    try:
        return _folded_sequence(parsed)
    except _Unknown:
        return None


def _folded_sequence(sequence) -> str:
    return "".join(_folded_element(op, value) for op, value in sequence)


def _folded_element(op, value) -> str:
    name = str(op)
    if name == "LITERAL":
        return re.escape(_folded_char(value))
    if name == "NOT_LITERAL" and value < 128:
        return f"[^{_in_class(_folded_char(value))}]"
    if name == "ANY":
        return r"[^\n]"
    if name == "IN":
        return _folded_class(value)
    if name == "AT" and str(value) in ("AT_BEGINNING", "AT_BEGINNING_STRING"):
        return r"\A"
    if name == "SUBPATTERN" and not (value[1] or value[2]):
        return f"(?:{_folded_sequence(value[3])})"
    if name == "BRANCH":
        return f"(?:{'|'.join(map(_folded_sequence, value[1]))})"
    if name in ("MAX_REPEAT", "MIN_REPEAT") and value[2].getwidth()[0] > 0:
        most = "" if value[1] is _parser.MAXREPEAT else int(value[1])
        lazy = "?" if name == "MIN_REPEAT" else ""
        return f"(?:{_folded_sequence(value[2])}){{{int(value[0])},{most}}}{lazy}"
    raise _Unknown(name)


def _in_class(char: str) -> str:
    return f"\\u{ord(char):04x}"


def _folded_char(code: int) -> str:
    char = chr(code)
    if code > 0xFFFF or not len(char.upper()) == len(char.lower()) == len(char.upper().lower()) == 1:
        raise _Unknown(char)
    return char.upper().lower()


def _folded_class(items) -> str:
    ranges = [tuple(value) for op, value in items if str(op) == "RANGE"]
    out = ""
    for op, value in items:
        name = str(op)
        if name == "NEGATE":
            out += "^"
        elif name == "LITERAL" and chr(value) not in "[&" and (value < 128 or 0xC0 <= value < 0xFF and value not in (0xC5, 0xE5)):
            out += _in_class(_folded_char(value))
        elif name == "RANGE":
            low, high = map(chr, value)
            if "A" <= low <= high <= "Z" and (ord(low.lower()), ord(high.lower())) in ranges:
                continue  # its lower letters are there too
            whole = any(a <= low <= high <= b for a, b in ("az", "09", "\0/", ":@", "{\x7f"))
            if not whole:
                raise _Unknown(low + high)
            out += f"{_in_class(low)}-{_in_class(high)}"
        elif name == "CATEGORY" and str(value) in _CLASSES:
            out += _CLASSES[str(value)]
        else:
            raise _Unknown(name)
    return f"[{out}]"


def _one_char(item) -> str | None:
    """The class of the character that an element puts at both its ends, if it is one."""
    if item is None:
        return None
    op, value = item
    if str(op) in ("MAX_REPEAT", "MIN_REPEAT"):
        return _one_char(value[2][0]) if value[0] > 0 and len(value[2]) == 1 else None
    if str(op) not in ("LITERAL", "NOT_LITERAL", "ANY", "IN"):
        return None
    try:
        return _folded_element(op, value)
    except _Unknown:
        return None


@lru_cache(maxsize=1)
def _odd_finder() -> tuple[re.Pattern, dict[int, str]]:
    odd = _odd_letters()
    return re.compile("[" + "".join(odd) + "]"), str.maketrans(odd)


def folded(text: str) -> str:
    """``fold_all`` in Python; as long as the text."""
    if text.isascii():
        return text.lower()
    finder, plain = _odd_finder()
    return (text.translate(plain) if finder.search(text) else text).lower()


def _worth_it(folded: Column | None, raw: str) -> Column | None:
    """True where the rule can match at all; None when that is not known."""
    texts = needed_texts(raw) if folded is not None else ()
    if not texts:
        return None
    return reduce(lambda a, b: a | b, [folded.contains(t) for t in texts])


@lru_cache(maxsize=4096)
def _is_plain(pattern: str) -> bool:
    """The pattern is nothing but alternative texts."""
    parsed = list(_parsed(pattern) or ())
    if len(parsed) == 1 and str(parsed[0][0]) == "BRANCH":
        options = parsed[0][1][1]
    else:
        options = [parsed]
    plain = bool(parsed) and all(str(op) == "LITERAL" for option in options for op, _ in option)
    return plain and len(needed_texts(pattern)) == len(options)


def matches(text: Column, raw: str, folded: Column | None = None) -> Column:
    possible = _worth_it(folded, raw)
    if possible is not None and _is_plain(raw):
        return possible
    hit = F.regexp_like(text, F.lit(_pattern(raw)))
    return hit if possible is None else possible & hit


def first_hit(text: Column, rule: Rule, folded: Column | None = None) -> Column:
    """``(label, fragment)``; ``is_hit`` tells whether the rule matched."""
    found = F.regexp_extract(text, _pattern(rule.pattern), 0)
    if may_be_empty(rule.pattern):
        # The rule can match nothing at all, so "" does not mean "no match".
        found = F.when(matches(text, rule.pattern), found)
    else:
        possible = _worth_it(folded, rule.pattern)
        found = found if possible is None else F.when(possible, found)
    return F.struct(F.lit(rule.label).alias("label"), found.alias("fragment"))


def may_be_empty(pattern: str) -> bool:
    """Whether some match may have no width, as that of a look-ahead."""
    parsed = _parsed(pattern)
    return parsed is None or parsed.getwidth()[0] == 0


def is_hit(hit: Column, rules: Sequence[Rule]) -> Column:
    """Keeps a cell of ``first_hit``; the fragment is looked at, not found again."""
    empty = [rule.label for rule in rules if may_be_empty(rule.pattern)]
    filled = hit["fragment"] != ""
    return filled | (hit["label"].isin(empty) & hit["fragment"].isNotNull()) if empty else filled


def _hits(text: Column, rules: tuple[Rule, ...], folded: Column | None) -> Column:
    if not rules:
        return F.array().cast(f"array<{HIT}>")
    every = F.array(*[first_hit(text, rule, folded) for rule in rules])
    return F.filter(every, lambda hit: is_hit(hit, rules))


def _if_text(text: Column, hits: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) != "", hits).otherwise(
        F.array().cast(f"array<{HIT}>")
    )


def core_hits(text: Column, profile: RuleProfile, folded: Column | None = None) -> Column:
    return _if_text(text, _hits(text, profile.core, folded))


def secondary_hits(text: Column, profile: RuleProfile, folded: Column | None = None) -> Column:
    hits = _hits(text, profile.secondary, folded)
    if profile.context and profile.secondary:
        hits = F.when(matches(text, profile.context, folded), hits).otherwise(
            F.array().cast(f"array<{HIT}>")
        )
    return _if_text(text, hits)


def exclude_hits(text: Column, profile: RuleProfile, folded: Column | None = None) -> Column:
    return _if_text(text, _hits(text, profile.exclude, folded))


def excluded(text: Column, profile: RuleProfile, folded: Column | None = None) -> Column:
    """True at the first exclusion that hits; later ones are not evaluated."""
    out = F.lit(False)
    for rule in profile.exclude:
        out = out | matches(F.coalesce(text, F.lit("")), rule.pattern, folded)
    return out


def evidence(core: Column, secondary: Column) -> Column:
    """``label: «fragment»`` joined by ``"; "``, repeats removed, core first."""
    return F.array_join(
        F.transform(
            F.array_distinct(F.concat(core, secondary)),
            lambda hit: F.concat(hit["label"], F.lit(": «"), hit["fragment"], F.lit("»")),
        ),
        "; ",
    )


def passes(
    text: Column, core: Column, secondary: Column, profile: RuleProfile, folded: Column | None = None
) -> Column:
    """Profile verdict from hit arrays that were computed once."""
    wanted = F.size(core) > 0
    if not profile.require_core:
        wanted = wanted | (F.size(secondary) > 0)
    return (F.coalesce(text, F.lit("")) != "") & ~excluded(text, profile, folded) & wanted
