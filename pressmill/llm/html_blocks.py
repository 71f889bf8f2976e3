"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines, one for each block of text. Elements that say what they are
(scripts, menus, page headers, footers, sidebars, notices, adverts, forms, comments, by
tag, role, class or id) leave nothing behind; borders of containers leave empty lines.
The weight of a line is the length of its text outside links. Sums over a sliding window
of lines rise at a surge point, where text begins, and fall to nothing at a dive point,
where a container ends before the next begins. Stretches whose peak is that of running
text, or else the heaviest one, say where the article is: the innermost element that holds
them all. Its text is kept whole, with the headings right before it. An element of one
line is a paragraph, lists, quotes, tables and figures are parts of what holds them, and an
element among text lines belongs with these; so then the next outer element is taken. Of
what stands before the first surge or after the last dive, blocks of links alone are left
out if they have an element of their own or only the page holds them.

Marks (``article``, ``main``) are evidence, not an answer. Of the marked elements the one
with most running text is taken, unless a stretch outside all of them outweighs it: then
the marked ones are cards or teasers, and the article is sought beside them. Within the
taken one, a marked element with at least half of the running text is the article itself;
where its own text has that share, marked elements in it (readers' comments, teasers) go;
else all of it is kept.

The page is the unit of work: one Arrow batch of pages is held at a time, and a page's
cost is linear in its length.

Defined results: null or empty html gives an empty text; a page without text gives an
empty text; broken or cut-off markup is read as far as it goes; repeated rows and null
ids stay; an empty table gives no rows; columns beyond the three are not read, so no name
clashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from html import unescape
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.chunk_ids import steps
from pressmill.llm.common import table

#: Lines summed up; a border leaves as many empty lines, so that the sum reaches zero.
WINDOW = 3
#: A stretch is running text if a window within it reaches this weight.
SURGE = 80

# Names of elements, and words in class, id and role, by what they hold.
_RAW = "script style title textarea noscript template svg math iframe object select xmp"
_DROPPED = set("head nav footer aside form button dialog menu fieldset".split())
_CONTAINERS = set(
    "html body main article section div header table tbody blockquote figure ul ol dl details "
    "center td th".split()
)
#: Elements that can hold an article; other containers are parts of one.
_HOLDERS = set("html body main article section div td th".split())
_BLOCKS = set(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr pre hr address figcaption caption summary legend".split()
)
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_SPACED = {"br"}
_BOILERPLATE = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead topbar footer cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations comment "
    "comments reply replies respond disqus widget toolbar pagination pager copyright search "
    "complementary contentinfo dialog form header".split()
)
_CONTENT = set("article post entry content story main body text title".split())
#: Words that keep a marked element whose class also has a word of the above.
_STORY = set("article post entry story main hentry".split())
_MARKED = {"article", "main"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(_RAW.split())})\b[^>]*(?:(?<=/)>|>.*?(?:</\1\s*>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][\w:-]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_MARKS = re.compile(r"(?:^|\s)(class|id|role|data-role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_HIDDEN = re.compile(
    r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE
)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _is_boilerplate(name: str, attributes: str) -> bool:
    if name in _DROPPED:
        return True
    if not attributes or name in ("html", "body"):
        return False
    if _HIDDEN.search(attributes):
        return True
    words = {
        w.lower() for _, value in _MARKS.findall(attributes) for w in _WORD.findall(value)
    }
    found = words & _BOILERPLATE
    if name in _MARKED:
        return bool(found) and not words & _STORY
    return bool(found) and not (found <= {"header", "form"} and words & _CONTENT)


class _Lines:
    """Lines of text with their weight and holder; empty ones between containers.

    Holders are numbered as they open, so that a parent's number is below its children's;
    0 is the document.
    """

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.weights: list[int] = []
        self.heading: list[bool] = []
        self.holders: list[int] = []
        self.parents, self.pages, self.marks = [0], {0}, set()
        self.parts: list[str] = []
        self.linked = 0

    def open(self, name: str, holder: int) -> int:
        """The holder of what stands in the element, which ``holder`` holds."""
        if name not in _HOLDERS or (name == "section" and holder not in self.pages):
            return holder
        self.parents.append(holder)
        if name in ("html", "body"):
            self.pages.add(len(self.parents) - 1)
        elif name in _MARKED:
            self.marks.add(len(self.parents) - 1)
        return len(self.parents) - 1

    def end(self, heading: bool, holder: int) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.texts.append(text)
            self.weights.append(max(len(text) - self.linked, 0))
            self.heading.append(heading)
            self.holders.append(holder)
        self.parts, self.linked = [], 0

    def border(self) -> None:
        if self.texts and self.texts[-1]:
            self.texts += [""] * WINDOW
            self.weights += [0] * WINDOW
            self.heading += [False] * WINDOW
            self.holders += [0] * WINDOW


def _lines(html: str) -> _Lines:
    out = _Lines()
    stack: list[tuple[str, bool, int]] = []  # open elements that matter: name, dropped, holder
    dropped = articles = links = holder = 0
    heading = False
    at = 0

    def close(depth: int) -> None:
        nonlocal dropped, articles, holder
        while len(stack) > depth:
            name, gone, holder = stack.pop()
            dropped -= gone
            articles -= name in _MARKED

    for match in _TOKEN.finditer(html):
        if match.start() > at and not dropped:
            text = unescape(html[at : match.start()])
            out.parts.append(text)
            if links:
                out.linked += len(" ".join(text.split()))
        at = match.end()
        ending, name, attributes = match.group(2, 3, 4)
        if name is None:
            ending, name, attributes = match.group(5, 6, 7)
            if name is None:
                continue
        name = name.lower()
        if name == "a":
            links = 0 if ending else 1
            continue
        structural = name in _CONTAINERS or name in _DROPPED
        if not structural and name not in _BLOCKS:
            if ending:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == name:
                        close(depth)
                        break
            elif name in _SPACED:
                out.parts.append(" ")
            elif not attributes.endswith("/") and _is_boilerplate(name, attributes):
                stack.append((name, True, holder))
                dropped += 1
            continue
        was_dropped = dropped
        if not dropped:
            out.end(heading, holder)
        heading = name in _HEADINGS and not ending
        links = 0
        if ending:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
        else:
            # A block ends an unclosed dropped paragraph, and the body ends the head.
            while stack and stack[-1][0] in _BLOCKS:
                close(len(stack) - 1)
            if name in ("body", "main", "article"):
                heads = [i for i, (open_name, *_) in enumerate(stack) if open_name == "head"]
                if heads:
                    close(heads[0])
            gone = _is_boilerplate(name, attributes)
            if name == "header" and not articles:
                gone = True
            if (structural or gone) and not (attributes or "").endswith("/") and name != "hr":
                stack.append((name, gone, holder))
                holder = out.open(name, holder)
                dropped += gone
                articles += name in _MARKED
        if name in _CONTAINERS and not (was_dropped or dropped):
            out.border()  # what is dropped leaves no border in the text around it
    if at < len(html) and not dropped:
        out.parts.append(unescape(html[at:]))
    out.end(heading, holder)
    return out


def _sums(own: list[int], parents: list[int]) -> list[int]:
    """For each holder the sum over itself and all within it."""
    total = list(own)
    for node in range(len(total) - 1, 0, -1):
        total[parents[node]] += total[node]
    return total


def _holder(lines: _Lines, chosen: list[int]) -> int:
    """The innermost element that holds an article with the chosen lines."""
    parents = lines.parents
    own, marked, text = ([0] * len(parents) for _ in range(3))
    for i, holder in enumerate(lines.holders):
        own[holder] += bool(lines.texts[i])
        text[holder] |= lines.weights[i] > 0 and not lines.heading[i]
    for i in chosen:
        marked[lines.holders[i]] += 1
    held, counts = _sums(marked, parents), _sums(own, parents)
    node = max(k for k in range(len(parents)) if held[k] == len(chosen))
    while node and counts[node] == 1:
        node = parents[node]
    outer = node
    while outer:
        outer = parents[outer]
        if text[outer]:
            node = outer
        elif counts[outer] != counts[node]:  # more than a wrapper
            break
    return node


class _Stretch(NamedTuple):
    begin: int
    dive: int
    peak: int
    weight: int
    headings: bool  # nothing else


def _stretches(lines: _Lines) -> list[_Stretch]:
    """The runs of text lines, each from its surge to its dive."""
    texts, weights = lines.texts, lines.weights
    out: list[_Stretch] = []
    begin, total, peak = None, 0, 0
    for i in range(len(texts) + 1):
        total += weights[i] if i < len(texts) else 0
        total -= weights[i - WINDOW] if i >= WINDOW else 0
        if i < len(texts) and texts[i]:
            begin = i if begin is None else begin
            peak = max(peak, total)
        elif begin is not None:
            out.append(_Stretch(begin, i, peak, sum(weights[begin:i]), all(lines.heading[begin:i])))
            begin, peak = None, 0
    return out


def _under(lines: _Lines, tops: set[int]) -> list[int]:
    """For each holder the nearest of ``tops`` at or above it, or -1 if there is none."""
    out = [0 if 0 in tops else -1]
    for node in range(1, len(lines.parents)):
        out.append(node if node in tops else out[lines.parents[node]])
    return out


def _marked_article(
    lines: _Lines, stretches: list[_Stretch], surging: set[int], roots: list[int]
) -> tuple[int, set[int]] | None:
    """The marked element that is the article, and the marked ones in it that are not.

    None if running text outside all marked elements outweighs each of them.
    """
    heavy, all_text, own = ([0] * len(lines.parents) for _ in range(3))
    outside = 0
    for k, stretch in enumerate(stretches):
        holder = lines.holders[stretch.begin]
        own[holder] += 1
        all_text[holder] += stretch.weight
        heavy[holder] += stretch.weight if k in surging else 0
        if roots[holder] < 0 and stretch.peak >= SURGE:
            outside = max(outside, stretch.weight)
    heavy, all_text, own = (_sums(w, lines.parents) for w in (heavy, all_text, own))
    tops = [n for n in sorted(lines.marks) if roots[n] == n and own[n]]
    if not tops:
        return None
    node = max(tops, key=lambda n: (heavy[n], all_text[n], -n))
    if outside > heavy[node]:
        return None
    nearest = _under(lines, lines.marks)
    kids: dict[int, list[int]] = {}
    for n in sorted(lines.marks):
        kids.setdefault(nearest[lines.parents[n]], []).append(n)
    while inner := [n for n in kids.get(node, []) if own[n]]:
        if 2 * (heavy[node] - sum(heavy[n] for n in inner)) >= heavy[node]:
            return node, set(inner)
        best = max(inner, key=lambda n: (heavy[n], -n))
        if 2 * heavy[best] < heavy[node]:
            break
        node = best
    return node, set()


def main_text(html: str | None) -> str:
    """The blocks of the main text, joined by line breaks."""
    lines = _lines(html or "")
    stretches = _stretches(lines)
    if not stretches:
        return ""
    heaviest = max(range(len(stretches)), key=lambda k: stretches[k].weight)
    surging = {k for k, s in enumerate(stretches) if s.peak >= SURGE} | {heaviest}
    marks = lines.marks
    around = _under(lines, marks)
    top = _under(lines, {n for n in marks if around[lines.parents[n]] < 0})
    found = _marked_article(lines, stretches, surging, top) if marks else None
    if found:
        article, others = found
        near = _under(lines, {article} | others)
        chosen = {k for k, s in enumerate(stretches) if near[lines.holders[s.begin]] == article}
        eligible = {k for k, s in enumerate(stretches) if top[lines.holders[s.begin]] == top[article]}
    else:
        eligible = {k for k, s in enumerate(stretches) if top[lines.holders[s.begin]] < 0}
        if not eligible:
            return ""
        chosen = _unmarked_article(lines, stretches, surging & eligible or {max(eligible)}) & eligible
    for k in sorted(chosen, reverse=True):
        while k - 1 in eligible and stretches[k - 1].headings:
            k -= 1
            chosen.add(k)
    return "\n".join(
        t for k in sorted(chosen) for t in lines.texts[stretches[k].begin : stretches[k].dive] if t
    )


def _unmarked_article(lines: _Lines, stretches: list[_Stretch], surging: set[int]) -> set[int]:
    """The stretches of the innermost element that holds all running text."""
    first, last = min(surging), max(surging)
    article = _holder(
        lines, [i for k in surging for i in range(stretches[k].begin, stretches[k].dive)]
    )
    within = _under(lines, {article})
    chosen = set(range(first, last + 1))  # from the first surge to the last dive
    for k, stretch in enumerate(stretches):
        holder = lines.holders[stretch.begin]
        if within[holder] == article and (
            stretch.weight or (holder == article and article not in lines.pages)
        ):
            chosen.add(k)
    return chosen


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of ``page_id, url, html``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = pa.array([main_text(h) for h in batch.column(2).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), texts], ["page_id", "url", "text"]
            )

    chosen = pages.select(F.col("page_id").cast("long"), "url", "html")
    return chosen.mapInArrow(run, "page_id long, url string, text string")


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op1_html_blocks": _query}
ORACLES: dict[str, str] = {}
