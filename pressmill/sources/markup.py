"""A small element tree for messy HTML, used inside Arrow batches."""

from __future__ import annotations

from functools import lru_cache
from html.parser import HTMLParser
import re

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SILENT = frozenset(("script", "style", "template"))
# Opening one of these ends an open paragraph.
BLOCKS = frozenset(
    "p div ul ol dl table form fieldset hr pre address blockquote center h1 h2 h3 h4 h5 h6".split()
)


class Element:
    __slots__ = ("tag", "attrs", "parent", "nodes")

    def __init__(self, tag: str, attrs: dict | None = None, parent: "Element | None" = None):
        self.tag, self.attrs, self.parent = tag, attrs or {}, parent
        self.nodes: list = []

    def walk(self):
        """All elements below this one, in document order."""
        stack = [n for n in reversed(self.nodes) if isinstance(n, Element)]
        while stack:
            here = stack.pop()
            yield here
            stack.extend(n for n in reversed(here.nodes) if isinstance(n, Element))

    def strings(self):
        """Trimmed non-empty strings below this element, scripts left out."""
        stack = list(reversed(self.nodes))
        while stack:
            here = stack.pop()
            if isinstance(here, str):
                bare = here.strip()
                if bare:
                    yield bare
            elif here.tag not in SILENT:
                stack.extend(reversed(here.nodes))

    def text(self, sep: str = "") -> str:
        return sep.join(self.strings())

    def find_all(self, selector: str):
        options = _selector(selector)
        return [el for el in self.walk() if any(_fits(el, steps, self) for steps in options)]

    def find(self, selector: str):
        options = _selector(selector)
        for el in self.walk():
            if any(_fits(el, steps, self) for steps in options):
                return el
        return None

    def drop(self, selector: str) -> None:
        for el in self.find_all(selector):
            if el.parent is not None and el in el.parent.nodes:
                el.parent.nodes.remove(el)


@lru_cache(maxsize=512)
def _selector(text: str):
    """``a, b c`` to alternatives of descendant steps ``(tag, tests)``."""
    out = []
    for option in text.split(","):
        steps = []
        for step in option.split():
            tag = re.match(r"[a-z][a-z0-9]*", step)
            tests = []
            for cls, name, op, value in re.findall(
                r"\.([\w-]+)|\[([\w:-]+)(?:([*]?=)'?([^'\]]*)'?)?\]", step
            ):
                tests.append(("class", "~", cls) if cls else (name, op, value))
            steps.append((tag.group(0) if tag else "", tuple(tests)))
        out.append(tuple(steps))
    return tuple(out)


def _fits_one(el: Element, step) -> bool:
    tag, tests = step
    if tag and el.tag != tag:
        return False
    for name, op, value in tests:
        held = el.attrs.get(name)
        if held is None:
            return False
        if op == "~" and value not in held.split():
            return False
        if op == "=" and held != value:
            return False
        if op == "*=" and value not in held:
            return False
    return True


def _fits(el: Element, steps, top: Element) -> bool:
    if not _fits_one(el, steps[-1]):
        return False
    rest = list(steps[:-1])
    above = el.parent
    while rest and above is not None:
        if _fits_one(above, rest[-1]):
            rest.pop()
        above = above.parent
    return not rest


class _Builder(HTMLParser):
    def __init__(self, close_paragraphs: bool):
        super().__init__(convert_charrefs=True)
        self.close_paragraphs = close_paragraphs
        self.root = self.here = Element("")

    def _leave(self, tag: str) -> None:
        el = self.here
        while el is not None and el.tag != tag:
            el = el.parent
        if el is not None and el.parent is not None:
            self.here = el.parent

    def handle_starttag(self, tag, attrs):
        if self.close_paragraphs:
            if tag in BLOCKS:
                self._leave("p")
            elif tag == "li" and self.here.tag in ("li", "p"):
                self._leave("li")
        el = Element(tag, {k: v or "" for k, v in attrs}, self.here)
        self.here.nodes.append(el)
        if tag not in VOID:
            self.here = el

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._leave(tag)

    def handle_endtag(self, tag):
        self._leave(tag)

    def handle_data(self, data):
        self.here.nodes.append(data)


def parse(html: str, close_paragraphs: bool = True) -> Element:
    """Element tree of a page; a new block ends an open paragraph if asked."""
    builder = _Builder(close_paragraphs)
    builder.feed(html or "")
    builder.close()
    return builder.root
