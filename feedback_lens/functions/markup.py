"""Reading of stored pages: elements with their inner text, by a stack of open tags.

A page is a list of elements, each with the place where its content starts and ends. Elements without an end (void tags) hold nothing; an
element whose end is implied ends where the next one of its kind begins, or with the element around it; an end tag without a start is
skipped. Comments, scripts and styles hold no text.

A page that is read for some paths only passes over whole elements that lie on none of them, hold at most elements without further ones, and
change nothing around them, such as the entries of a long list: one pattern takes a run of them, instead of a step for each tag.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

# Tags without content, and tags that end an open one of the same or another kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"},
} | {tag: {"p"} for tag in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()}
#: Elements that an implied end does not reach beyond.
SCOPES = frozenset("ul ol dl table select div td th body html".split())
#: Of these, the ones that no start tag inside ends.
QUIET = SCOPES - set().union(*ENDS.values())
HIDDEN = frozenset(["script", "style"])

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


def references(text: str) -> str:
    """Character references of the HTML standard, each decoded once; a space that does not break is a plain one."""
    return html.unescape(text.replace("&nbsp;", " ")) if "&" in text else text


@dataclass(frozen=True)
class Element:
    """What an element must be: its tag, and an attribute with a value, a word of its value, or with any value."""

    tag: str
    attribute: str = ""
    value: str | None = None
    word: str | None = None

    def holds(self, found: Found) -> bool:
        if found.tag != self.tag:
            return False
        if not self.attribute:
            return True
        value = found.attribute(self.attribute)
        if value is None or (self.value is not None and value != self.value):
            return False
        return self.word is None or self.word in value.split()


@dataclass(frozen=True)
class Path:
    """Elements inside one another, and what to take of the last: its inner text or an attribute."""

    steps: tuple[Element, ...]
    take: str = ""


def path(*steps: Element, take: str = "") -> Path:
    return Path(steps, take)


class Found:
    """An element of a page; content runs from ``start`` to ``end``."""

    __slots__ = ("tag", "markup", "start", "end", "_attributes")

    def __init__(self, tag: str, markup: str, start: int):
        self.tag, self.markup, self.start, self.end, self._attributes = tag, markup, start, start, None

    def attribute(self, name: str) -> str | None:
        if self._attributes is None:
            found = {}
            for m in ATTRIBUTE.finditer(self.markup):
                found.setdefault(m[1].lower(), references(m[2] or m[3] or m[4] or ""))
            self._attributes = found
        return self._attributes.get(name)


@lru_cache(maxsize=64)
def _runs(wanted: tuple[Path, ...]) -> tuple[re.Pattern, re.Pattern]:
    """Patterns of runs of whole elements that no path asks for: those whose start may not end another one, and those whose start may."""
    ending = r"(?![a-zA-Z0-9:-])"
    asked = {re.escape(e.tag) + ending + (rf"[^>]*?(?i:{re.escape(e.attribute)})" if e.attribute else "") for p in wanted for e in p.steps}

    def start(left_out: frozenset[str]) -> str:
        # Names in lower case only: alternatives of plain letters are told apart by their first one.
        names = rf"(?!(?:{'|'.join(sorted(left_out))}){ending})(?!{'|'.join(sorted(asked))})"
        attributes = r"""(?:\s(?:[^<>"'/]++|"[^"<>]*"|'[^'<>]*'|/(?!>))*+)?+"""
        return rf"[^<]*+<{names}([a-z][a-z0-9:-]*+){attributes}>"

    def run(left_out: frozenset[str]) -> re.Pattern:
        inner = rf"(?:{start(VOID | HIDDEN | ENDS.keys())}[^<]*+</\2\s*+>)*+"
        return re.compile(rf"(?:{start(left_out)}{inner}[^<]*+</\1\s*+>)++")

    return run(VOID | HIDDEN | ENDS.keys()), run(VOID | HIDDEN)


class Page:
    """Elements of a page in the order of their start tags; of one that is read for some paths, at least those that the paths ask for."""

    def __init__(self, source: str, wanted: Sequence[Path] = ()):
        self.source = source
        self.elements: list[Found] = []
        self._read(_runs(tuple(wanted)) if wanted else None)

    def _read(self, runs: tuple[re.Pattern, re.Pattern] | None) -> None:
        source, stack, at = self.source, [], 0
        while (m := TAG.search(source, self._passed(runs, stack, at))) is not None:
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(stack, tag, m.start())
                continue
            ends = ENDS.get(tag)
            if ends:
                self._imply(stack, ends, m.start())
            element = Found(tag, m[3], at)
            self.elements.append(element)
            if tag in VOID or m[3].endswith("/") and tag not in ENDS:
                continue
            if tag in HIDDEN:
                element.end, at = self._hidden(tag, at)
                continue
            stack.append(element)
        for element in stack:
            element.end = len(source)

    def _passed(self, runs: tuple[re.Pattern, re.Pattern] | None, stack: list[Found], at: int) -> int:
        """Where reading goes on when what no path asks for is passed over."""
        if runs is None:
            return at
        run = runs[bool(stack) and stack[-1].tag in QUIET].match(self.source, at)
        return run.end() if run else at

    def _hidden(self, tag: str, at: int) -> tuple[int, int]:
        """Ends of the content and of the element for a script or style that starts at ``at``."""
        close = re.compile(rf"</{tag}\s*>", re.I).search(self.source, at)
        return close.span() if close else (len(self.source), len(self.source))

    @staticmethod
    def _close(stack: list[Found], tag: str, place: int) -> None:
        depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), None)
        if depth is not None:
            for element in stack[depth:]:
                element.end = place
            del stack[depth:]

    @staticmethod
    def _imply(stack: list[Found], ends: set[str], place: int) -> None:
        cut = None
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag in ends:
                cut = i
            elif stack[i].tag in SCOPES:
                break
        if cut is not None:
            for element in stack[cut:]:
                element.end = place
            del stack[cut:]

    def text(self, element: Found) -> str:
        """Inner text with character references decoded."""
        pieces, at = [], element.start
        while element.tag not in HIDDEN and (m := TAG.search(self.source, at)) is not None and m.start() < element.end:
            pieces.append(self.source[at : m.start()])
            at, tag = m.end(), (m[2] or "").lower()
            if tag in HIDDEN and not m[1] and not m[3].endswith("/"):
                at = self._hidden(tag, at)[1]
        pieces.append(self.source[at : max(at, element.end)])
        return references("".join(pieces))

    def matches(self, wanted: Path, elements: Sequence[Found] | None = None) -> Iterator[Found]:
        """Elements at the end of a path, in page order."""
        found = list(self.elements if elements is None else elements)
        for place, step in enumerate(wanted.steps):
            hits = [e for e in found if step.holds(e)]
            if place == len(wanted.steps) - 1:
                yield from hits
                return
            inside, reach = [], -1
            around = iter(hits)
            outer = next(around, None)
            for e in found:
                while outer is not None and outer.start <= e.start and outer is not e:
                    reach = max(reach, outer.end)
                    outer = next(around, None)
                if e.start <= reach:
                    inside.append(e)
            found = inside

    def value(self, element: Found, wanted: Path) -> str | None:
        return element.attribute(wanted.take) if wanted.take else self.text(element)

    def first(self, wanted: Path, elements: Sequence[Found] | None = None) -> str | None:
        hit = next(self.matches(wanted, elements), None)
        return None if hit is None else self.value(hit, wanted)

    def inside(self, block: Found) -> list[Found]:
        """Elements in the content of one."""
        low = bisect.bisect_left(self.elements, block.start, key=lambda e: e.start)
        high = bisect.bisect_left(self.elements, block.end, key=lambda e: e.start)
        return [e for e in self.elements[low : max(high, low)] if e is not block]
