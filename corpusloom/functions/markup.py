"""Headings and paragraphs of one HTML page.

The helper behind the element scan of :mod:`corpusloom.operators.html`. It walks the tags once
and keeps only what decides where a heading or paragraph ends; inline tags are passed over.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

from corpusloom.functions.text import WHITE_SPACE

_WHITE_SPACE_RUN = re.compile(f"[{WHITE_SPACE}]+")
_ODD_SEPARATOR = re.compile("[\x1c-\x1f]")

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:[^>=]++|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*+)(>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.S
)
_STANDARD_DOCTYPE = re.compile(r"\s*(?:<!--.*?-->\s*)*<!doctype\s+html\b", re.I | re.S)

# Element names of the HTML standard, by the rule they take part in.
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption "
    "figure footer form header hgroup listing main menu nav ol pre search section summary ul".split()
)
_LITERAL_TEXT = frozenset("iframe noembed noframes noscript script style xmp".split())
_DECODED_TEXT = frozenset("textarea title".split())
_SCOPE_LIMITS = frozenset(
    "applet caption marquee object table td template th".split()
)
_TABLE_SECTIONS = frozenset("tbody thead tfoot".split())
_ENDS_WITH_TAG = _BLOCKS | frozenset("applet button marquee object template".split())
_ENDS_PARAGRAPH = _BLOCKS | _HEADINGS | frozenset("dd dt hr li p plaintext xmp".split())
# What may stay open below a new table part.
_TABLE_PARENTS = {
    "caption": {"table"},
    "tbody": {"table"},
    "thead": {"table"},
    "tfoot": {"table"},
    "tr": {"table"} | _TABLE_SECTIONS,
    "td": {"table", "tr"} | _TABLE_SECTIONS,
    "th": {"table", "tr"} | _TABLE_SECTIONS,
}
_TRACKED = (
    _BLOCKS | _HEADINGS | _SCOPE_LIMITS | _TABLE_SECTIONS
    | frozenset("button dd dt hr li p plaintext tr".split())
)
_PLAIN_TEXT = _LITERAL_TEXT | _DECODED_TEXT | {"plaintext"}
_WATCHED = _TRACKED | _PLAIN_TEXT


def words_in(text: str) -> int:
    """Pieces between runs of Unicode white space."""
    if _ODD_SEPARATOR.search(text):  # str.split would also split at these
        return sum(1 for piece in _WHITE_SPACE_RUN.split(text) if piece)
    return len(text.split())


def _groups(name: str) -> tuple[str, ...]:
    """The limits an open element sets for the search of an open ancestor."""
    groups = []
    if name in _SCOPE_LIMITS:
        groups += ["#scope", "#button", "#list"]
    if name == "button":
        groups.append("#button")
    if name in ("ol", "ul"):
        groups.append("#list")
    if name not in ("address", "div", "p"):
        groups.append("#special")
    if name in _HEADINGS:
        groups.append("#heading")
    if name in ("table", "template"):
        groups.append("#table")
    return tuple(groups)


_GROUPS = {name: _groups(name) for name in _TRACKED}


class _OpenElements:
    """Open elements by depth, with the depths of every name at hand, so searches are O(1)."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.records: list[tuple | None] = []
        self.depths: dict[str, list[int]] = defaultdict(list)
        self.sinks: list[list[str]] = []

    def push(self, name: str, record: tuple | None = None) -> None:
        depth = len(self.names)
        self.names.append(name)
        self.records.append(record)
        for key in (name, *_GROUPS[name]):
            self.depths[key].append(depth)
        if record is not None:
            self.sinks.append(record[2])

    def close_to(self, depth: int) -> None:
        while len(self.names) > depth:
            name = self.names.pop()
            for key in (name, *_GROUPS[name]):
                self.depths[key].pop()
            if self.records.pop() is not None:
                self.sinks.pop()

    def last(self, key: str) -> int:
        depths = self.depths[key]
        return depths[-1] if depths else -1

    def close(self, key: str, limit: str) -> bool:
        """Close the last ``key`` unless a ``limit`` lies above it."""
        depth = self.last(key)
        if depth < 0 or depth < self.last(limit):
            return False
        self.close_to(depth)
        return True


def _class_attribute(attributes: str) -> str:
    """The value of the first class attribute, '' if there is none."""
    for match in _ATTRIBUTE.finditer(attributes):
        if match[1].lower() == "class":
            return html.unescape(match[2] or match[3] or match[4] or "")
    return ""


def _end_of_text(page: str, name: str, start: int) -> int:
    """Where the text of an element ends that holds no tags."""
    if name == "plaintext":
        return len(page)
    end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, start)
    return end.start() if end else len(page)


def page_elements(page: str) -> list[tuple[str, str, str]]:
    """(tag, class attribute, text) of all headings and paragraphs in document order."""
    page = page.replace("\r\n", "\n").replace("\r", "\n").replace("\0", "")
    table_ends_paragraph = _STANDARD_DOCTYPE.match(page) is not None
    found: list[tuple[str, str, list[str]]] = []
    opened = _OpenElements()
    sinks = opened.sinks
    search = _TOKEN.search

    def record(name: str, attributes: str) -> tuple[str, str, list[str]]:
        entry = (name, _class_attribute(attributes) if attributes else "", [])
        found.append(entry)
        return entry

    position, size = 0, len(page)
    while position < size:
        token = search(page, position)
        start, end = token.span() if token else (size, size)
        if sinks and start > position:
            piece = page[position:start]
            if "&" in piece:
                piece = html.unescape(piece)
            for sink in sinks:
                sink.append(piece)
        position = end
        if token is None:
            break
        closing, name, attributes, ended = token.groups()
        if not ended:
            continue  # no tag, or one cut off by the end of the page
        if name not in _WATCHED and (name := name.lower()) not in _WATCHED:
            continue
        if closing:
            _end_tag(opened, name, record)
            continue
        _start_tag(opened, name, attributes, record, table_ends_paragraph)
        if name in _PLAIN_TEXT:
            stop = _end_of_text(page, name, position)
            piece = page[position:stop]
            if sinks and piece:
                if name in _DECODED_TEXT:
                    piece = html.unescape(piece)
                for sink in sinks:
                    sink.append(piece)
            position = stop
    return [(name, classes, "".join(parts).strip(WHITE_SPACE)) for name, classes, parts in found]


def _start_tag(opened, name, attributes, record, table_ends_paragraph) -> None:
    if name in ("li", "dd", "dt"):
        for item in ("li",) if name == "li" else ("dd", "dt"):
            if opened.close(item, "#special"):
                break
    if name == "button":
        opened.close("button", "#scope")
    if name in _TABLE_PARENTS:
        if opened.last("table") < 0:
            return  # table parts outside a table are dropped
        depth, parents = len(opened.names), _TABLE_PARENTS[name]
        while opened.names[depth - 1] not in parents:
            depth -= 1
        opened.close_to(depth)
        opened.push(name)
        return
    if name in _ENDS_PARAGRAPH or (name == "table" and table_ends_paragraph):
        opened.close("p", "#button")
    if name in _HEADINGS and opened.names and opened.names[-1] in _HEADINGS:
        opened.close_to(len(opened.names) - 1)
    if name == "p" or name in _HEADINGS:
        opened.push(name, record(name, attributes))
    elif name in _TRACKED and name not in ("hr", "plaintext"):
        opened.push(name)


def _end_tag(opened, name, record) -> None:
    if name == "p":
        if not opened.close("p", "#button"):
            record("p", "")  # an end tag alone stands for an empty paragraph
    elif name in _HEADINGS:
        opened.close("#heading", "#scope")
    elif name == "li":
        opened.close("li", "#list")
    elif name in ("dd", "dt"):
        opened.close(name, "#scope")
    elif name in _TABLE_PARENTS or name == "table":
        opened.close(name, "#table")
    elif name in _ENDS_WITH_TAG:
        opened.close(name, "#scope")


def with_headings(elements: list[tuple[str, str, str]]) -> list[tuple]:
    """Add to every element its six heading texts; a heading clears the deeper levels."""
    context = [""] * 6
    result = []
    for name, classes, text in elements:
        if name != "p":
            level = int(name[1])
            context[level - 1 :] = [text] + [""] * (6 - level)
        result.append((name, text, words_in(text), *context, classes))
    return result
