"""Main text of HTML pages by text-to-tag ratios.

Parser events cut a page into lines, one for each block of text. A line's ratio is the length of its
text to the number of tags that came with it. The ratios are smoothed with a Gaussian, and lines above
one standard deviation are the content cluster. The smallest part of the page that holds all of that
text is the content region; its lines are the result, without the elements that markup names as
something else (menus, headers, footers, sidebars, notices, adverts, forms, comments), unless such an
element lies around the text itself. Inside an article a word that may be a topic ("discussion", "search")
is no more than a hint: there the ratios decide, against the smoothed ones of the article's other lines.
Containers and named elements are ranges of lines, so the work is linear in the page, however deep it nests.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import slices

FEED_CHARS = 1 << 16
SIGMA = 1.0
SHARE = 0.8  # of the page's text, around which an element is a wrapper
LIKE = 0.3  # of the mean level of an article's lines: a part of that ratio is like the rest

# Names from the HTML standard and words that mark other parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
LEFT_OUT = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer form frameset iframe input map menu meter nav noscript object "
    "option output progress script select style svg template textarea title video".split()
)
CONTAINERS = frozenset("article body center div main section table tbody td tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OTHER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
OTHER_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies dialog "
    "discussion disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "promoted promotion related replies respond search share sharing sidebar signup skyscraper social sponsor sponsored subscribe "
    "subscription teaser toolbar widget widgets".split()
)
# of these, words that may also be the topic of a section
TOPICS = frozenset(
    "alert banner consent cookie cookies dialog discussion menu navigation notice notices promotion related replies respond search share "
    "sharing social sponsor subscribe subscription".split()
)
# words that go with them in names of page parts; cut off from a word before them as well
COMPANIONS = frozenset(
    "area articles bar block box button buttons container content form group holder icons item items label links list panel posts row "
    "section slot stories thread title unit widget wrap wrapper".split()
)
ARTICLE_WORDS = frozenset("comment teaser ad advert sponsored".split())
# a class that begins so states how the page is laid out, not what the element is
LAYOUT_STARTS = frozenset("has no with without is not js supports show hide".split())
HEADER_NAMES = frozenset(("header", "site-header", "page-header", "main-header", "top-header", "global-header"))
COMMENT_TITLE = re.compile(
    r"(?:\d+ )?(?:(?:reader|user) )?(?:comments?|responses|replies|leave a (?:comment|reply)|join the (?:discussion|conversation))(?: ?\(?\d+\)?)?:?",
    re.IGNORECASE,
)

_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z0-9])(?=[A-Z])")
_COMPOUND = re.compile(f"({'|'.join(sorted(OTHER_WORDS))})({'|'.join(sorted(COMPANIONS))})")


def _words(name: str) -> list[str]:
    """The words of a class or id, in lower case, also of camel case and of compounds like ``commentlist``."""
    words = []
    for word in _SPLIT.split(name):
        word = word.lower()
        cut = None if word in OTHER_WORDS else _COMPOUND.fullmatch(word)
        words += cut.groups() if cut else [word] if word else []
    return words


def _is_hint(words: list[str]) -> bool:
    """The words that mark a page part may be a topic here, and no other word says that they are not."""
    marked = [w for w in words if w in OTHER_WORDS]
    return all(w in TOPICS for w in marked) and COMPANIONS.isdisjoint(words)


class _Line:
    __slots__ = ("text", "ratio", "links", "place", "at", "heading", "inner", "main")

    def __init__(self, text: str, tags: int, linked: int, place: int, at: int, heading: bool, inner: bool, main: bool) -> None:
        self.text, self.heading = text, heading
        self.place = place  # among all lines
        self.at = at  # the smallest container around it
        self.inner, self.main = inner, main  # inside an article or main; inside a main
        self.ratio = len(text) / max(1, tags)
        self.links = 2 * linked > len(text)  # mostly links


class _Part:
    """A run of lines: a container, or an element whose name is one of something else."""

    __slots__ = ("name", "parent", "start", "end", "hint", "items", "around")

    def __init__(self, name: str, parent: int, start: int) -> None:
        self.name, self.parent, self.start, self.end = name, parent, start, start
        self.hint = False  # its name may be a topic
        self.items = 0  # lines inside list items and articles of it
        self.around = 0  # characters of the articles and mains that it lies around


class LineParser(HTMLParser):
    """Collects the lines of a page, and the containers and named elements as runs of lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.parts: list[_Part] = [_Part("page", -1, 0)]  # containers
        self.marks: list[_Part] = []  # elements whose name is one of something else
        self._open: list[tuple[str, bool]] = []  # open elements, and whether it is a container
        self._where: defaultdict[str, list[int]] = defaultdict(list)  # of each tag, its places among the open elements
        self._path: list[int] = [0]
        self._skip: int | None = None  # open elements before the one that is left out
        self._marked: list[tuple[int, int, int]] = []  # of each open mark: open elements before it, its number, tags before it
        self._inner: list[tuple[int, int]] = []  # of each open article or main: open elements before it, its number
        self._inner_sizes: list[int] = []  # of each article or main: characters of which it is the innermost
        self._inner_size = 0
        self._pieces: list[str] = []
        self._tags = self._linked = self._headings = 0
        self._link = self._heading = False

    def _flush(self) -> None:
        if self._pieces:
            text = " ".join("".join(self._pieces).split())
            if text:
                line = _Line(
                    text, self._tags, self._linked, len(self.lines), self._path[-1], self._heading, bool(self._inner), bool(self._where["main"])
                )
                self.lines.append(line)
                if self._inner:
                    self._inner_sizes[self._inner[-1][1]] += len(text)
                    self._inner_size += len(text)
                if self._marked:
                    before, number, _ = self._marked[-1]
                    self.marks[number].items += any(self._where[tag] and self._where[tag][-1] > before for tag in ("li", "article"))
                self._tags = self._linked = 0
            self._pieces = []
        self._heading = False

    def _around(self) -> int:
        """Characters in articles and mains so far, without those of the innermost open one itself."""
        return self._inner_size - (self._inner_sizes[self._inner[-1][1]] if self._inner else 0)

    def _other(self, tag: str, attributes: list[tuple[str, str | None]]) -> str:
        """``out`` for an element that is left out, ``mark`` or ``hint`` for one whose name says so, which may yet be content."""
        if tag in LEFT_OUT and tag != "form":
            return "out"
        inside = self._where["article"] or self._where["main"]
        if tag == "header" and not inside:
            return "out"
        named, hint = tag == "form", False
        for name, value in attributes:
            if name == "hidden":
                return "out"
            value = value or ""
            lower = value.lower()
            if name == "role" and lower.strip() in OTHER_ROLES:
                named = True
            if name == "style" and "display:none" in lower.replace(" ", ""):
                return "out"
            if name in ("class", "id") and tag not in ("html", "body", "main"):
                for words in map(_words, value.split()):
                    if not words or words[0] in LAYOUT_STARTS:
                        continue
                    known = ARTICLE_WORDS if tag == "article" else OTHER_WORDS
                    if known.isdisjoint(words):
                        continue
                    if inside and _is_hint(words):
                        hint = True
                    else:
                        named = True
                if tag != "article" and not inside and not HEADER_NAMES.isdisjoint(lower.split()):
                    named = True
        if named and not (inside and tag in HEADINGS):
            return "out" if tag in INLINE else "mark"
        # a heading or a phrase in an article is named after its topic
        return "hint" if hint and tag not in INLINE and tag not in HEADINGS else ""

    def _close(self, keep: int) -> None:
        """Close the open elements beyond the first ``keep``."""
        while len(self._open) > keep:
            tag, container = self._open.pop()
            self._where[tag].pop()
            self._headings -= tag in HEADINGS
            if container:
                self.parts[self._path.pop()].end = len(self.lines)
            if self._marked and self._marked[-1][0] == len(self._open):
                _, number, self._tags = self._marked.pop()
                self.marks[number].end = len(self.lines)
                self.marks[number].around += self._around()
            if self._inner and self._inner[-1][0] == len(self._open):
                self._inner.pop()
        if self._skip is not None and len(self._open) <= self._skip:
            self._skip = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self._skip is None:
            self._tags += 1
            if tag == "br":
                self._pieces.append(" ")
            elif tag == "a":
                self._link = True
        if tag in VOID:
            return
        if tag in ("article", "main") and self._skip is not None and self._open[self._skip][0] in ("nav", "header", "menu"):
            self._close(self._skip)  # it was never closed
        other = self._other(tag, attrs) if self._skip is None and (attrs or tag in LEFT_OUT or tag == "header") else ""
        if tag in INLINE and not other:
            if self._skip is not None and self._open and self._open[-1][0] == tag and len(self._open) == self._skip + 1:
                self._push(tag)  # the same inline element inside one that is left out
            return
        if tag not in INLINE:
            self._flush()
            self._link = False
            # a block ends an open paragraph, an item an open item
            last = self._open[-1][0] if self._open else ""
            if last == "p" or last == tag and tag in ("li", "dt", "dd", "option", "tr", "td", "th"):
                self._close(len(self._open) - 1)
        if other == "out":
            self._flush()
            self._skip = len(self._open)
        elif other:
            self._flush()
            self._marked.append((len(self._open), len(self.marks), self._tags))
            mark = _Part(tag, -1, len(self.lines))
            mark.hint, mark.around = other == "hint", -self._around()
            self.marks.append(mark)
        elif tag in ("article", "main") and self._skip is None:
            self._inner.append((len(self._open), len(self._inner_sizes)))
            self._inner_sizes.append(0)
        self._push(tag)

    def _push(self, tag: str) -> None:
        container = tag in CONTAINERS and self._skip is None
        if container:
            self.parts.append(_Part(tag, self._path[-1], len(self.lines)))
            self._path.append(len(self.parts) - 1)
        self._where[tag].append(len(self._open))
        self._open.append((tag, container))
        self._headings += tag in HEADINGS

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as browsers do, the slash is passed over

    def handle_endtag(self, tag: str) -> None:
        if self._skip is None:
            self._tags += 1
        if tag == "a":
            self._link = False
        if tag not in INLINE:
            self._flush()
            self._link = False
        if self._where[tag]:
            at = self._where[tag][-1]
            # a stray end of an inner element does not close what is left out
            bound = self._skip if self._skip is not None else self._marked[-1][0] if self._marked else 0
            if at >= bound or tag in CONTAINERS:
                self._close(at)

    def handle_data(self, data: str) -> None:
        if self._skip is None:
            # a header inside an article keeps its headings
            if self._where["header"] and not self._headings:
                return
            self._pieces.append(data)
            self._heading = self._heading or self._headings > 0
            if self._link:
                self._linked += len(data)

    def close(self) -> None:
        super().close()
        self._flush()
        self._close(0)
        self.parts[0].end = len(self.lines)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; the ends repeat."""
    radius = int(np.ceil(3 * sigma))
    kernel = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * sigma**2))
    padded = np.pad(ratios, radius, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def _sums(values: list[float]) -> np.ndarray:
    """Sums of the values before each place."""
    return np.concatenate([[0.0], np.cumsum(values)])


def _like_the_rest(parser: LineParser, level: np.ndarray) -> list[bool]:
    """Of each mark that may be a topic, whether its text has a ratio like that of the article's other lines.

    Its own ratios are taken as they are: smoothed, a short part would have the level of what is around it.
    A part that is a list, or mostly links, is none of the text whatever its ratio.
    """
    lines, marks = parser.lines, parser.marks
    named = np.zeros(len(lines) + 1)
    for mark in marks:
        named[mark.start] += 1
        named[mark.end] -= 1
    named = np.cumsum(named[:-1])
    rest = [a for x, a, n in zip(lines, level, named, strict=True) if x.inner and not n and not x.links and not x.heading]
    needed = LIKE * float(np.mean(rest)) if rest else np.inf
    ratios, plain, links = _sums([x.ratio * (not x.heading) for x in lines]), _sums([not x.heading for x in lines]), _sums([x.links for x in lines])
    found = []
    for mark in marks:
        size = mark.end - mark.start
        texts = plain[mark.end] - plain[mark.start]
        listed = mark.items > 1 and mark.items >= texts
        linked = 2 * (links[mark.end] - links[mark.start]) > size
        found.append(bool(mark.hint and texts and not listed and not linked and ratios[mark.end] - ratios[mark.start] >= needed * texts))
    return found


def _comment_sections(parser: LineParser, lengths: np.ndarray) -> list[tuple[int, int]]:
    """Containers that begin with a title of comments and do not hold most of the text."""
    found = []
    for line in parser.lines:
        if line.heading and COMMENT_TITLE.fullmatch(line.text):
            part = parser.parts[line.at]
            held = lengths[part.end] - lengths[part.start]
            if part.name in ("div", "section") and part.start == line.place and 2 * held <= lengths[-1]:
                found.append((part.start, part.end))
    return found


def kept_lines(parser: LineParser) -> list[_Line]:
    """The lines without the parts that are named as something else.

    An element that lies around most of the text in articles and main, or around most text of the
    page, is a wrapper whatever it is called. If nothing else is left, all lines stay.
    """
    lines = parser.lines
    if not lines:
        return lines
    lengths = _sums([len(x.text) for x in lines])
    inner = sum(len(x.text) for x in lines if x.inner)
    level = smoothed(np.array([x.ratio for x in lines]))
    out = _comment_sections(parser, lengths)
    for mark, like in zip(parser.marks, _like_the_rest(parser, level) if parser.marks else (), strict=True):
        wrapper = lengths[mark.end] - lengths[mark.start] >= SHARE * lengths[-1] or 2 * mark.around > inner
        if not like and not wrapper:
            out.append((mark.start, mark.end))
    left_out = np.zeros(len(lines) + 1, int)
    for start, end in out:
        left_out[start] += 1
        left_out[end] -= 1
    return [x for x, n in zip(lines, np.cumsum(left_out[:-1]), strict=True) if not n] or lines


def main_text(html: str) -> str:
    """The blocks of the content region, joined by line ends."""
    parser = LineParser()
    for start in range(0, len(html), FEED_CHARS):
        parser.feed(html[start : start + FEED_CHARS])
    parser.close()
    parts, lines = parser.parts, kept_lines(parser)
    if not lines:
        return ""
    level = smoothed(np.array([x.ratio for x in lines]))
    limit = level.std()
    content = [x for x, a in zip(lines, level > limit, strict=True) if a and not x.links]
    content = content or [x for x in lines if not x.links]
    if not content:
        # a page of nothing but links has text only where markup says so
        return "\n".join(x.text for x in lines if x.inner)
    # what main holds is the page's own text, where it holds most of it
    main = [x for x in content if x.main]
    if 2 * sum(len(x.text) for x in main) > sum(len(x.text) for x in content):
        content = main
    # the smallest container around all of it
    at = content[0].at
    while parts[at].end <= content[-1].place:
        at = parts[at].parent
    # it grows by what holds nothing more than its heading, but not beyond main, nor beyond an article without main
    stops = {}
    above = at
    while above >= 0:
        stops.setdefault(parts[above].name, above)
        above = parts[above].parent
    stop = stops.get("main", stops.get("article", 0))
    plain = np.zeros(len(parser.lines))
    plain[[x.place for x in lines if not x.heading and not x.links]] = 1
    texts = _sums(plain)

    def held(part: _Part) -> float:
        return texts[part.end] - texts[part.start]

    while at > stop and held(parts[parts[at].parent]) == held(parts[at]):
        at = parts[at].parent
    inside = [x for x in lines if parts[at].start <= x.place < parts[at].end]
    # links before and after the text are menus, unless an article or main holds them
    text = [k for k, x in enumerate(inside) if x.inner or not x.links]
    return "\n".join(x.text for x in inside[text[0] : text[-1] + 1])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            found = [main_text(html or "") for html in part.column("html").to_pylist()]
            columns = [part.column("page_id"), part.column("url"), pa.array(found, pa.large_string()).cast(pa.string()), pa.array(map(len, found), pa.int64())]
            yield pa.record_batch(columns, names=["page_id", "url", "text", "n_chars"])


def extract_main_text(df: DataFrame) -> DataFrame:
    """The main text of each page (page_id, url, html): page_id, url, text and n_chars (code points).

    White space inside a block is one space; blocks are joined by a line end in page order. A null or
    empty html, or one without text in its content region, gives an empty text. Markup of any depth and
    named elements of any number cost time in proportion to the page. Each row is returned,
    also where ids are missing or repeated. An empty table gives no rows. Further columns are ignored.
    There is no shuffle.
    """
    rows = df.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
