"""Main text of web pages by the distribution of text over line blocks.

A page becomes lines: markup, comments, scripts and styles are cut out, block elements end a line. A line weighs as many characters
as it has outside links. The weights of `WINDOW` lines in a row are added up over a sliding window; where the sums rise from
nothing is a surge, where they fall back to nothing a dive, and the lines between the two are a region. Regions of
the page whose sums peak high enough are its text.

Markup tells more than lengths alone and is used where the page has it. A part that is no text by its element, role or class (menus, forms,
adverts, notices, comments of readers and so on) gives no lines. If the page marks its article or main part, lines outside
weigh nothing, and every region that is left counts, however short: a one-line article is one.

A page is read once, row by row; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import quoted
from corpusloom.llm.grams import chunks

#: Lines added up in one window.
WINDOW = 3
#: Without a marked article, a region counts from this share of the page's highest window sum on.
PEAK_SHARE = 0.3

# Quantifiers are possessive: no input makes them try again.
_TAG = re.compile(
    r"""<!--(?:(?!-->).)*+(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z>][^>]*+>|</>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=/>]++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Elements and words of HTML.
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody tfoot thead tr ul""".split()
)
BOXES = frozenset("article aside body dialog div footer form header main nav section table".split())
#: Elements that never hold main text.
ASIDE = frozenset("nav footer aside form button select svg math dialog menu head object audio video canvas map datalist search input".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
#: Words in a class or id that mark a part as no main text.
CLASSES = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promoted promotion banner sidebar sidebars aside menu menus
    nav navbar navigation navi breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices popup modal overlay comment comments commentlist
    disqus respond reply replies newsletter subscribe subscription signup share sharing social related recommended recommendations widget widgets toolbar
    masthead login search pagination pager skip toc alert alerts copyright disclaimer""".split()
)
#: A class like `has-sidebar` or `sidebar-layout` names the frame of a page, not the part itself.
OWNS = frozenset("has have with without no is".split())
FRAMES = frozenset("layout page main article site".split())
READERS = frozenset("comment comments commentlist disqus reply replies respond".split())
#: A paragraph or item is ended by the start of these.
_ENDS_P = BLOCKS - {"body", "html", "head", "caption", "legend", "summary", "option", "figcaption", "tbody", "thead", "tfoot", "tr"}
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr"}}


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), unescape(value.strip("\"'")))
    return out


def _set_aside(name: str, attributes: str, in_article: bool) -> bool:
    """Is the element no main text by its name, role, class or visibility?"""
    if name in ASIDE or (name == "header" and not in_article):
        return True
    if not attributes or attributes.isspace():
        return False
    found = _attributes(attributes)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return name not in ("html", "body")
    if found.get("role", "").lower() in ROLES:
        return True
    if name in ("html", "body"):
        return False
    for word in (found.get("class", "") + " " + found.get("id", "")).split():
        parts = [w.lower() for w in _PARTS.findall(word)]
        if OWNS.intersection(parts) or not parts:
            continue
        # An article or main part is only set aside as a reader's comment.
        if READERS.intersection(parts) and (name not in ("article", "main") or parts[0] in READERS):
            return True
        if name not in ("article", "main") and CLASSES.intersection(parts) and parts[-1] not in FRAMES:
            return True
    return False


class Page:
    """Lines of a page: text, characters in links, and whether the line stands in a marked article or main part."""

    def __init__(self, html: str, gap: int = WINDOW):
        self.lines: list[tuple[str, int, int]] = []
        self._gap = gap
        # Open elements: name, set aside, mark (2 in an article, 1 in a main part), in a link.
        self._open: list[tuple[str, bool, int, bool]] = []
        self._counts: Counter[str] = Counter()
        self._text: list[str] = []
        self._links: list[str] = []
        self._read(html)

    def _end_line(self, box: bool = False) -> None:
        text = " ".join(unescape("".join(self._text)).split())
        if text:
            links = " ".join(unescape("".join(self._links)).split())
            self.lines.append((text, len(links), self._mark()))
        self._text, self._links = [], []
        if box:
            self._blank(1)

    def _blank(self, n: int) -> None:
        """At least `n` empty lines here."""
        have = 0
        while have < n and have < len(self.lines) and not self.lines[-1 - have][0]:
            have += 1
        self.lines.extend([("", 0, self._mark())] * (n - have))

    def _mark(self) -> int:
        return self._open[-1][2] if self._open else 0

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._text.append(" ")
            return
        if name in ("td", "th"):
            self._text.append(" ")
        if name in BLOCKS:
            self._end_line(name in BOXES)
            if name in _ENDS_P:
                self._close("p", stop=BOXES | {"li", "td", "th", "blockquote"})
            if name in _SAME:
                self._close(_SAME[name], stop=BOXES | {"ul", "ol", "dl", "select"})
        if name in VOID or attributes.endswith("/") and name in ("svg", "path", "use"):
            return
        _, within, mark, link = self._open[-1] if self._open else ("", False, 0, False)
        aside = within or _set_aside(name, attributes, mark > 0)
        if aside and not within and not mark:
            self._end_line()
            self._blank(self._gap)  # a part set aside parts the lines around it
        role = re.search(r"role\s*=\s*[\"']?(main|article)\b", attributes) if "role" in attributes else None
        mark = max(mark, 2 if name == "article" else 1 if name == "main" or role else 0)
        self._open.append((name, aside, mark, link or name == "a"))
        self._counts[name] += 1

    def _close(self, name: str | set[str], stop: frozenset | set = frozenset()) -> bool:
        names = {name} if isinstance(name, str) else name
        if not any(self._counts[n] for n in names):
            return False
        for at in range(len(self._open) - 1, -1, -1):
            if self._open[at][0] in names:
                self._counts.subtract(entry[0] for entry in self._open[at:])
                del self._open[at:]
                return True
            if self._open[at][0] in stop:
                return False
        return False

    def _end(self, name: str) -> None:
        if name in BLOCKS:
            self._end_line(name in BOXES)
        if name == "br":
            self._text.append(" ")
        elif name == "p" or name not in BOXES:
            # A stray end of an inner element closes nothing beyond the box it stands in.
            self._close(name, stop=BOXES)
        else:
            self._close(name)

    def _read(self, html: str) -> None:
        at = 0
        find = _TAG.search
        while match := find(html, at):
            if match.start() > at:
                self._add(html[at : match.start()])
            at = match.end()
            name = match[2]
            if name is None:
                continue
            name = name.lower()
            if match[1]:
                self._end(name)
            elif name in RAW and not match[3].endswith("/"):
                closing = re.compile(rf"</{name}\b[^>]*+(?:>|\Z)", re.I).search(html, at)
                at = closing.end() if closing else len(html)
            else:
                self._start(name, match[3])
        if at < len(html):
            self._add(html[at:])
        self._end_line()

    def _add(self, text: str) -> None:
        if self._open and self._open[-1][1]:
            return
        self._text.append(text)
        if self._open and self._open[-1][3]:
            self._links.append(text)


def regions(weights: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge, dive, peak) of every region: first line, line behind the last, highest sum of a window in it.

    A region lasts as long as no window lies wholly on lines without weight.
    """
    if not weights.any():
        return []
    sums = np.convolve(weights, np.ones(window, np.int64))  # sums[i] covers the lines i - window + 1 .. i
    rising = np.diff(np.concatenate([[0], (sums > 0).astype(np.int8), [0]]))
    out = []
    for begin, end in zip(np.flatnonzero(rising == 1).tolist(), np.flatnonzero(rising == -1).tolist(), strict=True):
        out.append((begin, end - window + 1, int(sums[begin:end].max())))
    return out


def main_text(html: str | None, window: int = WINDOW, peak_share: float = PEAK_SHARE) -> str:
    """The main text of a page, one block a line; '' for a null or empty page and for one without text.

    Lines without weight (empty, or links alone) that lie between a surge and a dive belong to the text.
    """
    if not html:
        return ""
    lines = Page(html, window).lines
    most = max((mark for _, _, mark in lines), default=0)
    inside = np.array([mark == most for _, _, mark in lines], bool)
    if most:  # what the page marks as its article; links in it are text
        weights = np.array([len(text) for text, _, _ in lines], np.int64) * inside
        least = 1
    else:
        weights = np.array([len(text) - links for text, links, _ in lines], np.int64)
        found = regions(weights, window)
        least = max([1, *(int(peak * peak_share) for _, _, peak in found)])
    kept = [lines[i][0] for surge, dive, peak in regions(weights, window) if peak >= least for i in range(surge, dive) if inside[i] and lines[i][0]]
    return "\n".join(kept)


def extract_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    A null or empty page, and one without main text, gives an empty text. Null ids and urls stay null, repeated rows are
    separate pages, an empty table gives no rows. Pages are read whole, however long. Other columns are not read.
    """
    narrow = pages.select(
        F.col(quoted(id_column)).cast("long").alias("page_id"), F.col(quoted(url_column)).cast("string").alias("url"),
        F.coalesce(F.col(quoted(html_column)), F.lit("")).alias("text"),
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _ in chunks(batch):
                texts = [main_text(html) for html in part.column("text").to_pylist()]
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.record_batch(columns, names=["page_id", "url", "text", "n_chars"])

    return narrow.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
