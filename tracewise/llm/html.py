"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one for each block of the page. Each line weighs what its text says outside links, nothing
if it is boilerplate. Weights are summed over a sliding window; text starts where these sums surge and ends where they
dive to nothing. So a stretch of lines without text of their own, such as a menu of links, ends the text on every page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.shared import give_back, small_batches

WINDOW = 3  #: lines in a window
SURGE = 60  #: characters of a window from which text starts, on pages that mark no article; less if no window has as many

_TOKEN = re.compile(r"<!--|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)>?")
_NAMES = re.compile(r"""(?:class|id|role|aria-label|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template svg math canvas iframe object video audio select textarea head title".split())
#: Elements that are never part of the article.
BOILERPLATE = frozenset("nav footer aside form menu dialog button fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag ends an open element of the first group, unless one of the second was opened after it.
_CELL, _ROW = frozenset(("td", "th")), frozenset(("tr",))
ENDS = {
    "li": (frozenset(("li",)), frozenset("ul ol menu dir".split())),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))), "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "option": (frozenset(("option",)), frozenset(("optgroup",))),
    "td": (_CELL, frozenset(("tr", "table"))), "th": (_CELL, frozenset(("tr", "table"))), "tr": (_ROW, frozenset(("table",))),
}
#: Blocks inside a paragraph that leave it open.
IN_PARAGRAPH = frozenset("br button legend option optgroup caption tbody td tfoot th thead tr body html".split())
#: Values of class, id or role, or hyphenated parts of them, that name what is not the article.
NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header login"
    " masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion related replies"
    " respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget contentinfo complementary search".split()
)
#: What a hyphenated value may have beside them; with any other word, as in search-tips, it is a name of the text's own.
WITH_NAMES = frozenset(
    "area articles bar block bottom box button buttons container content desktop form global google icons inner item left link links list main"
    " mobile module overlay page panel post posts primary reader readers right row secondary section site slot sticky stories text title top"
    " unit user users wrap wrapper wp".split()
)
#: Names that say nothing against a part of an article.
OF_ARTICLES = frozenset("header login masthead modal search toolbar widget complementary".split())
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none""", re.I)
_SPACE = re.compile(r"\s+")
_LINK = re.compile(r"<(/?)a(?=[\s/>])", re.I)


@dataclass
class Line:
    text: str
    plain: int  #: characters outside links; all of a heading
    kept: bool  #: outside boilerplate
    article: bool


def _named(attributes: str, article: bool) -> bool:
    """Whether an element's names or its being hidden put it outside the article; within one, some names do not."""
    if _HIDDEN.search(attributes):
        return True
    against = NAMES - OF_ARTICLES if article else NAMES
    for value in _NAMES.findall(attributes):
        for token in value.strip("\"'").lower().split():
            parts = {x for x in re.split(r"[^a-z]+", token) if x}
            if parts & against and parts <= NAMES | WITH_NAMES:
                return True
    return False


class _Open:
    """Open elements: blocks, and within a dropped element those of its name. A dropped element ends with its own end
    tag, with that of an element round it, or where a start tag implies its end."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.count: dict[str, int] = {}
        self.at = -1  # the outermost dropped element, -1 if there is none
        self.loose = False  # whether only its names have dropped it

    def push(self, name: str) -> None:
        self.names.append(name)
        self.count[name] = self.count.get(name, 0) + 1

    def pop(self, to: int) -> None:
        while len(self.names) > to:
            self.count[self.names.pop()] -= 1
        if self.at >= len(self.names):
            self.at = -1

    def last(self, names: frozenset[str], stops: frozenset[str]) -> int:
        """Place of the innermost element of these names that no element of stops hides, or -1."""
        if any(self.count.get(n) for n in names):
            for i in range(len(self.names) - 1, -1, -1):
                if self.names[i] in names:
                    return i
                if self.names[i] in stops:
                    break
        return -1

    def implied(self, name: str) -> None:
        """Ends what the start tag of a block ends."""
        if name in ENDS and (i := self.last(*ENDS[name])) >= 0:
            self.pop(i)
        if name not in IN_PARAGRAPH and self.names and self.names[-1] == "p":
            self.pop(len(self.names) - 1)

    def close(self, name: str) -> None:
        if self.count.get(name):
            i = len(self.names) - 1
            while self.names[i] != name:
                if name not in BLOCKS and self.names[i] in BLOCKS:
                    return  # an inline element's end tag ends no block
                i -= 1
            self.pop(i)


def lines(page: str) -> list[Line]:
    """The page's blocks in order, with character references decoded and white space made single."""
    out: list[Line] = []
    parts: list[str] = []
    linked = 0
    opened = _Open()
    article, at, n = 0, 0, len(page)
    link, within, ends = False, 0, True  # in a link; how deep it began; whether an end tag is to come

    def close() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            heading = bool(opened.names) and opened.names[-1] in HEADINGS
            out.append(Line(text, len(text) if heading else max(0, len(text) - linked), opened.at < 0, article > 0))
        parts.clear()
        linked = 0

    def still() -> bool:
        """Whether the link goes on: not beyond the block that it began in, and without an end tag not beyond its line."""
        return link and ends and len(opened.names) >= within

    while at < n:
        m = _TOKEN.search(page, at)
        piece = page[at : m.start() if m else n]
        if piece:
            parts.append(piece)
            linked += len(piece) if link else 0
        if not m:
            break
        at = m.end()
        if m[0] == "<!--":
            end = page.find("-->", at)
            at = end + 3 if end >= 0 else n
            continue
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if name in RAW and not closing:
            if not attributes.endswith("/"):
                end = re.compile(f"</{name}\\b[^>]*>?", re.I).search(page, at)
                if end:
                    at = end.end()
                elif name != "head":
                    at = n
            continue
        if name in BLOCKS:
            close()
            link = still()
        if name == "a":
            link = not closing
            following = _LINK.search(page, at) if link else None
            within, ends = len(opened.names), bool(following and following[1])
        if name in ("article", "main"):
            article = max(0, article + (-1 if closing else 1))
        if name in VOID:
            continue
        if closing:
            if name not in BLOCKS and opened.at >= 0:
                close()
            opened.close(name)
            link = still() if name in BLOCKS else link
            continue
        if name in BLOCKS:
            opened.implied(name)
            link = still()
        if name in ("article", "main") and opened.at >= 0 and opened.loose and not _named(attributes, False):
            opened.at = -1  # what a name alone had put aside holds the article
        drop = False
        if opened.at < 0 and name not in ("html", "body", "article", "main"):
            by_kind = name in BOILERPLATE or name == "header" and article == 0
            drop = by_kind or bool(attributes) and _named(attributes, article > 0)
            if drop:
                close()
                opened.at, opened.loose = len(opened.names), not by_kind
        if drop or name in BLOCKS or opened.at >= 0 and opened.names[opened.at] == name:
            opened.push(name)
    close()
    return out


def spans(length: np.ndarray, surge: float, window: int = WINDOW) -> np.ndarray:
    """Whether each line lies between a surge and the next dive. length: what each line weighs. A line's sum is that of the
    window that starts with it; a run of lines whose sums are above 0 is kept from its first weight to its last if a
    window in it reaches `surge`."""
    n = len(length)
    keep = np.zeros(n, bool)
    total = np.convolve(length, np.ones(window), "full")[window - 1 :] if n else length  # of the lines from i on
    at = 0
    while at < n:
        if total[at] <= 0:
            at += 1
            continue
        dive = at
        while dive < n and total[dive] > 0:
            dive += 1
        if total[at:dive].max() >= surge:
            inside = np.flatnonzero(length[at:dive]) + at
            keep[inside[0] : inside[-1] + 1] = True
        at = dive
    return keep


def _weights(found: list[Line]) -> list[int]:
    """What the lines of an article weigh: a line that is wholly linked weighs as text, too, unless WINDOW of them in a row
    make a list of links. If there is nothing but such lists, they are the article."""
    weights, at = [x.plain if x.kept else 0 for x in found], 0
    while at < len(found):
        end = at
        while end < len(found) and found[end].kept and not found[end].plain:
            end += 1
        if 0 < end - at < WINDOW:
            weights[at:end] = [len(x.text) for x in found[at:end]]
        at = max(end, at + 1)
    return weights if any(weights) else [len(x.text) if x.kept else 0 for x in found]


def main_text(page: str | None) -> str:
    """Text of the article, blocks joined by a newline. Where an article or main element marks it, lines outside weigh
    nothing and any weight inside is a surge; elsewhere SURGE characters are one, or the page's largest window if that
    has fewer. Runs of links with no text between them are no text on pages that have any other."""
    found = lines(page or "")
    if marked := [x for x in found if x.article and x.kept]:
        found, surge = marked, 1.0
        length = np.array(_weights(found), float)
    else:
        length = np.array([x.plain if x.kept else 0 for x in found], float)
        most = np.convolve(length, np.ones(WINDOW)).max() if len(length) else 0
        surge = max(1, min(SURGE, most))
    return "\n".join(x.text for x, k in zip(found, spans(length, surge), strict=True) if k and x.kept)


@give_back
def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row. Null or empty html gives an empty text, an empty table no rows.
    Repeated rows give repeated results; null ids and urls stay; other columns, whatever their names, are not read. Pages
    of any length are read whole, in one pass."""
    small_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        _extracted, "page_id long, url string, text string, n_chars long"
    )
