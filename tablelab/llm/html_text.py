"""Main text of web pages from streaming parser events and text-to-tag ratios.

The standard library's parser reads a page as events.  They are folded into lines, one
for each block of the page (a paragraph, heading, list item, table row), with the text,
the number of tags and the element each stands in.  Lines inside menus, headers, footers,
sidebars, notices, adverts, forms and reader comments hold no content.

On every page the logarithms of the lines' text-to-tag ratios, so that no line outweighs the
others, are smoothed by a Gaussian; lines above the threshold, the standard deviation of
the smoothed values, form clusters, and these choose the regions that are the main text.
``article`` and ``main`` elements weigh in: if the clusters within them hold a share
(``REGION_WEIGHT``) of the clusters' text, the outermost of them are the regions.
Otherwise (a teaser marked up as an article beside the story, or no such element) it is the
innermost block around the clusters outside of them.  Within a region every line stays, also
a short one.

Class and id names also mark what is around the main text ("no-sidebar").  An ``article`` or
``main`` in such a container counts, unless it is among comments; among what may hold other
articles' teasers it counts if such regions hold more text than those in fewer such
containers.  Within a region a name marks only if all its words do ("share-buttons", not
"market-share"), and what holds more text than the rest of the region is part of it.  A page
on which nothing is held is read again without the marks and forms around its content.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.llm.common import col

#: Standard deviation of the smoothing, in lines.
SIGMA = 1.0
#: Characters given to the parser at a time.
CHUNK = 1 << 20

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Cells of one row are words of one line.
SPACED = set("br td th".split())
#: Never content, wherever they stand.
DROPPED = set(
    "head script style noscript template nav aside form button select textarea iframe object svg canvas video audio "
    "dialog menu footer".split()
)
REGIONS = {"article", "main"}
NEVER_AROUND = {"nav", "aside", "form", "footer", "head", "header"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Parts of a text, which hold no whole one.
PARTS = HEADINGS | set(
    "address blockquote caption dd details dl dt figcaption figure li ol p pre summary table tbody td tfoot th thead tr ul".split()
)
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
COMMENTS = set("comment comments commentlist disqus reactions respond replies".split())
#: Words of class and id that mark what isn't content.
MARKS = COMMENTS | set(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies footer "
    "gdpr masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promotion "
    "promoted related share sharing sidebar social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
HEADER_MARKS = {"header", "masthead"}
#: Words that say nothing beside a mark.
PLAIN_WORDS = set(
    "area articles bar block bottom box button buttons col container content group head icon icons inner item items left "
    "link links list main outer panel post posts right row section signup slot text title top unit wrap wrapper".split()
)
#: Clusters in articles decide if they hold at least one part in so many of what those outside hold.
REGION_WEIGHT = 3
_HIDDEN = re.compile(r"(display\s*:\s*none|visibility\s*:\s*hidden)", re.IGNORECASE)
#: Of the marks, those of containers that may hold other articles' teasers.
OTHERS = set("promo promoted promotion related sidebar sponsor sponsored widget widgets".split())
#: Passes without the outermost marks and forms, one level more each time; the last one is without any.
PASSES = 4
_CONTENT, _MARKED, _DROPPED = range(3)
#: Ranks of open elements within a marked container: teasers may follow, no region may.
_PLAIN, _TEASERS, _NEVER = range(3)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class LineParser(HTMLParser):
    """Folds a page's events into ``lines``: (text, tags, region, is content possible, is a heading, block, part).

    ``part``: the number of the part of a region, dropped for its marks, that the line is in; else 0.

    ``doubtful``: regions in containers of other articles, and in how many.  ``allow``: how many marked elements or
    forms around content don't drop it.

    ``blocks`` has (element, block around it, last block within) of each block, in the order
    they open; block 0 is the page.
    """

    def __init__(self, allow: int = 0) -> None:
        super().__init__(convert_charrefs=True)
        self.allow, self.allowed, self.marked, self.retry = allow, 0, False, False
        self.doubtful: dict[int, int] = {}
        self.parts = self.part = 0  # of regions, dropped for their marks
        self.drop_at = 0  # place of the element that the present drop began with
        self.ranks = [0, 0, 0]  # open elements of each rank
        self.lines: list[tuple[str, int, int, bool, bool, int, int]] = []
        self.blocks: list[list] = [["", 0, 0]]
        # Element, starts a drop, starts a region, block it stands in or is, rank, the drop it suspends, is allowed.
        self.open: list[tuple[str, bool, bool, int, int, tuple | None, int]] = []
        self.count: Counter[str] = Counter()  # of open elements
        self.dropped = ""  # the element that the present drop began with
        self.drops = self.regions = self.region = self.seen = self.tags = 0
        self.text: list[str] = []
        self.heading = False

    def _end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text or self.tags:
            block = self.open[-1][3] if self.open else 0
            self.lines.append((text, self.tags, self.region if self.regions else 0, not self.drops, self.heading, block, self.part if self.drops else 0))
        self.text, self.tags, self.heading = [], 0, False

    def _drops(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[int, set[str]]:
        """Whether the element is content, dropped for its marks or as a form, or dropped; and its marks."""
        if tag in DROPPED:
            return (_MARKED if tag == "form" else _DROPPED), set()
        if tag in ("html", "body", "main") or tag in HEADINGS:
            return _CONTENT, set()
        values = dict(attrs)
        if "hidden" in values or (values.get("role") or "").lower() in ROLES or _HIDDEN.search(values.get("style") or ""):
            return _DROPPED, set()
        names = [{p.lower() for p in _PARTS.findall(x)} for name in ("class", "id") for x in (values.get(name) or "").split()]
        words = set().union(*names)
        marks = words & MARKS
        if self.regions and marks:
            sure = [x for x in names if all(w in MARKS or w in PLAIN_WORDS or w.isdigit() for w in x)]
            # A menu in a text's section is one of dishes; menus of links are lists.
            marks = (set().union(*sure) & MARKS - ({"menu"} if tag == "section" else set())) | (words & COMMENTS)
        if tag in REGIONS:
            return (_MARKED if marks & COMMENTS else _CONTENT), marks & COMMENTS
        # A header inside an article holds its title.
        if not self.regions and tag == "header":
            return _DROPPED, marks
        if not self.regions:
            marks |= words & HEADER_MARKS
        return (_MARKED if marks else _CONTENT), marks

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in SPACED:
            self.text.append(" ")
        if tag not in INLINE and tag not in SPACED:
            self._end_line()
            self.heading = tag in HEADINGS
        self.tags += 1
        if tag in VOID:
            return
        kind, marks = self._drops(tag, attrs)
        if tag in SPACED and kind != _CONTENT:
            self._end_line()  # a cell that isn't content is no part of its row
        suspended = None
        if tag in REGIONS and self.drops and not self.regions:
            if self.dropped in NEVER_AROUND:
                # Left open before the main text, which such elements don't hold.
                while self.drops:
                    self._pop()
            elif self.marked and not self.ranks[_NEVER] and kind == _CONTENT:
                if self.ranks[_TEASERS]:
                    self.drops, suspended = 0, (self.dropped, self.drop_at, self.marked)
                    self.doubtful[self.seen + 1] = self.ranks[_TEASERS]
                else:
                    # A class or id of what is around the main text, or left open before it.
                    began = self.open[self.drop_at]
                    self.open[self.drop_at] = (began[0], False, *began[2:])
                    self.drops = 0
        allowed = int(not self.drops and kind == _MARKED and self.allowed < self.allow)
        drop = not self.drops and kind != _CONTENT and not allowed
        region = tag in REGIONS and not self.drops and not drop and not self.regions
        rank = _PLAIN
        if drop or self.drops:
            if marks & COMMENTS or (kind == _DROPPED and tag not in NEVER_AROUND):
                rank = _NEVER
            elif marks & OTHERS:
                rank = _TEASERS
        block = self.open[-1][3] if self.open else 0
        if tag not in INLINE:
            self.blocks.append([tag, block, 0])
            block = len(self.blocks) - 1
        self.open.append((tag, drop, region, block, rank, suspended, allowed))
        self.count[tag] += 1
        self.ranks[rank] += 1
        self.allowed += allowed
        if drop:
            self.drops, self.dropped, self.drop_at, self.marked = 1, tag, len(self.open) - 1, kind == _MARKED
            self.retry |= self.marked
            soft = self.regions and self.marked and tag != "form" and not marks & COMMENTS
            self.parts += bool(soft)
            self.part = self.parts if soft else 0
        if region:
            self.seen += 1
            self.regions, self.region = 1, self.seen

    def _pop(self) -> str:
        tag, drop, region, block, rank, suspended, allowed = self.open.pop()
        if tag not in INLINE:
            self.blocks[block][2] = len(self.blocks) - 1
        self.count[tag] -= 1
        self.ranks[rank] -= 1
        self.allowed -= allowed
        self.drops -= drop
        if suspended:
            self.drops, (self.dropped, self.drop_at, self.marked) = 1, suspended
        self.regions -= region
        return tag

    def handle_endtag(self, tag: str) -> None:
        if tag in SPACED and self.drops:
            self._end_line()
        elif tag in SPACED:
            self.text.append(" ")
        elif tag not in INLINE:
            self._end_line()
        self.tags += 1
        if self.count[tag]:
            while self._pop() != tag:
                pass

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_data(self, data: str) -> None:
        self.text.append(data)

    def finish(self) -> None:
        self.close()
        self._end_line()
        while self.open:
            self._pop()
        self.blocks[0][2] = len(self.blocks) - 1


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; the first and last value go on beyond the ends."""
    reach = max(1, int(np.ceil(3 * sigma)))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach, mode="edge"), weights / weights.sum(), mode="valid")


_DEAD = re.compile(r"<(?:!--|[!?]|(script|style)(?=[\s/>]))", re.IGNORECASE)
_CLOSING = {t: re.compile(f"</{t}(?=[\\s/>])", re.IGNORECASE) for t in ("script", "style")}
_OPENING = re.compile(r"<[a-zA-Z/!?]")


def without_dead_text(html: str) -> str:
    """A page without comments, declarations, and the content of scripts and styles.

    What is left open goes to the page's end, as browsers do.  One pass, whatever the page
    holds; the parser would search to the end again for each thing left open.
    """
    out, at = [], 0
    while m := _DEAD.search(html, at):
        out.append(html[at : m.start()])
        if html[m.start() - 1 : m.start()] == "<":
            out.append(" ")  # a lone < must not join what follows
        if m[1]:
            closing = _CLOSING[m[1].lower()].search(html, m.end())
            end = html.find(">", closing.end()) if closing else -1
        else:
            end = html.find("-->", m.start() + 2) if m[0] == "<!--" else html.find(">", m.start())
            end += 2 * (end >= 0 and m[0] == "<!--")
        if end < 0:
            return "".join(out)
        at = end + 1
    out.append(html[at:])
    return "".join(out)


def parsed(html: str) -> LineParser:
    """The lines and blocks of a page."""
    html = without_dead_text(html)
    # A tag that the page's end cuts off is no text.
    if cut := _OPENING.search(html, html.rfind(">") + 1):
        html = html[: cut.start()]
    for allow in (*range(PASSES), len(html)):
        parser = LineParser(allow)
        for a in range(0, len(html), CHUNK):
            parser.feed(html[a : a + CHUNK])
        parser.finish()
        if not parser.retry or any(line[0] and line[3] for line in parser.lines):
            break
    return parser


def _around(cluster: np.ndarray, held: np.ndarray, block: np.ndarray, blocks: list[list]) -> np.ndarray:
    """The lines in the innermost block around all of ``cluster`` that can hold a whole text."""
    # A cell with blocks of its own is a column of the page.
    part = lambda k: blocks[k][0] in PARTS and not (blocks[k][0] in SPACED and blocks[k][2] > k)
    own = block[cluster]
    at, last = int(own.min()), int(own.max())
    while blocks[at][2] < last or part(at):
        at = blocks[at][1]
    inside = (block >= at) & (block <= blocks[at][2])
    if at and (held & inside).sum() == 1:
        # A block of one line is a part as well.
        at = blocks[at][1]
        while part(at):
            at = blocks[at][1]
        inside = (block >= at) & (block <= blocks[at][2])
    return inside


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """Blocks of the main text, joined by an empty line; empty if there is none."""
    page = parsed(html or "")
    lines = page.lines
    held = np.array([bool(line[0]) and line[3] for line in lines], bool)
    if not held.any():
        return ""
    region = np.array([line[2] for line in lines])
    inside = region > 0
    chars = np.array([len(line[0]) for line in lines])
    if page.parts:
        _take_back(held, region, chars, np.array([line[6] for line in lines]))
    if page.doubtful:
        level = np.array([page.doubtful.get(r, 0) for r in region.tolist()])
        size = chars * held
        of_level = np.bincount(level[inside], size[inside], int(level.max()) + 1)
        taken, least, text = [0], size[~inside].sum(), of_level[0]
        for k, more in enumerate(of_level[1:], 1):
            if more > (text or least):
                taken.append(k)
                text += more
        sure = inside & np.isin(level, taken)
        held, inside = held & (sure | ~inside), sure
    ratios = np.log1p(chars / np.maximum([line[1] for line in lines], 1)) * held
    smooth = smoothed(ratios, sigma)
    cluster = held & (smooth >= smooth.std())
    if not cluster.any():
        cluster = held
    within, beside = chars[cluster & inside].sum(), chars[cluster & ~inside].sum()
    if not (held & inside).any() or REGION_WEIGHT * within < beside:
        # The story isn't in an article, or isn't in those there are.
        held &= ~inside
        inside = _around(cluster & held, held, np.array([line[5] for line in lines]), page.blocks)
        # A heading just before the block belongs to it.
        before = np.flatnonzero(held[: np.flatnonzero(inside)[0]])
        if len(before) and lines[before[-1]][4]:
            inside[before[-1]] = True
    return "\n\n".join(lines[i][0] for i in np.flatnonzero(held & inside))


def _take_back(held: np.ndarray, region: np.ndarray, chars: np.ndarray, part: np.ndarray) -> None:
    """Holds the lines of parts that were dropped for their marks but have more text than the rest of their region."""
    kept = np.bincount(region, chars * held)
    dropped = np.bincount(part, chars * (part > 0))
    of = np.zeros(len(dropped), int)
    of[part] = region
    larger = dropped > kept[of]
    larger[0] = False
    held |= larger[part] & (chars > 0)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", sigma: float = SIGMA) -> DataFrame:
    """``pages`` with the main text of each whole page; a column of that name is replaced.

    Null and empty pages, and pages without content, give an empty text; text outside of
    any markup is content.  Repeated rows are alike.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(h, sigma) for h in pages], dtype=object)

    out = F.pandas_udf(run, "string")(col(html_col))
    kept = [col(c) for c in pages.columns if c.lower() != text_col.lower()]
    return pages.select(*kept, out.alias(text_col))
