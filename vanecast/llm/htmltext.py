"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing, clustering.

The streaming parser of the standard library turns a page into *lines*: the text of one
block element each, with its number of characters, of tags and of characters inside links.
A line's text-to-tag ratio is smoothed over its neighbours with a Gaussian kernel; lines
whose smoothed ratio reaches a threshold (a share of the page's standard deviation) form the
content cluster, wherever on the page they stand.  An outermost article or main keeps its
lines from the first to the last of the cluster, and the others of a region (article or main)
that holds some of the cluster unless they are mostly links; lines outside all regions stay
from the first to the last of the cluster there, but for lists of links.  So short paragraphs
and headings between long ones are not lost.  Where no region holds any of the cluster, the
regions are kept as well.  Elements that are boilerplate by their name, role or class never
become lines.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: elements of HTML by what they do to text
SKIPPED = frozenset(
    "script style noscript template head nav header footer aside form button select textarea iframe object svg canvas "
    "dialog menu audio video map".split()
)
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption address details summary hr center fieldset legend hgroup search".split()
)
REGIONS = frozenset("article main".split())
# whatever else starts ends an open head
IN_HEAD = frozenset("head base basefont bgsound link meta title noscript noframes style script template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# an open element of the key ends where one of the values starts
ENDED_BY = {
    "p": BLOCKS,
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr"}),
    "td": frozenset({"td", "th", "tr"}),
    "th": frozenset({"td", "th", "tr"}),
}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
# words of class and id attributes that mark boilerplate
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar topbar masthead header footer sidebar "
    "aside widget related recommended share sharing social newsletter subscribe signup login cookie cookies consent "
    "gdpr notice notices alert popup modal overlay comment comments respond disqus replies reply discussion".split()
)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _boilerplate(tag: str, attrs: list) -> bool:
    if tag in SKIPPED:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    for name, value in attrs:
        if name in ("class", "id") and value:
            if not MARKS.isdisjoint(_WORD.findall(_CAMEL.sub(" ", value).lower())):
                return True
        elif name == "role" and value and value.strip().lower() in ROLES:
            return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
    return False


class _Lines(HTMLParser):
    """Collects (text, tags, linked characters, region, outermost region) per block element, in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, int]] = []
        self.open: list[tuple[str, int, int]] = []  # tag, region and skip depth before it
        self.outer = [0]  # of every region, the outermost one around it
        self.parts: list[str] = []
        self.tags = self.linked = self.region = self.regions = self.skip = self.links = 0

    def cut(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append((text, self.tags, self.linked, self.region, self.outer[self.region]))
                self.tags = self.linked = 0
            self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD and any(x[0] == "head" for x in self.open if tag == "body" or x is self.open[-1]):
            while self._close() != "head":
                pass
        while self.open and tag in ENDED_BY.get(self.open[-1][0], ()):
            self._close()
        if tag in BLOCKS or tag in SKIPPED:
            self.cut()
        self.tags += 1
        if tag in VOID:
            if tag == "br" and not self.skip:
                self.parts.append(" ")
            return
        self.open.append((tag, self.region, self.skip))
        if self.skip or (attrs or tag in SKIPPED) and _boilerplate(tag, attrs):
            self.skip += 1
        elif tag in REGIONS:
            self.regions += 1
            self.outer.append(self.outer[self.region] or self.regions)
            self.region = self.regions
        if tag == "a":
            self.links += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not any(tag == x[0] for x in self.open):
            if tag in BLOCKS:
                self.cut()
            return
        # a skipped element is closed only by its own end tag, not by a stray one further out
        while self.open and self.open[-1][0] != tag:
            self._close()
        self._close()

    def _close(self) -> str:
        tag, region, skip = self.open.pop()
        if tag in BLOCKS or tag in SKIPPED:
            self.cut()
        if tag == "a":
            self.links = max(0, self.links - 1)
        self.region, self.skip = region, skip
        return tag

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)

    def close(self):
        super().close()
        self.cut()


def parse_lines(html: str) -> list[tuple[str, int, int, int, int]]:
    parser = _Lines()
    parser.feed(html)
    parser.close()
    return parser.lines


def smooth(ratios: np.ndarray, radius: int = 2) -> np.ndarray:
    """Gaussian smoothing with sigma = radius / 2; the kernel is renormalised at the ends."""
    offsets = np.arange(-radius, radius + 1)
    kernel = np.exp(-0.5 * (offsets / (radius / 2)) ** 2)
    padded = np.pad(ratios, radius)
    weight = np.convolve(np.pad(np.ones(len(ratios)), radius), kernel, "valid")
    return np.convolve(padded, kernel, "valid") / weight


def main_text(html: str | None, radius: int = 2, share: float = 0.5) -> str:
    """Main text of one page; empty if there is none."""
    lines = parse_lines(html) if html else []
    if not lines:
        return ""
    size = np.array([len(x[0]) for x in lines], float)
    tags = np.array([x[1] for x in lines], float)
    linked = np.minimum(np.array([x[2] for x in lines], float), size)
    region, outer = np.array([x[3:5] for x in lines]).T
    ratio = smooth((size - linked) / np.maximum(tags, 1), radius)
    inside, prose = outer > 0, linked < 0.5 * size
    cluster = (ratio >= min(share * ratio.std(), ratio.max())) & np.where(inside, linked < size, prose)
    # from the first to the last line of the cluster, in every outermost region and outside of all
    at = np.arange(len(lines))
    first, last = np.full(outer.max() + 1, len(lines)), np.full(outer.max() + 1, -1)
    np.minimum.at(first, outer[cluster], at[cluster])
    np.maximum.at(last, outer[cluster], at[cluster])
    span = (first[outer] <= at) & (at <= last[outer])
    held = np.isin(region, region[cluster & inside])
    keep = np.where(inside, span | (held & prose), span & prose)
    if not (cluster & inside).any():  # no long line in any region: what they hold still is the article
        keep |= inside
    if not keep.any():
        keep = linked < size
    return "\n".join(x[0] for x, k in zip(lines, keep, strict=True) if k)


def extract_text(
    pages: DataFrame, html_column: str = "html", id_columns: tuple[str, ...] = ("page_id", "url"), radius: int = 2, share: float = 0.5
) -> DataFrame:
    """``id_columns`` and ``text`` of every page, read from its whole html.

    Character references are decoded, white space inside a block becomes one space, blocks
    are trimmed and joined in page order by one line feed.  A missing or empty html, or one
    without content, gives an empty text.  Repeated rows stay repeated; missing ids stay
    missing; columns other than the named ones are not read.
    """
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in id_columns) + ", text string"

    def run(batches):
        for batch in batches:
            html = batch.column(len(id_columns))
            text = pa.array([main_text(x.as_py(), radius, share) for x in html], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(id_columns)], text], names=[*id_columns, "text"])

    return pages.select(*[F.col(f"`{c}`") for c in id_columns], F.col(f"`{html_column}`").alias("__html")).mapInArrow(run, schema)
