"""Main text of web pages.

A streaming pass over the standard library's parser events cuts a page into lines (its
blocks), each with its text length and the tags met in it. Text-to-tag ratios of the
lines are smoothed with a Gaussian, and lines above the threshold (the standard deviation
of the smoothed ratios) are clustered as content. The region that holds most clustered
text is the article: an ``article`` or ``main`` element if the page has one, or else the
smallest element that holds most of it. All its lines are kept, whatever their own ratio;
parts that are never article text (menus, headers and footers of the page, sidebars,
notices, adverts, forms, scripts, styles, reader comments) are left out as the events
stream by. An element that is so named and yet holds the page's text (a wrapper as
``content has-sidebar``) is not left out: one that holds more article text than is read without it,
all text of the page, or, named by a part of a class name only, most of it. The page is then
read again with that element in.

Defined results: a null or empty page, or one without text, gives the empty text. Markup
left open or closed twice is read as browsers do. Rows repeat as given, other columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img svg math".split())
NEVER = frozenset("script style noscript template head title nav aside form button select textarea option iframe object "
                  "canvas svg menu dialog".split())
PAGE_EDGE = frozenset("header footer".split())
ARTICLE = frozenset("article main".split())
# Words of class, id and role attributes that name parts beside the article.
BESIDE = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar "
                   "navigation menu breadcrumb breadcrumbs sidebar aside footer cookie cookies consent notice notices "
                   "alert popup modal overlay newsletter subscribe signup share sharing social related recommended "
                   "comment comments disqus reply replies complementary contentinfo search login widget".split())
# First words of names that tell what an element has or lacks, not what it is.
OF_WRAPPERS = frozenset("has with no without".split())
CLOSES_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                 "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUNDS = frozenset("ul ol dl table article main section div body".split())
IN, BY_NAME, BY_TAG = 0, 1, 2
SIGMA = 1.0
MOST = 0.6
LINKED = 0.7


@dataclass
class Beside:
    """An element named as a part beside the article."""

    whole: bool  # by a whole class name
    inside: bool  # inside an article
    chars: int = 0
    in_article: int = 0


class Lines(HTMLParser):
    """Parser events to lines: text, tags met, linked characters, and the elements around."""

    def __init__(self, kept: frozenset[int] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int]] = []  # name, serial number, left out (by attributes or by tag)
        self.kept = kept  # elements not left out for their attributes
        self.beside: dict[int, Beside] = {}
        self.chars = self.plain = 0
        self.serial = 0
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.lines: list[tuple[str, int, int, tuple[int, ...]]] = []
        self.kinds: dict[int, str] = {}
        self.around: tuple[int, ...] = ()

    def _left_out(self) -> bool:
        return bool(self.open) and self.open[-1][2] != IN

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.linked, self.around))
            self.tags = self.linked = 0
        self.parts = []

    def _part(self, tag: str, attributes: list[tuple[str, str | None]]) -> int:
        """Whether the element is left out, and the reason."""
        around = self.open[-1][2] if self.open else IN
        if around == BY_TAG or tag in NEVER:
            return BY_TAG
        inside = any(name in ARTICLE for name, _, _ in self.open)
        if tag in PAGE_EDGE:
            return around if inside else BY_TAG
        if tag in ("html", "body", *ARTICLE):
            return around
        for name, value in attributes:
            if value and name in ("class", "id", "role"):
                names = [n for n in value.lower().replace("_", "-").split() if n.split("-")[0] not in OF_WRAPPERS]
                if not BESIDE.isdisjoint(" ".join(names).replace("-", " ").split()):
                    if self.serial in self.kept:
                        continue
                    self.beside[self.serial] = Beside(not BESIDE.isdisjoint(names), inside)
                    around = BY_NAME
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                return BY_TAG
        return around

    def _pop(self, count: int) -> None:
        del self.open[len(self.open) - count :]
        self.around = tuple(number for _, number, _ in self.open)

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self._end_line()
        self.tags += 1
        if tag in VOID:
            return
        if tag in CLOSES_ITSELF or tag not in INLINE:
            ending = CLOSES_ITSELF.get(tag, {"p"})
            for back, (name, _, _) in enumerate(reversed(self.open), 1):
                if name in ending:
                    self._pop(back)
                    break
                if name in BOUNDS:
                    break
        self.serial += 1
        self.open.append((tag, self.serial, self._part(tag, attributes)))
        if tag not in INLINE:
            self.kinds[self.serial] = tag
        self.around += (self.serial,)

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attributes)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._end_line()
        self.tags += 1
        for back, (name, _, _) in enumerate(reversed(self.open), 1):
            if name == tag:
                self._pop(back)
                return
            if name in ARTICLE and tag not in ("body", "html", *ARTICLE):
                return

    def handle_data(self, data: str) -> None:
        if not self.open or self.open[-1][2] != BY_TAG:
            self._weigh(len(data.strip()))
        if not self._left_out():
            self.parts.append(data)
            if self.open and any(name == "a" for name, _, _ in self.open[-3:]):
                self.linked += len(data.strip())

    def _weigh(self, size: int) -> None:
        self.chars += size
        article = False
        for name, number, _ in reversed(self.open):
            article |= name in ARTICLE
            if number in self.beside:
                self.beside[number].chars += size
                self.beside[number].in_article += size * article
        self.plain += size * (not self._left_out())

    def wrappers(self) -> frozenset[int]:
        """Elements not to be left out; more by the largest that is and yet holds the page's text."""
        found = {e: b.chars for e, b in self.beside.items() if b.chars and (
            b.chars == self.chars or not b.whole and b.chars >= MOST * self.chars
            or not b.inside and b.in_article > self.plain)}
        return self.kept | {e for e, chars in found.items() if chars == max(found.values())}

    def close(self) -> None:
        super().close()
        self._end_line()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = np.arange(-2, 3)
    kernel = np.exp(-(reach**2) / (2 * sigma**2))
    ends = np.convolve(np.ones(len(ratios)), kernel, "full")[2:-2]
    return np.convolve(ratios, kernel, "full")[2:-2] / ends


def content_lines(lines: list[tuple[str, int, int, tuple[int, ...]]]) -> np.ndarray:
    """The lines of the content cluster by smoothed text-to-tag ratio."""
    ratios = np.array([len(text) / max(1, tags) for text, tags, _, _ in lines])
    smooth = smoothed(ratios)
    return smooth >= min(smooth.std(), smooth.max())


def _parsed(html: str, kept: frozenset[int] = frozenset()) -> Lines:
    parser = Lines(kept)
    parser.feed(html)
    parser.close()
    return parser


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = _parsed(html)
    while (kept := parser.wrappers()) != parser.kept:
        parser = _parsed(html, kept)
    lines = parser.lines
    if not lines:
        return ""
    content = content_lines(lines)
    mass: dict[int, int] = {}
    for (text, _, linked, around), chosen in zip(lines, content, strict=True):
        if chosen:
            for element in around:
                if element in parser.kinds:
                    mass[element] = mass.get(element, 0) + len(text) - linked
    marked = {e: m for e, m in mass.items() if parser.kinds[e] in ARTICLE}
    if marked:
        region = max(marked, key=lambda e: (marked[e], -e))
    elif mass:
        whole = max(mass.values())
        blocks = [e for e, m in mass.items() if m >= MOST * whole and parser.kinds[e] in BOUNDS]
        region = max(blocks, default=0)
    else:
        region = 0
    return "\n".join(text for text, _, linked, around in lines
                     if (not region or region in around) and (marked or linked < LINKED * len(text)))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``text`` and ``n_chars``."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h) for h in batch], dtype=object)

    return pages.withColumn("text", extracted(F.col(html))).withColumn("n_chars", F.length("text").cast("long"))
