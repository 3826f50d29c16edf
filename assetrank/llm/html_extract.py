"""Main-text extraction from HTML by text-to-tag ratio.

The standard library's parser streams events. Block elements cut the page into
lines; each line has a text-to-tag ratio (characters outside links per tag).
The ratios are smoothed with a Gaussian over neighbouring lines, and lines above
the threshold (a share of the ratios' standard deviation) form the content
clusters. A cluster selects the region it lies in: the article and main elements
if it lies in one, else the element that directly holds the cluster's
lines. All lines of a selected region stay, whatever their length, except
those inside navigation, headers, footers, asides, forms, adverts, notices,
scripts, comments and the like. Outside articles a line that is mostly links, and is
neither a headline nor a paragraph, goes too.

Defined cases: null or empty html gives an empty text; broken or unclosed tags
are closed by their ancestors; text without any tag is one line; any ``<!..>`` that
is no comment is skipped to its ``>``, and an unclosed one or comment to the page's
end; a page of any length is read whole, in time proportional to it; duplicate rows
give duplicate results; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetrank.llm import tables

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
NEVER = frozenset(
    "head nav footer aside form script style noscript template iframe object svg canvas button select textarea option"
    " dialog audio video map".split()
)
LANDMARKS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Lines of these elements are text even where most of it is linked.
PROSE = HEADINGS | {"p"}
#: Words in class and id names. Furniture may wrap an article by name (``page with-sidebar``); the others may not.
FURNITURE = frozenset(
    "nav navbar navigation menu header masthead topbar footer sidebar rail breadcrumb breadcrumbs toolbar pagination pager".split()
)
UNWANTED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner popup modal overlay cookie cookies"
    " consent gdpr notice alert newsletter subscribe subscription signup login share sharing social related recommended"
    " comment comments commentlist reply replies discussion disqus widget hidden".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: An open element of these kinds ends when another of the same kind begins.
SELF_CLOSING = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: ... unless one of these stands between.
SCOPES = frozenset("ul ol dl table div section article main body html td th li aside nav header footer form blockquote".split())
#: Elements that can hold a content region.
HOLDERS = SCOPES - frozenset("ul ol li dl table blockquote".split())

_WORDS = re.compile(r"[a-z]+")
#: Searched from a comment's first two hyphens on, which may be the last two as well.
_COMMENT_END = re.compile(r"--!?>")

KEEP, FURNISHED, DROPPED = 0, 1, 2


class _Lines(HTMLParser):
    """Collects (text, tags, link characters, landmark, holder, block element) per line."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # open elements: (name, state, landmark, holder, block)
        self.open: list[tuple[str, int, int, int, str]] = []
        self.names: Counter[str] = Counter()
        self.count = 0
        self.links = 0
        self.lines: list[tuple[str, int, int, int, int, str]] = []
        self.buffer: list[str] = []
        self.tags = 0
        self.linked = 0

    # -- events
    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.buffer.append("\n")
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        if tag in VOID:
            return
        if tag in SELF_CLOSING:
            self.end_open(SELF_CLOSING[tag])
        elif tag in BLOCKS and self.names["p"]:
            self.end_open(("p",))
        state, landmark = (self.open[-1][1], self.open[-1][2]) if self.open else (KEEP, 0)
        own = self.state_of(tag, dict(attrs), landmark)
        if tag in LANDMARKS and state == FURNISHED:
            state = KEEP
        self.count += 1
        if tag in LANDMARKS and not landmark:
            landmark = self.count
        elif tag in HEADINGS and landmark and state == FURNISHED:
            own = state = KEEP  # a headline inside the article's own header
        holder, block = (self.open[-1][3], self.open[-1][4]) if self.open else (0, "")
        self.open.append((tag, max(state, own), landmark, self.count if tag in HOLDERS else holder, tag if tag in BLOCKS else block))
        self.names[tag] += 1
        self.links += tag == "a"

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if self.names[tag]:
            while self.pop() != tag:
                pass

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("script", "style"):
            return
        if tag in NEVER and tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if not self.open or self.open[-1][1] == KEEP:
            self.buffer.append(data)
            if self.links:
                self.linked += len(data)

    # -- state
    @staticmethod
    def state_of(tag: str, attrs: dict[str, str | None], landmark: int) -> int:
        if tag in NEVER:
            return DROPPED
        if tag == "header":
            return FURNISHED
        if tag in ("html", "body", "a", "p", "b", "i", "em", "strong", "span") and "class" not in attrs and "hidden" not in attrs and "style" not in attrs:
            return KEEP
        style = (attrs.get("style") or "").lower().replace(" ", "")
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
            return DROPPED
        if tag in ("html", "body"):
            return KEEP
        words = set(_WORDS.findall(f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower()))
        if words & UNWANTED:
            return DROPPED
        if words & FURNITURE and tag not in LANDMARKS or (attrs.get("role") or "").lower() in ROLES:
            return FURNISHED
        return KEEP

    def pop(self) -> str:
        tag = self.open.pop()[0]
        self.names[tag] -= 1
        self.links -= tag == "a"
        return tag

    def end_open(self, tags: tuple[str, ...]) -> None:
        """End the innermost open element of these kinds, if no scope stands above it."""
        if not any(self.names[t] for t in tags):
            return
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name in tags:
                while len(self.open) > k:
                    self.pop()
                return
            if name in SCOPES:
                return

    def flush(self) -> None:
        text = " ".join("".join(self.buffer).split())
        if text:
            _, _, landmark, holder, block = self.open[-1] if self.open else ("", KEEP, 0, 0, "")
            self.lines.append((text, self.tags, min(self.linked, len(text)), landmark, holder, block))
        self.buffer = []
        self.tags = self.linked = 0

    # -- declarations: the page is fed at once, so what has no end yet never gets one
    def parse_comment(self, i: int, report: bool = True) -> int:
        end = _COMMENT_END.search(self.rawdata, i + 2)
        return end.end() if end else len(self.rawdata)

    def parse_html_declaration(self, i: int) -> int:
        end = super().parse_html_declaration(i)
        return end if end >= 0 else len(self.rawdata)

    def parse_marked_section(self, i: int, report: bool = True) -> int:
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)


def text_to_tag_ratios(lines: list[tuple[str, int, int, int, int, str]]) -> np.ndarray:
    return np.array([(len(line[0]) - line[2]) / max(1, line[1]) for line in lines])


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian-weighted mean over neighbouring lines (edges use the lines there are)."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weight


def main_text(html: str | None, sigma: float = 1.0, threshold: float = 0.5) -> str:
    """The page's article: lines in page order, joined by an empty line."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = parser.lines
    if not lines:
        return ""
    ratios = text_to_tag_ratios(lines)
    smooth = smoothed(ratios, sigma)
    chosen = smooth >= threshold * ratios.std()
    if any(line[3] and chosen[k] for k, line in enumerate(lines)):
        # the page marks its articles: each stays, a short one as well
        kept = [line for line in lines if line[3]]
    else:
        # smoothing carries a cluster over its edge: a holder needs a dense line of its own,
        # or a place between lines that stay
        plain = [line[2] * 2 <= len(line[0]) for line in lines]
        holders = {line[4] for k, line in enumerate(lines) if chosen[k] and plain[k] and ratios[k] >= threshold * ratios.std()}
        # lists of links go, linked headlines and paragraphs don't
        text = [plain[k] or line[5] in PROSE for k, line in enumerate(lines)]
        stays = [k for k, line in enumerate(lines) if line[4] in holders and text[k]]
        first, last = (stays[0], stays[-1]) if stays else (0, -1)
        kept = [line for k, line in enumerate(lines) if line[4] in holders and text[k] or plain[k] and chosen[k] and first < k < last]
    return "\n\n".join(line[0] for line in kept)


def extract_pages(pages: DataFrame, sigma: float = 1.0, threshold: float = 0.5) -> DataFrame:
    """page_id, url, text of every row of ``pages`` (page_id, url, html)."""

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.each(batches):
            texts = pa.array([main_text(html.as_py(), sigma, threshold) for html in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["page_id", "url", "text"])

    tables.ship(pages.sparkSession)
    only = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return only.mapInArrow(extracted, "page_id long, url string, text string")
