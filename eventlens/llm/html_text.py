"""Main text of HTML pages from text-to-tag ratios.

The standard library's parser streams its events into blocks (the lines of the method). Each
block has a ratio of text to tags; the ratios are smoothed with a Gaussian over the page and split
into two clusters by an iterated threshold, and the upper one marks content. The content region are
the article elements, else the main element, that hold most of the marked text, else the smallest
container that holds all of it; headings right before it belong to it. The region's blocks are the
text: a short paragraph inside the article stays although its own ratio is low. Outside article
elements a block that is nothing but links goes if its own ratio is below the threshold. Elements whose tag or
role says that they are no content (menus, headers, footers, forms, ...) neither vote nor are
returned; nor are those named so by a whole class or id: reader comments never, the others (adverts,
sidebars, ...) unless they hold half of the marked text or more and no article element stands
elsewhere, or are a paragraph of the upper cluster with a name that often means something else.

Pages are independent: no shuffle, one page in memory at a time beside its Arrow batch.

Defined results: a null or blank html gives an empty text; a page whose text is all in one block
gives that block; broken markup is repaired the way browsers begin to (paragraphs close each
other, unknown end tags are dropped, a comment or tag that is never closed ends the page); a null id or URL is carried; repeated rows give repeated
rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import arrow_map

SIGMA = 1.5
REGION_SHARE = 0.3
BYLINES = 2
APART = 2.0
RESULT = "page_id bigint, url string, text string, n_chars bigint"

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(
    "script style head title noscript template iframe object svg canvas audio video".split())
NO_CONTENT = SILENT | frozenset(
    "nav header footer aside form button select textarea menu dialog".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("html body main article section div td center".split())
CLOSES_P = BLOCK - {"html", "body", "caption", "tbody", "thead", "tfoot", "tr", "td", "th"}
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu "
    "menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo "
    "cookie cookies consent gdpr notice notices notification disclaimer comment comments "
    "commentlist reply replies respond disqus sidebar menu navbar nav navigation breadcrumb "
    "breadcrumbs pagination footer masthead share sharing social related recommended newsletter "
    "subscribe subscription signup login popup modal overlay toolbar widget skip".split())
# What may stand before and after such a name: site-footer, comment-list; not no-sidebar, share-price.
BEFORE = frozenset("site main page global top bottom left right primary secondary reader user".split())
AFTER = frozenset("list item items box block area container wrapper wrap inner section bar link links "
                  "form text title slot unit left right top bottom main primary secondary".split())
COMMENTS = frozenset("comment comments commentlist reply replies respond disqus".split())
# These also name paragraphs of an article (a company's shares, a widget, a notice to readers).
OFTEN_TEXT = frozenset("share social related promo notice widget banner notification".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_WORDS = re.compile(r"[a-z]+")
_NAME = re.compile(r"[^\s]+")


def named(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """Why a whole class or id of the element names no content: comments, other, or often text."""
    found = ""
    if tag in ("html", "body", "article", "main"):
        return found
    names = [v for k, v in attrs if k in ("class", "id") and v]
    for name in _NAME.findall(" ".join(names).lower()):
        words = _WORDS.findall(name)
        while words and words[0] in BEFORE:
            del words[0]
        while words and words[-1] in AFTER:
            del words[-1]
        if words and all(w in NAMES for w in words):
            if not COMMENTS.isdisjoint(words):
                return "comments"
            found = "other" if found == "other" or not OFTEN_TEXT.issuperset(words) else "often text"
    return found


def no_content(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    if tag in NO_CONTENT:
        return not (tag == "header" and in_article)
    for key, value in attrs:
        value = (value or "").lower()
        if (key == "hidden" or key == "role" and value in ROLES
                or key == "aria-hidden" and value == "true"
                or key == "style" and "display:none" in value.replace(" ", "")):
            return True
    return tag == "article" and any(
        k in ("class", "id") and v and "comment" in v.lower() for k, v in attrs)


class Block(NamedTuple):
    text: str
    tags: int
    path: tuple[int, ...]  # numbers of the containers and named elements around it
    content: bool
    heading: bool
    links: int  # characters of the text that are inside links
    paragraph: bool


class Blocks(HTMLParser):
    """Collects a page's blocks in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, bool, int]] = []  # tag, excluded, number or 0
        self.text: list[str] = []
        self.links = 0
        self.tags = 0
        self.tag_of: dict[int, str] = {}
        self.named: dict[int, str] = {}

    def _excluded(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    def _end_block(self) -> None:
        if self.text and (text := " ".join("".join(self.text).split())):
            path = tuple(n for _, _, n in self.open if n)
            heading = any(t in HEADINGS for t, _, _ in self.open)
            paragraph = any(t == "p" for t, _, _ in self.open)
            self.blocks.append(Block(text, self.tags, path, not self._excluded(), heading, self.links, paragraph))
            self.tags = 0
        self.text, self.links = [], 0

    def _pop_to(self, depth: int) -> None:
        self._end_block()
        del self.open[depth:]

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            for depth in range(len(self.open) - 1, -1, -1):
                if self.open[depth][0] == "p":
                    self._pop_to(depth)
                    break
                if self.open[depth][0] in BLOCK:
                    break
        if tag == "li" or tag in ("dd", "dt", "option", "tr", "td", "th"):
            kin = {"dd", "dt"} if tag in ("dd", "dt") else {"td", "th"} if tag in ("td", "th") else {tag}
            for depth in range(len(self.open) - 1, -1, -1):
                if self.open[depth][0] in kin:
                    self._pop_to(depth)
                    break
                if self.open[depth][0] in ("ul", "ol", "dl", "table", "tr", "select", "article"):
                    break
        if tag in BLOCK:
            self._end_block()
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        in_article = any(t in ("article", "main") for t, _, _ in self.open)
        excluded = self._excluded() or no_content(tag, attrs, in_article)
        by_name = named(tag, attrs)
        if by_name or excluded and not self._excluded():
            self._end_block()
        number = 0
        if tag in CONTAINER or by_name:
            number = len(self.tag_of) + 1
            self.tag_of[number] = tag
            if by_name:
                self.named[number] = by_name
        self.open.append((tag, excluded, number))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        for depth in range(len(self.open) - 1, -1, -1):
            name, excluded, number = self.open[depth]
            if name == tag:
                if (tag in BLOCK or number in self.named
                        or excluded != (depth > 0 and self.open[depth - 1][1])):
                    self._pop_to(depth)
                else:
                    del self.open[depth]
                return
            if name in BLOCK and tag not in BLOCK:
                return  # an inline end tag does not close a block

    def handle_data(self, data):
        if not (self.open and self.open[-1][0] in SILENT):
            self.text.append(data)
            if any(t == "a" for t, _, _ in self.open):
                self.links += len("".join(data.split()))

    def finish(self) -> list[Block]:
        if re.match("<[A-Za-z/!?]", self.rawdata):  # never closed
            self.rawdata = ""
        self.close()
        self._end_block()
        return self.blocks


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; the page's ends weigh what is there."""
    radius = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    full = np.convolve(ratios, kernel)[radius:-radius]
    return full / np.convolve(np.ones(len(ratios)), kernel)[radius:-radius]


def threshold(values: np.ndarray) -> float:
    """The middle between the means of the two clusters it makes.

    Means less than ``APART`` times apart are one cluster, all above the threshold.
    """
    at = float(values.mean())
    for _ in range(64):
        low, high = values[values < at], values[values >= at]
        if not len(low) or not len(high):
            break
        moved = (float(low.mean()) + float(high.mean())) / 2
        if abs(moved - at) < 1e-9:
            break
        at = moved
    low, high = values[values < at], values[values >= at]
    one = not len(low) or not len(high) or low.mean() * APART > high.mean()
    return float(values.min()) if one else at


def _drops(parser: Blocks, number: int, blocks: list[Block], marked: list[Block]) -> bool:
    """Whether an element named as no content is none: the ratios or an article elsewhere agree."""
    if parser.named[number] == "comments":
        return True
    if parser.named[number] == "often text" and parser.tag_of[number] == "p":
        return not any(number in b.path for b in marked)
    inside = sum(len(b.text) for b in marked if number in b.path)
    if 2 * inside < sum(len(b.text) for b in marked):
        return True
    at = {n for n, tag in parser.tag_of.items() if tag in ("article", "main")}
    around = any(number in b.path and at.intersection(b.path[:b.path.index(number)]) for b in blocks)
    return not around and any(
        b.content and number not in b.path and at.intersection(b.path) for b in blocks)


def _region(parser: Blocks, content: list[Block], marked: list[Block]) -> set[int]:
    """Numbers of the elements whose blocks are the text; empty for the whole page."""
    total = sum(len(b.text) for b in marked)
    for tag in ("article", "main"):
        inside = [(b, [n for n in b.path if parser.tag_of[n] == tag][:1]) for b in marked]
        if sum(len(b.text) for b, n in inside if n) >= REGION_SHARE * total:
            return {n[0] for _, n in inside if n}
    path = list(marked[0].path)
    for b in marked[1:]:
        same = 0
        while same < min(len(path), len(b.path)) and path[same] == b.path[same]:
            same += 1
        del path[same:]
    # A container of one block is a cell or a quotation, and not what holds the page's text.
    while path and sum(path[-1] in b.path for b in content) < 2:
        path.pop()
    return {path[-1]} if path else set()


def _only_links(parser: Blocks, block: Block) -> bool:
    """Whether a block is nothing but links, and neither of an article nor a paragraph or heading."""
    return (block.links * 10 >= 9 * len("".join(block.text.split())) and not block.heading and not block.paragraph
            and not any(parser.tag_of[n] in ("article", "main") for n in block.path))


def _with_headings(content: list[Block], chosen: list[bool]) -> list[bool]:
    """Also what leads to a region: headings right before it, and one with a line or two in between
    that stands in a container around it."""
    if True not in chosen:
        return chosen
    first = chosen.index(True)
    for k in range(first - 1, max(-1, first - 2 - BYLINES), -1):
        if content[k].heading and all(
                set(b.path) <= set(content[first].path) for b in content[k:first]):
            chosen[k:first] = [True] * (first - k)
            break
    for k in range(len(content) - 2, -1, -1):
        chosen[k] |= chosen[k + 1] and content[k].heading
    return chosen


def main_text(html: str | None) -> str:
    parser = Blocks()
    parser.feed(html or "")
    blocks = parser.finish()
    if not any(b.content for b in blocks):
        return ""
    ratios = np.array([len(b.text) / max(1, b.tags) for b in blocks], float)
    values = smooth(ratios)
    at = min(threshold(values), max(v for b, v in zip(blocks, values, strict=True) if b.content))
    marked = [b for b, v in zip(blocks, values, strict=True) if b.content and v >= at]
    # Links beside long paragraphs are lifted by the smoothing, so their own ratio counts.
    bare = {id(b) for b, r in zip(blocks, ratios, strict=True) if r < at and _only_links(parser, b)}
    dropped = {n for n in parser.named if _drops(parser, n, blocks, marked)}
    content = [b for b in blocks if b.content and dropped.isdisjoint(b.path) and id(b) not in bare]
    marked = [b for b in marked if dropped.isdisjoint(b.path)] or content
    if len(content) < 2:
        return content[0].text if content else ""
    region = _region(parser, content, marked)
    chosen = [not region or not region.isdisjoint(b.path) for b in content]
    chosen = _with_headings(content, chosen)
    return " ".join(b.text for b, yes in zip(content, chosen, strict=True) if yes)


def _extract(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [main_text(x.as_py()) for x in batch.column(2)]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
         pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, the main text and its length in code points."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"),
                        F.col("url").cast("string").alias("url"), "html")
    return arrow_map(rows, _extract, RESULT)
