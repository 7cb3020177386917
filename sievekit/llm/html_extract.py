"""Main-text extraction from HTML by text-to-tag ratios.

The standard-library parser streams a page's events. Block-level tags cut the
page into lines; a line has its text and the number of tags met since the line
before, hence a text-to-tag ratio. The ratios are smoothed with a Gaussian and
clustered by a threshold (a share of their standard deviation); runs above it
are content. Content lines vote for the element that holds them: the
``article``/``main`` elements, or else the smallest element with nearly all
content text. Every line of that element is kept, so short lines between long
ones survive, except lines inside menus, headers and footers of the page,
sidebars, notices, adverts, forms, scripts, styles and reader comments.

Null, empty or text-free pages give an empty text. Character references are
decoded; white space inside a block becomes one space; blocks are trimmed and
joined by two line feeds. Broken markup never fails a row. Every input row
gives one output row; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element names and the words that mark boilerplate in
# class, id and role attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split())
SPACING = frozenset("br td th".split())
CLOSES_P = BLOCK - frozenset("body html".split())
SKIP_TAG = frozenset(
    "aside audio button canvas dialog footer form head iframe input menu nav noembed noframes "
    "noscript object option script search select style svg template textarea title video".split())
SKIP_WORD = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising advertorial aside banner breadcrumb "
    "breadcrumbs comment comments commentlist consent cookie cookies disclaimer discussion disqus footer "
    "gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain "
    "pager pagination popup promo promos promotion recommended related replies reply respond share sharing "
    "sidebar sidebars signup skip social sponsor sponsored subscribe taboola teaser toolbar widget "
    "widgets".split())
SKIP_ROLE = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
                      "search toolbar".split())
NAMED = ("class", "id", "role", "hidden", "aria-hidden", "style")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class PageLines(HTMLParser):
    """Collects (text, tags, skipped, holder) lines; ``holder`` is the innermost
    open block element (0: none) and ``parent`` gives the block element around
    each, so a page costs time and memory in proportion to its size, however
    deep it nests."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, bool, int]] = []
        self.parent = [0]                               # by element id; block elements only
        self.blocks = [0]                               # open block elements
        self.count: Counter[str] = Counter()            # open elements by tag
        self.barred = 0                                 # open boilerplate other than forms
        self.open: list[tuple[str, int, bool, bool]] = []   # tag, element id, skipped, itself boilerplate
        self.primary: set[int] = set()                  # article and main elements
        self.inside_primary = 0
        self._text: list[str] = []
        self._tags = 0
        self._next = 0

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        self._text.clear()
        if text:
            skipped = bool(self.open) and self.open[-1][2]
            self.lines.append((text, self._tags, skipped, self.blocks[-1]))
            self._tags = 0

    def _boilerplate(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in SKIP_TAG or tag == "header" and not self.inside_primary:
            return True
        for name, value in attrs:
            if name not in NAMED or tag in ("html", "body"):
                continue
            value = value or ""
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name == "style":
                if HIDDEN.search(value):
                    return True
            elif name == "role":
                if value.lower() in SKIP_ROLE:
                    return True
            elif tag == "main":
                continue
            else:
                for token in value.split():
                    found = [w.lower() for w in WORDS.findall(token)]
                    # "has-sidebar", "with-ads", "no-comments" describe the element's surroundings
                    if found and found[0] not in ("has", "with", "no") and not SKIP_WORD.isdisjoint(found):
                        return True
                    if "header" in found and not self.inside_primary and tag not in ("h1", "h2", "h3"):
                        return True
        return False

    def _close(self, at: int) -> None:
        self._flush()
        while len(self.open) > at:
            self._drop(len(self.open) - 1)

    def _drop(self, at: int) -> None:
        tag, element, _, own = self.open.pop(at)
        self.count[tag] -= 1
        self.barred -= own and tag != "form"
        self.inside_primary -= element in self.primary
        if tag in BLOCK:
            self.blocks.pop()

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            if tag in CLOSES_P:
                for i in range(len(self.open) - 1, -1, -1):
                    name = self.open[i][0]
                    if name == "p" or tag == name == "li":
                        self._close(i)
                        break
                    if name in BLOCK:
                        break
            self._flush()
        elif tag in SPACING:
            self._text.append(" ")
        self._tags += 1
        if tag in VOID:
            return
        outer = bool(self.open) and self.open[-1][2]
        if outer and tag in ("article", "main") and not self.barred:
            outer = False           # a form around the whole page, not in it
        own = self._boilerplate(tag, attrs)
        skipped = outer or own
        if skipped and not outer:
            self._flush()
        self._next += 1
        self.open.append((tag, self._next, skipped, own))
        self.count[tag] += 1
        self.barred += own and tag != "form"
        self.parent.append(self.blocks[-1])
        if tag in BLOCK:
            self.blocks.append(self._next)
        if tag in ("article", "main"):
            self.primary.add(self._next)
            self.inside_primary += 1

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag not in BLOCK:
            if tag in BLOCK:
                self._flush()
            elif tag in SPACING:
                self._text.append(" ")
            self._tags += 1
        else:                       # browsers ignore the slash
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self._tags += 1
        if tag in BLOCK:
            self._flush()
        elif tag in SPACING:
            self._text.append(" ")
        if not self.count[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            name, _, skipped, _ = self.open[i]
            if name == tag:
                if skipped:
                    self._flush()
                if tag in BLOCK or skipped:
                    self._close(i)
                else:               # an inline end tag leaves blocks opened after it alone
                    self._drop(i)
                return

    def handle_data(self, data):
        self._text.append(data)

    def finish(self) -> None:
        self.close()
        self._flush()


def smoothed(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing with the kernel renormalised at the ends."""
    radius = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[radius:radius + len(ratios)]
    return np.convolve(ratios, kernel)[radius:radius + len(ratios)] / weight


def content_lines(lengths, tags, sigma: float = 1.0, share: float = 0.5) -> np.ndarray:
    """True for lines whose smoothed ratio reaches ``share`` standard
    deviations of the page's smoothed ratios."""
    ratio = smoothed(np.asarray(lengths, float) / np.maximum(1, np.asarray(tags, float)), sigma)
    return ratio >= share * ratio.std()


def page_lines(html: str) -> PageLines:
    page = PageLines()
    try:
        page.feed(html)
        page.finish()
    except (AssertionError, ValueError):    # a malformed declaration: read it as text
        page = PageLines()
        page.feed(html.replace("<!", "&lt;!"))
        page.finish()
    return page


def main_text(html: str | None, sigma: float = 1.0, share: float = 0.5, cover: float = 0.9) -> str:
    """Main text of one page."""
    if not html:
        return ""
    page = page_lines(html)
    lines = page.lines
    usable = [i for i, (_, _, skipped, _) in enumerate(lines) if not skipped]
    if not usable:
        return ""
    content = content_lines([0 if s else len(t) for t, _, s, _ in lines], [n for _, n, _, _ in lines],
                            sigma, share)
    own = [0] * len(page.parent)            # votes by element, then summed from the innermost out
    held = bytearray(len(page.parent))      # holds a usable line
    total = 0
    for i in usable:
        held[lines[i][3]] = 1
        if content[i]:
            total += len(lines[i][0])
            own[lines[i][3]] += len(lines[i][0])
    for e in range(len(own) - 1, 0, -1):
        own[page.parent[e]] += own[e]
        held[page.parent[e]] |= held[e]
    chosen = {e for e in page.primary if own[e]}
    if not chosen:
        chosen = {e for e in page.primary if held[e]}
    if not chosen and total:
        # the innermost element that holds nearly all content text
        best = max((e for e in range(1, len(own)) if own[e] >= cover * total), default=0)
        chosen = {best} if best else set()
    inside = bytearray(len(page.parent))    # in a chosen element
    for e in range(1, len(inside)):
        inside[e] = e in chosen or inside[page.parent[e]]
    keep = [lines[i][0] for i in usable if not chosen or inside[lines[i][3]]]
    return "\n\n".join(keep)


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text",
            sigma: float = 1.0, share: float = 0.5) -> DataFrame:
    """The input rows without ``html_col``, with ``out_col``. A column that
    already has the name ``out_col`` is replaced."""
    keep = [c for c in pages.columns if c not in (html_col, out_col)]
    src = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)],
                       F.col(f"`{html_col}`").alias("html"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields[:-1])

    def run(batches):
        for batch in batches:
            text = [main_text(h, sigma, share) for h in batch.column("html").to_pylist()]
            cols = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(text, pa.string())],
                                             [*batch.schema.names[:-1], "text"])

    out = src.mapInArrow(run, (schema + ", " if schema else "") + "text string")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("text").alias(out_col))
