"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing and clustering.

The standard library's parser streams a page's events. Block elements and line breaks end a
line; each line has its characters, its tags and the container it lies in. The ratio of text to
tags per line is smoothed with a Gaussian, and lines at or above the smoothed ratios' standard deviation
are content. Content lines of one container form a cluster, with the lower lines between and beside them as long as these are
few; clusters that hold a fair share of the largest one's characters are the content regions, and
lines outside them, or mostly made of links, are left out. ``article`` and ``main`` are read as one
region with all that they hold if any of their lines is content; where a page has them, the rest is left out.

Elements that say what they are never count: menus, headers, footers, asides, forms, scripts and styles, and
containers whose class, id or role is a name of adverts, notices, menus or reader comments. A name
counts whole: ``comment-list`` is one, ``related-work`` is not. Headings, paragraphs and inline elements are
judged by their lines, whatever they are called.

Work is page by page inside a task and linear in the page; memory follows the longest page.

Defined results. Null or empty html: empty text. White space inside a block becomes one space;
blocks are joined by one line feed in page order. Unclosed and crossed tags, cut-off pages and broken
references are read as the parser reads them. Rows are independent; other columns are kept by ``extract``,
where an input column of an output's name is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from spendlever.llm.stages import without

#: Standard deviation, in lines, of the smoothing kernel.
SIGMA = 1.5
#: A region holds at least this share of the largest region's content characters.
SHARE = 0.25
#: So many lower lines between content lines of a container don't end its region.
GAP = 3

# Element names by their role.
SILENT = frozenset("script style noscript template iframe object svg canvas audio video head title select option datalist textarea button".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split())
CONTAINERS = frozenset("html body div section article main td th aside nav header footer form".split())
WHOLE = frozenset("article main".split())
# Words of class, id and role that name a part which is not the article.
NAMED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead toolbar "
    "comment comments commentlist disqus reply replies respond widget skip hidden contentinfo complementary search".split())
# Words that may stand beside them in such a name.
BESIDE = frozenset(
    "area articles bar block bottom box button buttons center col column container content form group inner item items left link links "
    "list main message news outer page panel posts right row section sections site slot stories text top unit wrap wrapper".split())
NAMEABLE = frozenset("div section ul ol dl table aside nav header footer form".split())
_WORDS = re.compile(r"[a-z]+")


def _telling(value: str) -> bool:
    """Whether a class, id or role names a part that is not the article."""
    for token in value.lower().split():
        words = _WORDS.findall(token)
        if not NAMED.isdisjoint(words) and all(w in NAMED or w in BESIDE for w in words):
            return True
    return False


class _Lines(HTMLParser):
    """Lines of a page: text, number of tags, characters of links, container."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = [("", 0, False)]  # name, container, left out
        self.total: Counter[str] = Counter()  # open elements by name
        self.inside: list[Counter[str]] = [Counter()]  # those since each open container began
        self.containers, self.whole = 1, {}
        self.lines: list[tuple[str, int, int, int]] = []
        self.parts: list[str] = []
        self.tags = self.linked = self.in_link = 0

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers of the source aren't asked for

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.linked, self.open[-1][1]))
            self.tags = 0
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
        if tag in VOID:
            return
        if tag == "p":
            self.close("p")
        _, container, out = self.open[-1]
        if tag in WHOLE and out and not self.total["aside"]:
            out = False
        if not out and (tag in SILENT or tag in BOILERPLATE):
            out = True
        elif not out and tag not in ("html", "body", *WHOLE):
            for name, value in attrs:
                if name == "hidden" or (tag in NAMEABLE and name in ("class", "id", "role") and value and _telling(value)):
                    out = True
        if tag in CONTAINERS and not self.whole.get(container):
            container = self.containers
            self.containers += 1
            self.whole[container] = tag in WHOLE
        if tag == "a":
            self.in_link += 1
        self.total[tag] += 1
        self.inside[-1][tag] += 1
        if tag in CONTAINERS:
            self.inside.append(Counter())
        self.open.append((tag, container, out))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in SILENT:
            self.handle_endtag(tag)

    def close(self, tag: str | None = None) -> None:
        """End an element and what is open inside it; each element is taken off once, so this is linear in all."""
        if tag is None:  # the page ends
            super().close()
            self.end_line()
            return
        # An inline element or paragraph doesn't close what holds it.
        if not (self.total if tag in CONTAINERS or tag in SILENT else self.inside[-1])[tag]:
            return
        if tag in BLOCKS:
            self.end_line()
        while True:
            name = self.open.pop()[0]
            if name in CONTAINERS:
                self.inside.pop()
            self.total[name] -= 1
            self.inside[-1][name] -= 1
            if name == tag:
                return

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in ("br", "p"):
            self.end_line()
        if tag == "a" and self.in_link:
            self.in_link -= 1
        self.close(tag)

    def handle_data(self, data: str) -> None:
        if self.open[-1][2]:
            return
        self.parts.append(data)
        if self.in_link:
            self.linked += len(data)


def _smoothed(ratio: np.ndarray) -> np.ndarray:
    reach = int(np.ceil(2 * SIGMA))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel)[reach:reach + len(ratio)]
    return np.convolve(ratio, kernel)[reach:reach + len(ratio)] / weight


def _clusters(content: np.ndarray, container: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """Number of the cluster of every line, -1 outside of all.

    A cluster holds content lines of one container with the lower ones between, before and after them, as long as
    no more than ``GAP`` lines in a row are lower: a headline or a short last line goes with its text. Lines
    that are not ``plain`` (mostly links) belong to no cluster and end it.
    """
    out = np.full(len(content), -1)
    made = 0
    for own in np.split(np.argsort(container, kind="stable"), np.flatnonzero(np.diff(np.sort(container))) + 1):
        high = np.flatnonzero(content[own])
        if not len(high):
            continue
        barrier = np.cumsum(~plain[own])
        fresh = np.concatenate(([True], (np.diff(high) > GAP + 1) | (np.diff(barrier[high]) > 0)))
        number = made + np.cumsum(fresh) - 1
        made = int(number[-1]) + 1
        after = np.clip(np.searchsorted(high, np.arange(len(own))), 0, len(high) - 1)
        before = np.clip(after - 1, 0, None)
        for near in (before, after):  # of two clusters in reach the later one
            reach = (np.abs(high[near] - np.arange(len(own))) <= GAP) & (barrier[high[near]] == barrier)
            out[own[reach]] = number[near[reach]]
    return np.where(plain, out, -1)


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    if not page.lines:
        return ""
    chars = np.array([len(text) for text, _, _, _ in page.lines], float)
    tags = np.array([n for _, n, _, _ in page.lines], float)
    plain = chars - np.minimum(chars, [n for _, _, n, _ in page.lines])
    container = np.array([c for _, _, _, c in page.lines])
    smooth = _smoothed(plain / np.maximum(tags, 1))
    content = smooth >= smooth.std()
    whole = np.array([bool(page.whole.get(c)) for c in container.tolist()])
    if whole.any():
        kept = whole
        if (content & whole).any():
            weight = np.bincount(container, weights=plain * content * whole)
            kept = whole & (weight >= max(SHARE * weight.max(), 1e-9))[container]
    else:
        text = plain > 0.4 * chars
        content &= text
        cluster = _clusters(content, container, text)
        weight = np.bincount(cluster + 1, weights=plain * content, minlength=1)[1:]
        regions = weight >= max(SHARE * weight.max(initial=0), 1e-9)
        kept = (cluster >= 0) & np.append(regions, False)[cluster]
        if not kept.any():  # no line stands out
            kept = text
    return "\n".join(page.lines[i][0] for i in np.flatnonzero(kept).tolist())


def extract(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html_col`` and its length in code points (``n_chars``)."""
    pages = without(pages, name, "n_chars")
    place = pages.columns.index(html_col)
    schema = T.StructType([*pages.schema.fields, T.StructField(name, T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=schema.names)

    return pages.mapInArrow(run, schema)


def texts_of(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    return extract(pages.select(F.col("page_id").cast("bigint"), "url", "html")).drop("html")
