"""Main-text extraction from HTML by text-to-tag ratio.

Each page goes once through the standard library's streaming HTML parser.  Its
events give lines: a line ends where a block element starts or ends, white
space inside a line (a ``br`` too) becomes one space.  Every line has a text-to-tag ratio.
The ratios are smoothed with a Gaussian kernel and split into two clusters by
an iterated threshold; the cluster above it is content.  Lines inside elements
that never hold the article (menus, headers, footers, asides, forms, adverts,
comments, scripts, styles) are no candidates.  ``article`` and ``main`` elements,
if the page has any with text, bound the content regions: every one that holds
lines of the content cluster is kept, without runs of link lines below the
threshold (unmarked menus).
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0               # lines; width of the Gaussian kernel
RADIUS = 2
LINK_SHARE = 0.9          # of the characters of a link line
LINK_RUN = 3              # link lines in a row that make a menu

# Elements of the HTML standard that start a new line.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr "
    "html legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is not part of an article's text.
DROPPED = frozenset(
    "aside button datalist dialog footer form head iframe input label math menu nav noscript "
    "object option script search select style svg template textarea title canvas audio "
    "video".split())
# A header inside an article is its title block; elsewhere it is page furniture.
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|"
    r"footer|masthead|menu|nav(?:bar|igation)?|newsletter|notices?|popup|promo\w*|related|"
    r"reader-comments|replies|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|"
    r"toolbar|widget)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu "
                  "menubar toolbar".split())
REGIONS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 title".split())
# Elements that an opening tag closes when it is left open.
CLOSES_P = BLOCKS - {"body", "html", "head", "caption", "td", "th", "tr", "tbody", "thead",
                     "tfoot", "option", "optgroup", "title", "legend", "summary", "figcaption",
                     "li", "dd", "dt"}
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
        "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SPACE = re.compile(r"\s+")


def _solid(text: str) -> int:
    """Characters that are not white space."""
    return len("".join(text.split()))


class Lines(HTMLParser):
    """Collects ``(text, tags, dropped, region, heading, link share)`` per line."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, bool, int, bool, float]] = []
        self.open: list[tuple[str, bool, int]] = []   # tag, dropped, region
        self.parts: list[str] = []
        self.links = 0                                # open links
        self.linked = 0                               # characters inside links
        self.tags = 0
        self.dropped = False
        self.region = 0
        self.regions = 0
        self.heading = False

    def flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            share = self.linked / _solid(text) if self.linked else 0.0
            self.lines.append((text, self.tags, self.dropped, self.region, self.heading, share))
            self.tags = 0
        self.parts, self.linked = [], 0

    def restore(self) -> None:
        if self.links:
            self.links = sum(tag == "a" for tag, *_ in self.open)
        _, self.dropped, self.region = self.open[-1] if self.open else ("", False, 0)

    def close_to(self, names) -> None:
        """Close the innermost open element of ``names`` and all inside it."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in names:
                self.flush()
                del self.open[i:]
                self.restore()
                return
            if self.open[i][0] in REGIONS or self.open[i][0] in ("table", "ul", "ol", "div", "section"):
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
            if tag in CLOSES_P:
                self.close_to(("p",))
        if tag in SAME:
            self.close_to(SAME[tag])
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        dropped = self.dropped or tag in DROPPED or (tag == "header" and not self.region)
        if attrs and not dropped and tag not in ("html", "body"):
            for name, value in attrs:
                if name in ("class", "id"):
                    dropped |= bool(value and FURNITURE.search(value)) and tag not in REGIONS
                elif name == "role":
                    dropped |= value in ROLES
                elif name == "hidden":
                    dropped = True
                elif name == "aria-hidden":
                    dropped |= value == "true"
                elif name == "style":
                    dropped |= bool(value) and "display:none" in value.replace(" ", "").lower()
        region = self.region
        if tag in REGIONS and not dropped and not region:
            self.regions += 1
            region = self.regions
        if dropped != self.dropped:                   # inline furniture cuts a line too
            self.flush()
        self.heading = tag in HEADINGS or (self.heading and tag not in BLOCKS)
        self.open.append((tag, dropped, region))
        self.links += tag == "a"
        self.dropped, self.region = dropped, region

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                if tag in BLOCKS or self.open[i][1] != (self.open[i - 1][1] if i else False):
                    self.flush()
                if tag in HEADINGS:
                    self.heading = False
                del self.open[i:]
                self.restore()
                return
            if tag not in REGIONS and self.open[i][0] in REGIONS:
                return                                # a stray end tag stays inside

    def handle_data(self, data):
        self.parts.append(data)
        if self.links:
            self.linked += _solid(data)

    def finish(self):
        self.close()
        self.flush()
        return self.lines


def smooth(ratio: np.ndarray, sigma: float = SIGMA, radius: int = RADIUS) -> np.ndarray:
    """Gaussian smoothing with renormalised edges."""
    kernel = np.array([math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-radius, radius + 1)])
    top = np.convolve(ratio, kernel, "full")[radius:radius + len(ratio)]
    low = np.convolve(np.ones(len(ratio)), kernel, "full")[radius:radius + len(ratio)]
    return top / low


def threshold(values: np.ndarray) -> float:
    """Two-cluster threshold on the line: the mean of the two cluster means."""
    low, high = float(values.min()), float(values.max())
    cut = (low + high) / 2
    for _ in range(100):
        above = values > cut
        if not above.any() or above.all():
            break
        new = (float(values[above].mean()) + float(values[~above].mean())) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def _menus(link: np.ndarray) -> np.ndarray:
    """Lines in runs of ``LINK_RUN`` or more link lines."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], link.astype(np.int8), [0]))))
    out = np.zeros(len(link), bool)
    for a, b in zip(edge[::2], edge[1::2]):
        out[a:b] = b - a >= LINK_RUN
    return out


def extract(html: str | None) -> str:
    """The article text of one page, blocks joined by an empty line; empty if
    there is none.

    Without an ``article`` or ``main`` element the region is found from the
    ratios alone: lines above the threshold, and lines between or next to
    them, up to the first and last line of the content cluster.  Of such elements
    all are kept that hold lines of the content cluster (all with text if none
    does); inside them a run of ``LINK_RUN`` or more link lines goes if all of
    it lies below the threshold, unless nothing else is there.
    """
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    lines = parser.finish()
    if not lines:
        return ""
    ratio = smooth(np.array([len(t) / max(k, 1) for t, k, *_ in lines], float))
    usable = np.array([not x[2] for x in lines])
    if not usable.any():
        return ""
    cut = threshold(ratio)
    content = usable & (ratio >= min(cut, float(ratio[usable].max())))
    region = np.array([r for *_, r, _, _ in lines])
    inside = usable & (region > 0)
    if inside.any():
        kept = np.unique(region[inside & content])
        chosen = inside & np.isin(region, kept) if len(kept) else inside
        menu = _menus(chosen & ~content & (np.array([x[-1] for x in lines]) >= LINK_SHARE))
        if (chosen & ~menu).any():
            chosen &= ~menu
    else:
        at = np.flatnonzero(content)
        first, last = int(at[0]), int(at[-1])
        while first > 0 and usable[first - 1] and lines[first - 1][4]:
            first -= 1                                # headings right above the region
        chosen = usable.copy()
        chosen[:first] = False
        chosen[last + 1:] = False
    return "\n\n".join(lines[i][0] for i in np.flatnonzero(chosen))


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` per page row.

    Null or empty html gives an empty text.  One narrow pass; pages stream
    through Arrow batches one at a time, without a limit on their length.
    """
    def run(batches):
        for batch in batches:
            texts = [extract(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"),
                          F.col("url").cast("string").alias("url"),
                          F.col(html).cast("string").alias("html"))
    return narrow.mapInArrow(run, "page_id long, url string, text string, n_chars long")
