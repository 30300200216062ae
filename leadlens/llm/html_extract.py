"""Main text of web pages (operator 2).

The standard library's HTML parser streams start tags, end tags and text.  Each block
element gives one line; its text-to-tag ratio is the number of its characters over its
tags.  The ratios are smoothed with a Gaussian, two clusters are formed on the smoothed
values, and the upper one marks content lines.  The content region is the ``article`` or
``main`` around the deepest element that holds ``REGION_SHARE`` of the characters in content
lines; on pages without one, the deepest element that holds all content lines, so sections
side by side stay together.  Sections, articles and divisions of one class beside the region belong to
it.  Every line of the region is the article, so a short paragraph between long ones stays.  Menus, headers, footers,
side bars, notices, adverts, forms and reader comments are known by element, role, class
or id, inside an article by a whole name only; they count as lines for the ratios but are never
part of the article.  An inline end tag closes no block.

Runs as a vectorised UDF on one column: one page at a time, no shuffle, memory bounded by
one Arrow batch.

Cases: a null or empty page and a page without text give an empty text; unclosed and
stray tags follow the usual implied ends; repeated rows are extracted row by row; all
other columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.llm.common import table

SIGMA = 1.0
REGION_SHARE = 0.7

# HTML's element groups.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre "
                   "section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title svg iframe object canvas audio video "
                   "textarea select option button annotation annotation-xml".split())
ASIDE = frozenset("nav footer aside form menu dialog".split())
CLOSES_P = BLOCKS - {"body", "html"}
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}
REGIONS = frozenset("html body div section td center blockquote".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu "
                  "menubar toolbar".split())
NAMES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
                  "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
                  "signup sidebar sidebars widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs "
                  "header masthead footer comment comments discussion disqus replies respond share sharing social "
                  "related recommended recommendations copyright legal login search toolbar pagination pager".split())
COMMENTS = frozenset(("comment", "comments", "reply", "replies"))
#: inside an article a name counts as a whole: all its parts but the fillers, and these never
FILLERS = frozenset("area bar block box button buttons container count form icons inner items link links list outer "
                    "panel posts section slot stories unit wrap wrapper".split())
OWN_NAMES = frozenset("header masthead legal copyright login search".split())
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
WHITE = re.compile(r"\s+")


def _is_named(tag: str, value: str, in_article: bool) -> bool:
    """Whether a class or id names something that is not the article's."""
    if tag in ("body", "html", "main"):
        return False
    for name in value.split():
        parts = {x.lower() for x in NAME_PART.findall(name)}
        if tag == "article":
            if parts & COMMENTS:
                return True
        elif not in_article:
            if parts & NAMES:
                return True
        elif parts - FILLERS and parts - FILLERS <= NAMES - OWN_NAMES:
            return True
    return False


def _is_aside(tag: str, attrs: list, in_article: bool) -> bool:
    if tag in ASIDE or tag == "header" and not in_article:
        return True
    for key, value in attrs:
        value = value or ""
        if (key == "hidden" or key == "aria-hidden" and value == "true"
                or key == "style" and "display:none" in value.replace(" ", "").lower()
                or key == "role" and value.lower() in ROLES
                or key in ("class", "id") and _is_named(tag, value, in_article)):
            return True
    return False


class PageLines(HTMLParser):
    """Collects lines: (element, characters, tags, aside, text).

    Elements are numbered in page order, so an element's descendants are the numbers
    from its own to its ``last``.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.last, self.tag_of, self.class_of = [-1], [0], ["html"], [""]
        self.stack = [(0, "", False, False, False)]  # element, tag, aside, silent, in an article
        self.open = Counter()
        self.lines: list[tuple[int, int, int, bool, str]] = []
        self.text: list[str] = []
        self.tags = 0

    def flush(self) -> None:
        if self.text:
            line = WHITE.sub(" ", "".join(self.text)).strip()
            self.text.clear()
            if line:
                element, _, aside, _, _ = self.stack[-1]
                self.lines.append((element, len(line), max(1, self.tags), aside, line))
                self.tags = 0

    def _pop(self) -> None:
        element, tag = self.stack.pop()[:2]
        self.open[tag] -= 1
        self.last[element] = len(self.parent) - 1

    def _close(self, tags: tuple, until: tuple) -> None:
        """Implied end of the nearest open element among ``tags`` that no ``until`` hides."""
        if any(self.open[t] for t in tags):
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k][1] in tags:
                    while len(self.stack) > k:
                        self._pop()
                    return
                if self.stack[k][1] in until:
                    return

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            elif tag == "hr":
                self.flush()
            return
        if tag in BLOCKS:
            self.flush()
            if tag in CLOSES_P:
                self._close(("p",), ("td", "th", "table", "button"))
            if tag in SIBLINGS:
                self._close(SIBLINGS[tag], ("ul", "ol", "dl", "table"))
        if self.open["head"] and tag == "body":
            self._close(("head",), ())
        _, _, aside, silent, article = self.stack[-1]
        self.parent.append(self.stack[-1][0])
        self.last.append(len(self.parent) - 1)
        self.tag_of.append(tag)
        self.class_of.append(next((v or "" for k, v in attrs if k == "class"), ""))
        self.stack.append((len(self.parent) - 1, tag, aside or _is_aside(tag, attrs, article),
                           silent or tag in SILENT, article or tag in ("article", "main")))
        self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def _spans_blocks(self, tag: str) -> bool:
        """Whether an inline end tag would close blocks and its element hid nothing."""
        k, blocks = len(self.stack) - 1, False
        while self.stack[k][1] != tag:
            blocks |= self.stack[k][1] in BLOCKS
            k -= 1
        return blocks and self.stack[k][2:4] == self.stack[k - 1][2:4]

    def handle_endtag(self, tag):
        self.tags += 1
        if not self.open[tag]:
            if tag in BLOCKS:
                self.flush()
            return
        if tag in BLOCKS:
            self.flush()
        elif self._spans_blocks(tag):
            return
        while self.stack[-1][1] != tag:
            if self.stack[-1][1] in BLOCKS:
                self.flush()
            self._pop()
        self._pop()

    def handle_data(self, data):
        if not self.stack[-1][3]:
            self.text.append(data)

    def finish(self) -> None:
        self.close()
        self.flush()
        while len(self.stack) > 1:
            self._pop()
        self.last[0] = len(self.parent) - 1


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; weights at the ends are made to sum to one."""
    r = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    full = np.convolve(ratio, kernel)[r:r + len(ratio)]
    return full / np.convolve(np.ones(len(ratio)), kernel)[r:r + len(ratio)]


def split_point(values: np.ndarray) -> float:
    """Threshold between two clusters (one-dimensional 2-means from the extremes)."""
    low, high = float(values.min()), float(values.max())
    for _ in range(20):
        cut = (low + high) / 2
        upper = values >= cut
        if upper.all():
            return cut
        new = float(values[~upper].mean()), float(values[upper].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def _marked(page: PageLines, region: int) -> int | None:
    """The outermost article (else main) around an element."""
    up = [region]
    while up[-1]:
        up.append(page.parent[up[-1]])
    for tag in ("article", "main"):
        if marked := [k for k in up if page.tag_of[k] == tag]:
            return marked[-1]
    return None


def _widened(page: PageLines, region: int) -> int:
    """From a paragraph to the element whose children are the article's blocks."""
    while region and page.tag_of[region] not in REGIONS:
        region = page.parent[region]
    inner = {page.tag_of[k] for k in range(region + 1, page.last[region] + 1)}
    if region and not inner & BLOCKS and page.tag_of[page.parent[region]] in REGIONS - {"body", "html"}:
        region = page.parent[region]
    return region


def _alike(page: PageLines, region: int) -> list[int]:
    """The region with the sections, articles or, of one class, divisions like it beside it:
    of a section in which it lies, if it has such."""
    like: dict[tuple, list[int]] = {}
    for x in range(1, len(page.parent)):
        like.setdefault((page.parent[x], page.tag_of[x], page.class_of[x]), []).append(x)
    k = region
    while k:
        tag, name = page.tag_of[k], page.class_of[k]
        beside = like[page.parent[k], tag, name]
        if len(beside) > 1 and (tag in ("section", "article") or tag == "div" and name):
            return beside
        if tag in ("body", "article", "main"):
            break
        k = page.parent[k]
    return [region]


def main_text(html: str | None) -> tuple[str, int, int]:
    """The article's text, its lines and the page's lines."""
    page = PageLines()
    page.feed(html or "")
    page.finish()
    lines = page.lines
    if not any(not x[3] for x in lines):
        return "", 0, len(lines)
    score = smoothed(np.array([x[1] / x[2] for x in lines], dtype=float))
    cut = split_point(score)
    own = [x for x, s in zip(lines, score) if s >= cut and not x[3]] or [x for x in lines if not x[3]]
    mass = [0] * len(page.parent)
    for element, n, *_ in own:
        mass[element] += n
    total = sum(mass)
    for k in range(len(mass) - 1, 0, -1):
        mass[page.parent[k]] += mass[k]
    # elements are in page order: the last one with the share is the deepest
    region = _marked(page, max(k for k, m in enumerate(mass) if m >= REGION_SHARE * total))
    if region is None:
        region = _widened(page, max(k for k, m in enumerate(mass) if m == total))
    regions = _alike(page, region)
    texts = [x[4] for x in lines if not x[3] and any(k <= x[0] <= page.last[k] for k in regions)]
    return "\n\n".join(texts), len(texts), len(lines)


_RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_blocks", T.IntegerType()),
                        T.StructField("n_lines", T.IntegerType())])


@F.pandas_udf(_RESULT)
def _extract(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([main_text(x) for x in html], columns=["text", "n_blocks", "n_lines"])


def extracted(html: Column | str) -> Column:
    """Struct (text, n_blocks, n_lines) of a page."""
    return _extract(F.col(html) if isinstance(html, str) else html)


def extract_pages(pages: DataFrame, html: str = "html", into: str = "main") -> DataFrame:
    """``pages`` with a struct column ``into``, in place of one of that name; the others are untouched."""
    return pages.withColumn(into, extracted(html))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return p.select("page_id", "url", F.col("main.text").alias("text"),
                    F.length("main.text").cast("long").alias("n_chars"),
                    F.col("main.n_blocks").alias("n_blocks"), F.col("main.n_lines").alias("n_lines"))


QUERIES = {"op2_html_extract": op2_html_extract}
