"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering (Weninger et al. 2010).

The standard library's parser streams events over the whole page. A line is the text between two block boundaries. Elements that never hold
article text (menus, forms, scripts and the like, by tag or role) are left out with all they contain; open elements
that the page forgot to close are closed by the rules of ``CLOSED_BY`` and by their parents' end. What a class or id calls so is left out as well,
however long it is. It is spared only where the page's article elements all stand inside such names, or where nothing else is left; comments
never are. A name that merely mentions such a word lowers the score of its lines.

Each line has a ratio: characters of text outside links, over tags seen in it. The ratios are smoothed along the page by a Gaussian kernel,
and the threshold that parts content from the rest lies between the two means of a clustering of the logarithms of smoothed ratios.
A line's score is that logarithm, raised by ``MARKED`` inside an explicit article element, lowered by ``UNMARKED`` outside where a page has
one, and by ``NAMED`` inside an element whose name mentions a word of the kind above. The regions over the threshold are content on every page, with the headings right before them.

Pages are independent: one pass, no shuffle, one page in memory at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Fixed values of the HTML standard: elements without an end tag, elements that break lines, and what a start tag closes.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noframes ol option optgroup p pre search section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
CLOSED_BY = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
#: Elements that these stand in close no farther than this.
SCOPE = {"ul", "ol", "dl", "table", "select", "menu"}

# Elements that never hold article text.
DROPPED = set(
    "script style noscript template head title nav footer aside form button select option textarea input label fieldset iframe object "
    "embed svg math canvas video audio map dialog menu".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert toolbar".split())
#: Words of class and id names that mark something else than the article.
DROPPED_WORDS = set(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored promo promotion banner nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs sidebar aside rail footer masthead topbar toolbar comment comments disqus reply replies respond "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations widget widgets pagination pager search form tags tagcloud copyright legal".split()
)
#: A class or id that begins with one of these stands for the article whatever else it says.
KEPT_NAMES = re.compile(r"^(article|post|entry|story|main)[-_]?(body|content|text|inner)?$")
ARTICLE = {"article", "main"}

RADIUS, SIGMA = 2, 1.0
#: What an article element adds to a line's score, and a name that mentions a dropped word takes off, in logarithms of the ratio.
MARKED, NAMED = 2.0, 1.0
#: What the lines outside lose on a page that marks an article; and characters per tag over which a line is no more of an article than others.
UNMARKED, FULL = 1.5, 60.0
#: Words of names that mark readers' own words, which are no article even where a page has nothing else.
COMMENTS = set("comment comments disqus reply replies respond".split())
#: Before a word these say what the rest of the page has, not what the element is.
ABOUT_PAGE = set("with has no without".split())
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Line:
    text: str
    ratio: float
    linked: float  # share of characters inside links
    in_article: bool
    heading: bool
    named: bool = False  # inside an element whose name mentions a dropped word


@dataclass
class _Open:
    tag: str
    dropped: bool
    article: bool
    cut: bool = False
    named: bool = False


def is_dropped(tag: str, attrs: list[tuple[str, str | None]], inside_article: bool) -> bool:
    """Whether an element is outside the article by its tag, role or visibility. A page header is dropped, an article's is kept."""
    if tag in DROPPED or (tag == "header" and not inside_article):
        return True
    if not attrs or tag in ("html", "body"):
        return False
    given = dict(attrs)
    if (given.get("role") or "").lower() in DROPPED_ROLES or "hidden" in given or given.get("aria-hidden") == "true":
        return True
    if "display:none" in (given.get("style") or "").replace(" ", "").lower():
        return True
    return False


def named(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[str, bool]:
    """The dropped word that a class or id is or ends with ('' for none; a word of comments goes first), and whether one mentions such
    a word. Never so for what marks the article."""
    if not attrs or tag in ("html", "body") or tag in ARTICLE:
        return "", False
    given = dict(attrs)
    names = f"{given.get('class') or ''} {given.get('id') or ''}".split()
    if not names or any(KEPT_NAMES.match(n.lower()) for n in names):
        return "", False
    parts = [[w.lower() for w in _PARTS.findall(n)] for n in names]
    ends = [p[-1] for p in parts if p and p[-1] in DROPPED_WORDS and not (len(p) > 1 and p[-2] in ABOUT_PAGE)]
    return next((w for w in ends if w in COMMENTS), ends[0] if ends else ""), any(w in DROPPED_WORDS for p in parts for w in p)


def marks_article(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    given = dict(attrs)
    return tag in ARTICLE or any(KEPT_NAMES.match(n.lower()) for n in f"{given.get('class') or ''} {given.get('id') or ''}".split())


@dataclass
class Lines(HTMLParser):
    """Lines of a page from the parser's events."""

    lines: list[Line] = field(default_factory=list)

    def __post_init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[_Open] = []
        self.dropped = self.articles = self.links = self.named = 0
        self.cuts: list[int] = []  # open elements that their names cut
        self.words: list[str] = []  # the word in the name of each of these elements
        self.marks: list[tuple[int, ...]] = []  # the elements of that kind around each element that marks an article
        self.parts: list[tuple[str, tuple[int, ...], bool]] = []
        self.raw: list[tuple[list, int, bool, bool, bool]] = []
        self.tags = 0
        self.was_heading = False

    def _break(self) -> None:
        if self.parts:
            self.raw.append((self.parts, self.tags, self.articles > 0, self.was_heading, self.named > 0))
        self.parts, self.tags, self.was_heading = [], 0, False

    def _pop(self) -> None:
        was = self.stack.pop()
        self.dropped -= was.dropped
        self.articles -= was.article
        self.links -= was.tag == "a"
        self.named -= was.named
        if was.cut:
            self.cuts.pop()

    def handle_starttag(self, tag, attrs):
        if tag in CLOSED_BY:
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k].tag in SCOPE and not (self.stack[k].tag == "table" and tag == "tr"):
                    break
                if self.stack[k].tag in CLOSED_BY[tag]:
                    while len(self.stack) > k:
                        self._pop()
        if tag == "a" and self.links:  # links do not nest
            self.handle_endtag("a")
        if tag in BLOCK:
            self._break()
        self.tags += 1
        if tag in VOID:
            return
        drop = is_dropped(tag, attrs, self.articles > 0)
        word, mentions = named(tag, attrs)
        opened = _Open(tag, drop, tag in ARTICLE and not self.dropped, bool(word), mentions)
        if not self.dropped and marks_article(tag, attrs):
            self.marks.append(tuple(self.cuts))
        self.stack.append(opened)
        self.dropped += opened.dropped
        self.articles += opened.article
        self.links += tag == "a"
        self.named += mentions
        if word:
            self.cuts.append(len(self.words))
            self.words.append(word)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash does not close an HTML element

    def handle_endtag(self, tag):
        if tag == "br" or tag in BLOCK:
            self._break()
        self.tags += 1
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k].tag == tag:
                while len(self.stack) > k:
                    self._pop()
                return
            if tag not in BLOCK and self.stack[k].tag in BLOCK:
                return  # an inline end tag does not reach out of its block

    def handle_data(self, data):
        if self.dropped:
            return
        self.parts.append((data, tuple(self.cuts), self.links > 0))
        if self.stack and self.stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.was_heading = True

    def close(self):
        super().close()
        self._break()
        named, comments = set(range(len(self.words))), {k for k, w in enumerate(self.words) if w in COMMENTS}
        around = set() if any(not m for m in self.marks) else {k for m in self.marks for k in m}
        self.lines = self._without(named - (around - comments)) or self._without(comments)

    def _without(self, gone: set[int]) -> list[Line]:
        lines = []
        for parts, tags, in_article, heading, is_named in self.raw:
            kept = [(data, linked) for data, cuts, linked in parts if gone.isdisjoint(cuts)]
            text = _SPACE.sub(" ", "".join(data for data, _ in kept)).strip()
            if text:
                linked = sum(len(data.strip()) for data, is_link in kept if is_link)
                lines.append(Line(text, max(len(text) - linked, 0) / max(tags, 1), linked / len(text), in_article, heading, is_named))
        return lines


def smoothed(ratios: np.ndarray, radius: int = RADIUS, sigma: float = SIGMA) -> np.ndarray:
    """A Gaussian-weighted mean over neighbouring lines; at the ends over those that exist."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    total = np.convolve(ratios, kernel, "full")[radius : radius + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), kernel, "full")[radius : radius + len(ratios)]


def threshold(scores: np.ndarray) -> float:
    """The point half-way between the means of the two clusters of the scores, found by Lloyd's steps.

    A score of 0 takes part, that of a line of nothing but links: most of these are left out before, and without it pages of nothing but
    their article would be parted into long and short paragraphs.
    """
    scores = np.append(scores, 0.0)
    low, high = scores.min(), scores.max()
    if low == high:
        return -np.inf
    for _ in range(50):
        mid = (low + high) / 2
        new = scores[scores <= mid].mean(), scores[scores > mid].mean()
        if new == (low, high):
            break
        low, high = new
    return float((low + high) / 2)


def content(lines: list[Line]) -> list[str]:
    """The texts of the lines that belong to the article."""
    if not lines:
        return []
    marked = np.array([x.in_article for x in lines])
    ratios = np.log1p(smoothed(np.minimum([x.ratio for x in lines], FULL)))
    scores = np.where(marked, np.minimum(ratios + MARKED, np.log1p(FULL)), ratios - UNMARKED * marked.any())
    scores = scores - NAMED * np.array([x.named for x in lines])
    own = marked | (np.array([x.linked for x in lines]) < 0.5)
    keep = (scores > threshold(scores)) & own
    for k in range(len(lines) - 2, -1, -1):
        if lines[k].heading and keep[k + 1] and own[k] and marked[k] == marked[k + 1]:
            keep[k] = True
    return [x.text for x, use in zip(lines, keep) if use]


def main_text(html: str | None) -> str:
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    return " ".join(content(parser.lines))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) per row; null and empty pages, and pages without an article, give the empty text.

    Keys and urls are passed on as they are, null included; repeated rows give repeated results. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [main_text(x.as_py()) for x in b.column("h")]
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), b.column("u"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                [key, url, "text", "n_chars"],
            )

    rows = pages.select(F.col(key).cast("long").alias("k"), F.col(url).alias("u"), F.col(html).alias("h"))
    return rows.mapInArrow(run, f"`{key}` long, `{url}` string, text string, n_chars long")


def op9_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))


QUERIES = {"op9_extraction": op9_extraction}
#: SQL has no HTML parser; the query is tested on pages with a known article.
ORACLES: dict[str, str] = {}
