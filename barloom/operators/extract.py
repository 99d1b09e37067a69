"""One rule-driven extraction job over a table of stored pages.

A rule names the part of the page to look at, the repeated block inside it and one expression
per output column. Pages are independent rows, so the job scales with the page table and has no
shuffle: a source with a third of all pages is just more rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import any_date
from ..functions.nesting import elements
from ..functions.numbers import ascii_digits, first_int, strict_number, trim
from ..functions.text import absolute_link, cell_text, clean_many, squeeze, squeeze_ascii, strip_tags
from ..functions.titles import holding_parts


def start(name: str, cls: str | None = None) -> str:
    """Pattern of a start tag, if wanted of a class (a whole class token)."""
    token = f"\\bclass=[\"'](?:[^\"']*\\s)?{cls}(?:\\s[^\"']*)?[\"'][^>]*" if cls else ""
    return f"<{name}\\b[^>]*{token}>"


def tag(name: str, cls: str | None = None, exact: bool = False) -> str:
    """Pattern of an element, its content in group 1."""
    return f"(?is){f'<{name}>' if exact else start(name, cls)}(.*?)</{name}>"


def attribute(name: str, attr: str, value: str = "[^\"']+") -> str:
    """Pattern of a start tag with an attribute, its value in group 1."""
    return f"(?is)<{name}\\b[^>]*\\b{attr}=[\"']({value})[\"'][^>]*>"


def first(s: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, '' when there is none."""
    return F.coalesce(F.regexp_extract(s, pattern, group), F.lit(""))


def every(s: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(s, F.lit(pattern), F.lit(group))


def at(cells: Column, k: int) -> Column:
    """k-th cell from 0, '' when there are fewer."""
    return F.coalesce(F.get(cells, F.lit(k)), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """``scope`` patterns narrow the page one after the other (group 1 of the first match, or with
    ``every_scope`` of every match of the first pattern); ``block`` is the repeated part.
    ``cells`` cuts each block into the array ``_td`` once, for all columns made from cells (with ``classed_cells`` group 1 is the class and
    ``_td`` holds struct(cls, html)). ``texts``
    are columns that still need tags removed and references decoded, done for all of them together.
    ``keep`` filters before that decoding, so that it runs once and only on rows that stay; it
    sees a text as ``_raw_<name>``. ``prefer`` names a part of the scope (group 1) that is looked at alone where there is one: its first
    match, or with ``prefer_every`` all of them. Blocks that match ``skip`` are left out. ``nested`` names the element (and class token) that
    ``block`` cuts: where a block holds another start tag of that name, the page's blocks are cut by the nesting of the tags instead.
    ``cut`` makes the blocks of a page in its own way.
    """

    name: str
    block: str
    columns: dict[str, Callable[[Column], Column]]
    scope: tuple[str, ...] = ()
    every_scope: bool = False
    block_group: int = 1
    keep: str = "true"
    first_block_only: bool = False
    cells: str | None = None
    classed_cells: bool = False
    texts: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    prefer: str | None = None
    prefer_every: bool = False
    skip: str | None = None
    nested: tuple[str, str | None] | None = None
    cut: Callable[[Column], Column] | None = None


def extract(pages: DataFrame, rule: Rule, html: str = "html") -> DataFrame:
    """Rows of every page with the page's other columns and ``row``, the position on the page.

    The page text itself is dropped as soon as its blocks are cut out, so the later stages carry
    blocks only. Blocks are numbered across all scopes of a page.

    Patterns use the dot in its match-everything mode: the regex engine walks it several times faster
    than a union of character classes, and without the threads getting in each other's way.
    """
    others = [c for c in pages.columns if c != html]
    cut = pages.select(*others, F.posexplode(_blocks(F.col(html), rule)).alias("row", "_block"))
    return _columns(cut, others, rule)


def extract_all(pages: DataFrame, rules: tuple[Rule, ...], html: str = "html") -> DataFrame:
    """Rows of several rules of equal columns and without ``cells``, with the rule's name as ``source``: pages are read and cut once.

    The blocks of all rules leave the page together; the rule of a block then picks its expressions.
    """
    others = [c for c in pages.columns if c != html]

    def numbered(k: int) -> Column:
        return F.transform(_blocks(F.col(html), rules[k]), lambda b, i: F.struct(F.lit(k).alias("k"), i.alias("row"), b.alias("b")))

    tagged = [numbered(k) for k in range(len(rules))]
    cut = pages.select(*others, F.explode(F.concat(*tagged)).alias("_z")).select(*others, "_z.k", "_z.row", F.col("_z.b").alias("_block"))
    block, names = F.col("_block"), sorted({*rules[0].columns, *rules[0].texts})

    def raw(rule: Rule) -> Column:
        made = {n: rule.columns[n](block) if n in rule.columns else trim(strip_tags(rule.texts[n](block))) for n in names}
        return F.struct(*[c.alias(n) for n, c in made.items()])

    picked = reduce(lambda e, kr: F.when(F.col("k") == kr[0], raw(kr[1])).otherwise(e), enumerate(rules), F.lit(None))
    rows = cut.select(*others, "k", "row", picked.alias("_v")).select(*others, "k", "row", "_v.*")
    kept = [f"(k = {k} AND {r.keep.replace('_raw_', '')})" for k, r in enumerate(rules)]
    rows = _only(rows, " OR ".join(kept))
    decoded = sorted({n for r in rules for n in r.texts})
    done = rows.withColumn("_texts", clean_many([F.col(n) for n in decoded]))
    by_text = {
        n: F.when(F.col("k").isin([k for k, r in enumerate(rules) if n in r.texts]), at(F.col("_texts"), decoded.index(n))).otherwise(F.col(n))
        for n in decoded
    }
    source = F.element_at(F.array(*[F.lit(r.name) for r in rules]), F.col("k") + 1)
    return done.select(*others, "row", *[by_text.get(n, F.col(n)).alias(n) for n in names], source.alias("source"))


def _blocks(text: Column, rule: Rule) -> Column:
    if rule.cut:
        return rule.cut(text)

    def cut(s: Column) -> Column:
        if rule.prefer:
            parts = every(s, rule.prefer)
            parts = parts if rule.prefer_every else F.slice(parts, 1, 1)
            s = F.when(F.size(parts) > 0, F.array_join(parts, "\n")).otherwise(s)
        found = every(s, rule.block, rule.block_group)
        if rule.nested:
            found = _by_nesting(s, found, *rule.nested, outer=rule.block_group == 0)
        return F.filter(found, lambda b: ~b.rlike(rule.skip)) if rule.skip else found

    if rule.every_scope:
        scopes = every(text, rule.scope[0])
        blocks = F.flatten(F.transform(scopes, lambda s: cut(_narrow(s, rule.scope[1:]))))
    else:
        blocks = cut(_narrow(text, rule.scope))
    return F.slice(blocks, 1, 1) if rule.first_block_only else blocks


def _by_nesting(page: Column, found: Column, name: str, cls: str | None, outer: bool) -> Column:
    """The blocks as found by the pattern if none of them holds an inner start tag of its element; else the elements by their nesting.

    Only pages that need it reach the parser.
    """
    own = 1 if outer else 0
    inner = F.exists(found, lambda b: F.regexp_count(b, F.lit(rf"(?i)<{name}\b")) > own)
    return F.when(inner, elements(F.when(inner, page), name, cls, outer)).otherwise(found)


def _only(rows: DataFrame, keep: str) -> DataFrame:
    """Rows that pass ``keep``, each of its columns made once.

    A plain filter would move below the projection that makes the columns, and all their patterns would run a second time in it.
    """
    return rows.select("*", F.explode(F.when(F.expr(keep), F.array(F.lit(True)))).alias("_kept")).drop("_kept")


def _columns(cut: DataFrame, others: list[str], rule: Rule) -> DataFrame:
    if rule.cells:
        cut = cut.withColumn("_td", _cell_array(F.col("_block"), rule))
    block = F.col("_block")
    made = {name: make(block) for name, make in rule.columns.items()}
    out = cut.select(*others, "row", *[c.alias(n) for n, c in made.items()], *_raw_texts(rule, block))
    out = out if rule.keep == "true" else _only(out, rule.keep)
    if rule.texts:
        done = clean_many([F.col(f"_raw_{n}") for n in rule.texts])
        out = out.select(*others, "row", *made, done.alias("_texts"))
        out = out.select(*others, "row", *made, *[at(F.col("_texts"), k).alias(n) for k, n in enumerate(rule.texts)])
    return out


def _cell_array(block: Column, rule: Rule) -> Column:
    if not rule.classed_cells:
        return every(block, rule.cells)
    whole = every(block, rule.cells, 0)
    cls = F.transform(every(block, rule.cells, 1), F.lower)
    return F.arrays_zip(cls.alias("cls"), whole.alias("html"))


def _raw_texts(rule: Rule, block: Column) -> list[Column]:
    return [trim(strip_tags(make(block))).alias(f"_raw_{n}") for n, make in rule.texts.items()]


def _narrow(s: Column, patterns: tuple[str, ...]) -> Column:
    for p in patterns:
        s = first(s, p)
    return s


# Element and class names of the page formats the job reads.
PRICE_TODAY_TABLE = r'(?is)<table[^>]*class="stock_kabuka0[^"]*"[^>]*>(.*?)</table>'
PRICE_HISTORY_TABLE = r'(?is)<table[^>]*class="stock_kabuka_dwm[^"]*"[^>]*>(.*?)</table>'
LIST_TABLE = r'(?is)<table[^>]*class="[^"]*\bstock_table\b[^"]*\bst_market\b[^"]*"[^>]*>(.*?)</table>'
NOTICE_TABLE = r'(?is)<table[^>]*class="[^"]*\bstock_table\b[^"]*"[^>]*>(.*?)</table>'
TBODY = r"(?is)<tbody[^>]*>(.*?)</tbody>"
TR, TD, TH = (rf"(?is)<{t}\b[^>]*>(.*?)</{t}>" for t in ("tr", "td", "th"))
TIME_ATTRIBUTE = r'(?i)<time[^>]*datetime="([^"]+)"'
TIME_TEXT = r"(?is)<time[^>]*>(.*?)</time>"
ANCHOR = r"(?is)<a\b[^>]*>(.*?)</a>"
HREF = r"(?i)<a\b[^>]*\bhref=[\"']([^\"']+)[\"']"
HEADER_BLOCK = r'(?is)<div\s+class="meigara_count">(.*?)</div>'
COUNT_UNIT = "銘柄"
LEFT, CENTRED, WRAPPED = "tal", "tac", "wsnormal"
CODE_ATTRIBUTE = "data-code"
HEADLINE_BOX, HEADLINE, HEADLINE_DATE, HEADLINE_TITLE, HEADLINE_FLAG = "news_box", "news", "date", "title", "diffflag"

#: A link: its target in group 1, its text in group 2.
LINK = attribute("a", "href") + "(.*?)</a>"


def _tds(row: Column) -> Column:
    return F.transform(F.col("_td"), lambda c: squeeze(strip_tags(c)))


def _price_date(row: Column) -> Column:
    stamp = F.regexp_extract(row, TIME_ATTRIBUTE, 1)
    return any_date(F.when(stamp != "", stamp).otherwise(cell_text(first(row, TH))))


def _price_cell(k: int) -> Callable[[Column], Column]:
    return lambda row: strict_number(ascii_digits(cell_text(at(F.col("_td"), k))))


_PRICE_COLUMNS = {
    "asof_date": _price_date,
    "open": _price_cell(0),
    "high": _price_cell(1),
    "low": _price_cell(2),
    "close": _price_cell(3),
    "volume": _price_cell(6),
    "_cells": lambda row: F.size("_td"),
}

PRICE_TODAY = Rule(
    "price_today", TR, _PRICE_COLUMNS, (PRICE_TODAY_TABLE, TBODY), keep="asof_date IS NOT NULL AND _cells >= 7",
    first_block_only=True, cells=TD,
)
PRICE_HISTORY = Rule(
    "price_history", TR, _PRICE_COLUMNS, (PRICE_HISTORY_TABLE, TBODY), keep="asof_date IS NOT NULL AND _cells >= 7",
    cells=TD,
)


def price_rows(pages: DataFrame) -> DataFrame:
    """Bars of price pages in reading order: today's row (``part`` 0) before the history (``part`` 1)."""
    others = [c for c in pages.columns if c != "html"]
    html = F.col("html")

    def tagged(rule: Rule, part: int) -> Column:
        return F.transform(_blocks(html, rule), lambda b: F.struct(F.lit(part).alias("part"), b.alias("b")))

    both = F.concat(tagged(PRICE_TODAY, 0), tagged(PRICE_HISTORY, 1))
    cut = pages.select(*others, F.posexplode(both).alias("row", "_r"))
    cut = cut.select(*others, "row", F.col("_r.part").alias("part"), F.col("_r.b").alias("_block"))
    return _columns(cut, [*others, "part"], PRICE_HISTORY).drop("_cells")


def _no_space(s: Column) -> Column:
    return trim(F.regexp_replace(strip_tags(s), r"\s+", ""))


def _list_code(row: Column) -> Column:
    cell = at(F.col("_td"), 0)
    link = F.regexp_extract(cell, ANCHOR, 1)
    return _no_space(F.when(cell.rlike(ANCHOR), link).otherwise(cell))


RANKED_LIST = Rule(
    "ranked_list",
    TR,
    {
        "code": _list_code,
        "name": lambda row: trim(strip_tags(first(row, TH))),
        "market": lambda row: trim(strip_tags(at(F.col("_td"), 1))),
        "td": _tds,
    },
    (LIST_TABLE, TBODY),
    every_scope=True,
    cells=TD,
)

# Cell numbers (from 0) behind the columns of the two list kinds.
DAY_LIST = {"price": 4, "limit_flag": 5, "diff": 6, "diff_pct": 7, "base_or_amount": 8}
PERIOD_LIST = {"price": 4, "limit_flag": 5, "diff": 7, "diff_pct": 8, "base_or_amount": 6}


def ranked_rows(pages: DataFrame, cells: dict[str, int], last_column: bool = True) -> DataFrame:
    """List rows mapped to the report's columns; lists without an amount leave the last one blank."""
    rows = extract(pages, RANKED_LIST)
    others = [c for c in rows.columns if c != "td"]
    mapped = {name: at(F.col("td"), k) for name, k in cells.items()}
    if not last_column:
        mapped["base_or_amount"] = F.lit("")
    return rows.select(*others, *[c.alias(n) for n, c in mapped.items()])


def _cell(k: int) -> Callable[[Column], Column]:
    return lambda row: trim(strip_tags(at(F.col("_td"), k)))


def _paged_list(name: str, cells: dict[str, int], least: int) -> Rule:
    """Evening and morning lists: plain ``tbody`` and ``tr`` elements, a least number of cells."""
    columns: dict[str, Callable[[Column], Column]] = {
        "name": lambda row: trim(strip_tags(first(row, TH))),
        **{n: _cell(k) for n, k in cells.items()},
        "_cells": lambda row: F.size("_td"),
    }
    return Rule(
        name, tag("tr", exact=True), columns, (LIST_TABLE, tag("tbody", exact=True)),
        keep=f"_cells >= {least} AND NOT (code = '' AND name = '')", cells=TD,
    )


NIGHT_LIST = _paged_list(
    "night_list",
    {"code": 0, "market": 1, "close": 4, "night_close_or_text": 5, "diff": 6, "diff_pct": 7, "volume": 8},
    9,
)
MORNING_LIST = _paged_list(
    "morning_list",
    {"code": 0, "market": 1, "night_close_or_text": 3, "close": 4, "limit_flag": 5, "diff": 6, "diff_pct": 7},
    8,
)


def _cells_of(test: Callable[[Column], Column]) -> Column:
    """Whole cells of a row whose class passes the test."""
    return F.transform(F.filter("_td", lambda c: test(c["cls"])), lambda c: c["html"])


def _has(cls: Column, token: str) -> Column:
    return F.array_contains(F.split(cls, r"\s+"), token)


def _centred(cls: Column) -> Column:
    return _has(cls, CENTRED)


def _title_cell(row: Column, group: int) -> Column:
    """Link of the title cell, of the whole row when no such cell has one."""
    cells = F.filter(_cells_of(lambda c: _has(c, LEFT) & _has(c, WRAPPED)), lambda c: c.rlike(LINK))
    return F.regexp_extract(F.coalesce(F.get(cells, F.lit(0)), row), LINK, group)


def _kind_cells() -> Column:
    """Texts of left-aligned cells other than the title's; the first usable one is picked later."""
    cells = _cells_of(lambda c: _has(c, LEFT) & ~_has(c, WRAPPED))
    return F.array_join(F.transform(cells, strip_tags), _KIND_MARK)


_KIND_MARK = "\x02"

DISCLOSURES = Rule(
    "disclosures",
    TR,
    {"title_url": lambda row: _title_cell(row, 1)},
    (NOTICE_TABLE,),
    prefer=TBODY,
    skip=attribute("th", "scope", "col"),
    keep="_raw_code <> ''",
    cells=attribute("td", "class", "[^\"']*") + ".*?</td>",
    classed_cells=True,
    texts={
        "code": lambda row: first(F.array_join(_cells_of(_centred), ""), ANCHOR),
        "company": lambda row: first(row, tag("th", LEFT)),
        "market": lambda row: at(_cells_of(_centred), 1),
        "_kinds": lambda row: _kind_cells(),
        "title": lambda row: _title_cell(row, 2),
        "datetime_str": lambda row: first(row, TIME_TEXT),
    },
)


def disclosure_rows(pages: DataFrame) -> DataFrame:
    """Rows of announcement tables; heading rows have no linked code and drop out with it."""
    rows = extract(pages, DISCLOSURES).withColumn("code", F.upper("code"))
    kinds = F.transform(F.split("_kinds", _KIND_MARK), squeeze)
    usable = F.filter(kinds, lambda t: (t != "") & (t != F.col("market")) & (t != F.col("code")))
    return rows.withColumn("kind", F.coalesce(F.get(usable, F.lit(0)), F.lit(""))).drop("_kinds")


EARNINGS = Rule(
    "earnings",
    TR,
    {
        "iso": lambda row: first(row, TIME_ATTRIBUTE),
        "code": lambda row: first(row, attribute("td", CODE_ATTRIBUTE, "[A-Za-z0-9]+")),
    },
    keep="iso <> ''",
    texts={"title": lambda row: first(row, ANCHOR)},
)

#: A headline, from its date to its title. A date never reaches over its own end tag.
HOLDING_BLOCK = (
    f"(?is){start('div', HEADLINE)}\\s*{start('div', HEADLINE_DATE)}(?:(?!</div>).)*</div>\\s*{start('h4', HEADLINE_TITLE)}.*?</h4>\\s*</div>"
)
#: The box of the headlines ends where the end of a headline is followed by the end of the box.
HOLDING_BOX = f"(?is){start('div', HEADLINE_BOX)}(.*?</div>)\\s*</div>"
#: No headline: a block without a date and a title behind it.
NO_HEADLINE = f"(?is)\\A(?!.*{start('div', HEADLINE_DATE)}.*{start('h4', HEADLINE_TITLE)})"


def holding_blocks(page: Column) -> Column:
    """Headlines of a page. Where it has boxes, headlines outside do not count.

    A page of nothing but boxes, headlines and dates is cut by patterns. One with any other ``div`` goes to the parser, which lets boxes
    and headlines hold more of them.
    """

    def divs(cls: str) -> Column:
        return F.regexp_count(page, F.lit(f"(?i){start('div', cls)}"))

    boxes = every(page, HOLDING_BOX)
    plain = every(F.when(F.size(boxes) > 0, F.array_join(boxes, "\n")).otherwise(page), HOLDING_BLOCK, 0)
    others = F.regexp_count(page, F.lit(r"(?i)<div\b")) > divs(HEADLINE_BOX) + divs(HEADLINE) + divs(HEADLINE_DATE)
    tangled = F.when(others, page)
    inside = elements(tangled, "div", HEADLINE_BOX, outer=False)
    nested = elements(F.when(F.size(inside) > 0, F.array_join(inside, "\n")).otherwise(tangled), "div", HEADLINE)
    return F.when(others, F.filter(nested, lambda b: ~b.rlike(NO_HEADLINE))).otherwise(plain)


def holdings_rule(base_url: str) -> Rule:
    """Large-holding headlines taken apart; ``base_url`` precedes the page's own links."""

    def heading(block: Column) -> Column:
        return first(block, tag("h4", HEADLINE_TITLE))

    def url(block: Column) -> Column:
        href = first(heading(block), LINK)
        return F.when(href != "", F.concat(F.lit(base_url), href)).otherwise("")

    def title(block: Column) -> Column:
        return F.when(heading(block).rlike(LINK), first(heading(block), LINK, 2)).otherwise(heading(block))

    return Rule(
        "holdings",
        HOLDING_BLOCK,
        {"url": url},
        cut=holding_blocks,
        texts={
            "date": lambda b: first(b, tag("div", HEADLINE_DATE)),
            "title": title,
            "flag": lambda b: first(heading(b), tag("span", HEADLINE_FLAG)),
        },
    )


def holding_rows(pages: DataFrame, base_url: str) -> DataFrame:
    """One row per headline: date, category, reporter, target, code, url, content, title."""
    rows = extract(pages, holdings_rule(base_url))
    parts = holding_parts(F.col("title"), F.col("flag"), F.col("url"))
    others = [c for c in rows.columns if c not in ("url", "title", "flag")]
    return rows.select(*others, parts.alias("parts")).select(*others, "parts.*")


def _time_of(block: Column) -> Column:
    return first(block, r'(?i)<time\b[^>]*\bdatetime="([^"]+)"')


def news_rule(
    name: str, block: str, link: str, title: str, prefix: str, timed: bool = True, block_group: int = 1,
    nested: tuple[str, str | None] | None = None,
) -> Rule:
    """News of one source: block, link and title patterns; without ``timed`` the run's time is used."""
    columns: dict[str, Callable[[Column], Column]] = {
        "time_text": _time_of if timed else (lambda b: F.lit("")),
        "url": lambda b: absolute_link(first(b, link), prefix),
    }
    keep = "url <> '' AND _raw_title <> ''" + (" AND time_text <> ''" if timed else "")
    return Rule(name, block, columns, block_group=block_group, keep=keep, nested=nested, texts={"title": lambda b: first(b, title)})


def news_items_rule(
    name: str, item: str, date_class: str, title_class: str, prefix: str, in_anchor: bool, nested: tuple[str, str | None] | None = None
) -> Rule:
    """News by class name: either ``li`` items with a title link, or links that hold date and title spans."""
    date = tag("span", date_class)
    title = tag("span", title_class) if in_anchor else tag("a", title_class)
    own_link = rf"(?i)<a\b(?=[^>]*\bclass=[\"'](?:[^\"']*\s)?{title_class}(?:\s[^\"']*)?[\"'])[^>]*\bhref=[\"']([^\"']+)[\"']"
    link = HREF if in_anchor else own_link
    dates = lambda b: F.filter(
        F.transform(every(b, date), lambda t: squeeze_ascii(strip_tags(t))), lambda t: t != ""
    )
    return Rule(
        name,
        item,
        {
            "time_text": lambda b: at(dates(b), 0),
            "title": lambda b: squeeze_ascii(strip_tags(first(b, title))),
            "url": lambda b: absolute_link(trim(first(b, link)), prefix, force_slash=True),
        },
        block_group=0,
        keep="time_text <> '' AND title <> '' AND url <> ''",
        nested=nested,
    )


def list_header(html: Column) -> Column:
    """struct(date, time, count) from the header of a list page."""
    items = F.transform(
        every(first(first(html, HEADER_BLOCK), r"(?is)<ul>(.*?)</ul>"), r"(?is)<li>(.*?)</li>"),
        lambda c: trim(strip_tags(c)),
    )
    return F.struct(
        at(items, 0).alias("date"), at(items, 1).alias("time"),
        F.coalesce(first_int(at(items, 2)), F.lit(0).cast("bigint")).alias("count"),
    )


def links(pages: DataFrame, prefix_column: Column | None = None) -> DataFrame:
    """Every link of every page with its text; site-relative ones made absolute with the page's site."""
    pattern = r"(?is)<a\b[^>]*\bhref=\"([^\"]*)\"[^>]*>(.*?)</a>"
    site = F.regexp_extract("url", r"^(https?://[^/]+)", 1) if prefix_column is None else prefix_column
    cut = pages.select(
        "page_id", site.alias("site"), F.posexplode(every(F.col("html"), pattern, 0)).alias("row", "_a")
    )
    href = F.regexp_extract("_a", pattern, 1)
    return cut.select(
        "page_id",
        "row",
        F.when(href.startswith("/"), F.concat("site", href)).otherwise(href).alias("link"),
        squeeze(strip_tags(F.regexp_extract("_a", pattern, 2))).alias("text"),
    )


# Limits and patterns of the completeness checks.
MIN_PAGE_CHARS = 1000
BUSY_WORDS = "アクセスが集中|しばらくしてから"
LIST_PAGE_ROWS = 50
STOCK_CELL = r'<td class="tac">\s*<a href="/stock/\?code=([0-9A-Z]{4})">\1</a>\s*</td>'
STOCK_LINK = r'<td class="tac">\s*<a href="/stock/\?code=([0-9A-Z]{4})">'
NEWS_DIV = r'<div class="news">'
TIMED_ROW = r"(?s)<tr[^>]*>.*?<time[^>]*>.*?</time>.*?</tr>"
STAMPED_ROW = r'(?s)<tr[^>]*>.*?<time[^>]*datetime="[^"]+".*?</tr>'
#: A page up to the end of the last row of that kind; behind it every start of a row would be followed to the end of the page in vain.
TO_LAST_TIMED = r"(?s)\A.*<time[^>]*>.*?</time>.*?</tr>"
TO_LAST_STAMPED = r'(?s)\A.*<time[^>]*datetime="[^"]+".*?</tr>'


def page_quality(pages: DataFrame) -> DataFrame:
    """Completeness of every stored page: size, frame, busy text, and the counts each page kind needs."""
    html = F.col("html")

    def count(pattern: str, part: Column = html) -> Column:
        return F.regexp_count(part, F.lit(pattern))

    flags = {
        "long_enough": F.length(html) >= MIN_PAGE_CHARS,
        "has_open": html.rlike("(?i)<html"),
        "has_close": html.rlike("(?i)</html>"),
        "is_busy": html.rlike(BUSY_WORDS),
    }
    counts = {
        "stock_rows": count(STOCK_CELL),
        "stock_links": count(STOCK_LINK),
        "news_blocks": count(NEWS_DIV),
        "timed_rows": count(TIMED_ROW, F.regexp_extract(html, TO_LAST_TIMED, 0)),
        "stamped_rows": count(STAMPED_ROW, F.regexp_extract(html, TO_LAST_STAMPED, 0)),
    }
    out = pages.select(
        *[c for c in pages.columns if c != "html"],
        *[F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items()],
        *[F.coalesce(c, F.lit(0)).alias(n) for n, c in counts.items()],
    )
    basic = F.col("long_enough") & F.col("has_open") & F.col("has_close") & ~F.col("is_busy")
    return out.withColumns(
        {
            "basic_ok": basic,
            "list_ok": basic & (F.col("stock_rows") == LIST_PAGE_ROWS),
            "holdings_ok": basic & (F.col("news_blocks") >= 1),
            "disclosures_ok": basic & (F.col("timed_rows") >= 1),
            "earnings_ok": basic & (F.col("stamped_rows") >= 1),
            "morning_ok": basic & (F.col("stock_links") >= 1),
        }
    )
