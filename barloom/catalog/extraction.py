"""Page extraction. The given pages have no tables, so rows of the given tables are rendered as
pages of each format inside the query and extracted again; the SQL side reads the rows directly."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import dates, text, titles
from ..operators import extract as X
from ..operators import listings as L
from ..operators import reference as R
from ..sources import adapters
from .common import SQL_BARS_BRAND

SITE = "https://site.example"
PAGE_ROWS = 50


def _dealt(df, key: str):
    """Rows of a narrow table over all cores, before pages many times their size are rendered from them: a file of a few MB is one task."""
    return df.repartition(max(1, 2 * df.sparkSession.sparkContext.defaultParallelism), key)


def _paged(df, per_page: int, key: str, row: str, order: str, *also: str):
    """Rows of a page joined in order. A page has at most ``per_page`` rows, so the lists stay small."""
    page = F.floor(F.col(key) / per_page).cast("bigint").alias("page_id")
    grouped = df.groupBy(page, *also).agg(F.array_sort(F.collect_list(F.struct(order, F.col(row).alias("r")))).alias("rs"))
    return grouped.select("page_id", *also, F.array_join(F.transform("rs", lambda z: z["r"]), "\n").alias("rows"))


def _page(rows, head: str = "", tail: str = ""):
    return F.concat(F.lit(f"<!DOCTYPE html><html><body>{head}"), rows, F.lit(f"{tail}</body></html>"))


def _td(c, cls: str = ""):
    return F.concat(F.lit(f"<td{cls}>"), c, F.lit("</td>"))


def _cents(c):
    return F.floor(F.col(c) * 100) / 100.0


# --- price pages ------------------------------------------------------------------------------


def _price_pages(spark, d):
    bars = adapters.bars_brand(spark, d)
    cells = [F.format_number(_cents(c), 2) for c in ("open", "high", "low", "close")]
    cells += [F.lit("0"), F.lit("0.0"), F.format_number("volume", 0)]
    stamp = F.date_format("asof_date", "yyyy-MM-dd")
    row = F.concat(
        F.lit('<tr><th scope="row"><time datetime="'), stamp, F.lit('">x</time></th>'),
        *[_td(F.concat(F.lit("<span>"), c, F.lit("</span>"))) for c in cells], F.lit("</tr>"),
    )
    month = (F.year("asof_date") * 100 + F.month("asof_date")).alias("ym")
    grouped = bars.select("code", "asof_date", month, row.alias("r")).groupBy("code", "ym").agg(
        F.array_sort(F.collect_list(F.struct("asof_date", "r"))).alias("rs")
    )
    rows = F.transform("rs", lambda z: z["r"])

    def table(cls, content):
        return F.concat(F.lit(f'<table class="{cls} x"><thead><tr><th>h</th></tr></thead><tbody>'), content, F.lit("</tbody></table>"))

    # The newest bar of the month is the page's "today" row, the others are its history.
    today = table("stock_kabuka0", F.element_at(rows, -1))
    history = table("stock_kabuka_dwm", F.array_join(F.slice(rows, F.lit(1), F.size(rows) - 1), "\n"))
    return grouped.select("code", _page(F.concat(today, history)).alias("html"))


def _price_roundtrip(spark, d):
    rows = X.price_rows(_price_pages(spark, d))
    return rows.select("code", "asof_date", "open", "high", "low", "close", "volume")


# --- ranked lists -----------------------------------------------------------------------------


def _part_list_pages(spark, d):
    part = adapters.table(spark, d, "part")
    code = F.format_string("P%03d", F.col("p_partkey") % 1000)
    cells = [
        _td(F.concat(F.lit('\n<a href="/stock/?code='), code, F.lit('">'), code, F.lit("</a> ")), ' class="tac"'), _td(F.col("p_brand")), _td(F.lit("")),
        _td(F.lit("")), _td(F.format_number("p_retailprice", 1)), _td(F.lit("<span>S</span>")),
        _td(F.concat(F.lit("<span>+"), F.col("p_size").cast("string"), F.lit("</span>"))),
        _td(F.concat((F.col("p_size") % 7).cast("string"), F.lit("  <b>%</b>"))), _td(F.format_number(F.col("p_partkey") * 1000, 0)),
    ]
    row = F.concat(F.lit("<tr>"), *cells[:1], F.lit("<th>"), F.col("p_name"), F.lit("</th>"), *cells[1:], F.lit("</tr>"))
    df = part.select("p_partkey", "p_brand", "p_type", row.alias("r"))
    pages = _paged(df.withColumnRenamed("p_type", "list"), PAGE_ROWS, "p_partkey", "r", "p_partkey", "list")
    head = (
        '<div class="meigara_count"><ul><li>2002年01月04日</li><li>15:30</li><li>4,175銘柄</li></ul></div>'
        '<table class="stock_table st_market"><thead><tr><td>h</td></tr></thead><tbody>'
    )
    return pages.select("page_id", "list", _page(F.col("rows"), head, "</tbody></table>").alias("html"))


def _ranked_lists(spark, d):
    """Day-list and period-list column maps over the same pages."""
    pages = _part_list_pages(spark, d)
    day = X.ranked_rows(pages, X.DAY_LIST).withColumn("kind", F.lit("day"))
    period = X.ranked_rows(pages, X.PERIOD_LIST).withColumn("kind", F.lit("period"))
    return day.unionByName(period)


def _list_header(spark, d):
    pages = _part_list_pages(spark, d)
    head = pages.select("page_id", "list", X.list_header(F.col("html")).alias("h"))
    head = head.select("page_id", "list", F.col("h.date").alias("page_date"), F.col("h.time").alias("page_time"), F.col("h.count").alias("listed"))
    return L.header_and_captured(X.extract(pages, X.RANKED_LIST), head, ["page_id", "list"])


def _quality_rendered(spark, d):
    return X.page_quality(_part_list_pages(spark, d)).select("page_id", "list", "stock_rows", "stock_links", "timed_rows", "stamped_rows")


def _page_kinds(spark, d):
    """Pages of four kinds, of which some are of a busy site, some cut off at their end and some no more than a frame."""
    part = adapters.table(spark, d, "part")
    code = F.format_string("P%03d", F.col("p_partkey") % 1000)
    row = F.concat(F.lit('<tr><td class="tac">\n<a href="/stock/?code='), code, F.lit('">'), code, F.lit("</a> </td></tr>"))
    lists = _paged(part.select("p_partkey", row.alias("r")), PAGE_ROWS, "p_partkey", "r", "p_partkey")
    lists = lists.select("page_id", _page(F.col("rows"), "<table>", "</table>").alias("html"))
    kinds = {"list": lists, "disclosures": disclosure_pages(spark, d), "earnings": earnings_pages(spark, d), "holdings": holding_pages(spark, d)}
    pages = reduce(lambda a, b: a.unionByName(b), [p.withColumn("kind", F.lit(k)) for k, p in kinds.items()])
    padded = F.replace("html", F.lit("<body>"), F.lit(f"<body><!--{'x' * X.MIN_PAGE_CHARS}-->"))
    k = F.col("page_id")
    html = (
        F.when(k % 11 == 7, "<html></html>")
        .when(k % 5 == 3, F.replace(padded, F.lit("-->"), F.lit("-->アクセスが集中しています")))
        .when(k % 5 == 4, F.replace(padded, F.lit("</html>"), F.lit("")))
        .otherwise(padded)
    )
    return X.page_quality(pages.withColumn("html", html))


def _night_morning(spark, d):
    """Evening list from suppliers (nine cells), morning list from customers (eight), one table."""
    def rows(df, key, name, cells):
        tds = [_td(c) for c in cells]
        row = F.concat(F.lit("<tr>"), tds[0], F.lit("<th scope='row'>"), F.col(name), F.lit("</th>"), *tds[1:], F.lit("</tr>"))
        pages = _paged(df.select(key, row.alias("r")), PAGE_ROWS, key, "r", key)
        head = '<table class="stock_table st_market"><tbody>'
        return pages.select("page_id", _page(F.col("rows"), head, "</tbody></table>").alias("html"))

    s, c = adapters.table(spark, d, "supplier"), adapters.table(spark, d, "customer")
    blank = F.lit("")
    sk, ck = F.col("s_suppkey").cast("string"), F.col("c_custkey").cast("string")
    night = rows(s, "s_suppkey", "s_name", [sk, F.col("s_nationkey").cast("string"), blank, blank, F.format_number("s_acctbal", 1), F.format_number("s_acctbal", 2), F.lit("+1"), F.lit("0.5"), F.format_number("s_suppkey", 0)])
    morning = rows(c, "c_custkey", "c_name", [ck, F.col("c_nationkey").cast("string"), blank, F.concat(F.lit("<a href='/n'>"), F.col("c_mktsegment"), F.lit("</a>")), F.format_number("c_acctbal", 1), F.lit("S"), F.lit("-1"), F.lit("-0.5")])
    a = X.extract(night, X.NIGHT_LIST).withColumn("list", F.lit("night")).withColumn("limit_flag", F.lit(""))
    b = X.extract(morning, X.MORNING_LIST).withColumn("list", F.lit("morning")).withColumn("volume", F.lit(""))
    cols = ["list", "code", "name", "market", "close", "limit_flag", "night_close_or_text", "diff", "diff_pct", "volume"]
    return a.select(*cols).unionByName(b.select(*cols))


# --- announcements ----------------------------------------------------------------------------


def disclosure_pages(spark, d, pos="o_orderkey", day="o_orderdate"):
    """Orders as announcements, read in order of ``pos`` and dated ``day``."""
    o = adapters.table(spark, d, "orders").withColumns({"pos": F.expr(pos), "day": F.expr(day)})
    key = F.col("o_orderkey").cast("string")
    row = F.concat(
        F.lit('<tr><td class="tac"><a href="/s">o'), key, F.lit('</a></td><th class="tal">Firm &amp; '), F.col("o_custkey").cast("string"),
        F.lit('</th><td class="tac">'), F.col("o_orderstatus"), F.lit('</td><td class="tal">'), F.col("o_orderpriority"),
        F.lit('</td><td class="tal wsnormal"><a href="/pdf/'), key, F.lit('">Notice &lt;'), key, F.lit("&gt;</a></td><td><time>"),
        F.date_format("day", "yy/MM/dd"), F.lit("&nbsp;15:30</time></td></tr>"),
    )
    pages = _paged(o.select("pos", row.alias("r")), 100, "pos", "r", "pos")
    # Every fourth page has a table without a body; heading rows hold a linked code, so that only their scope tells them apart.
    head = '<tr><th scope="col">c</th><td class="tac"><a href="/s">head</a></td></tr>'
    body = _page(F.col("rows"), f'<table class="stock_table"><thead>{head}</thead><tbody>{head}', "</tbody></table>")
    bare = _page(F.col("rows"), f'<table class="stock_table">{head}', "</table>")
    return pages.select("page_id", F.when(F.col("page_id") % 4 == 0, bare).otherwise(body).alias("html"))


def _disclosures(spark, d):
    out = X.disclosure_rows(disclosure_pages(spark, d))
    return out.select(
        "page_id", "code", "company", "market", "kind", "title", "title_url", "datetime_str", dates.date_inside(F.col("datetime_str")).alias("day")
    )


_KINDS = ("最高益を更新", "業績を上方修正", "今期は減益", "配当を維持")


def earnings_pages(spark, d, pos="event_id"):
    e = adapters.table(spark, d, "events").withColumn("pos", F.expr(pos))
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (F.col("event_id") % 4 + 1).cast("int"))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    row = F.concat(
        F.lit('<tr><td><time datetime="'), stamp, F.lit('+09:00">t</time></td><td data-code="'),
        F.when(F.col("event_id") % 9 != 0, F.col("user_id").cast("string")).otherwise(""), F.lit('">c</td><td><a href="/n">'),
        F.col("event_type"), F.lit("、"), kind, F.lit(" &amp; "), F.col("event_id").cast("string"), F.lit("</a></td></tr>"),
    )
    pages = _paged(e.select("pos", row.alias("r")), 100, "pos", "r", "pos")
    return pages.select("page_id", _page(F.col("rows"), "<table>", "</table>").alias("html"))


def _earnings(spark, d):
    rows = X.extract(earnings_pages(spark, d), X.EARNINGS).filter("code <> '' AND title <> ''")
    split = titles.company_and_body(F.col("title"))
    return rows.select(
        "page_id", dates.month_day(F.col("iso")).alias("date"), dates.clock(F.col("iso")).alias("time"), "code",
        split["company"].alias("company"), split["body"].alias("body"), titles.first_keyword(split["body"]).alias("class"),
    )


def holding_pages(spark, d, pos="c_custkey"):
    c = adapters.table(spark, d, "customer").withColumn("pos", F.expr(pos))
    key = F.col("c_custkey")
    suffix = F.when(key % 3 == 0, "（買い増し）").when(key % 3 == 1, "（保有減少）").otherwise("")
    mark = F.when(key % 5 == 0, F.format_string("Corp%04d", key)).otherwise(
        F.format_string("会社%d＜%04d＞", key, key % 10000)
    )
    title = F.concat(F.col("c_name"), F.lit("が"), mark, F.lit("株式の変更報告書を提出"), suffix)
    block = F.concat(
        F.lit('<div class="news"><div class="date">2002-01-0'), (key % 9 + 1).cast("string"),
        F.lit('</div><h4 class="title"><span class="diffflag up">増</span><a href="/r/'), key.cast("string"), F.lit('">'),
        title, F.lit("</a></h4></div>"),
    )
    pages = _paged(c.select("pos", block.alias("r")), PAGE_ROWS, "pos", "r", "pos")
    # Two of three pages have a box, with a headline outside it that does not count.
    outside = '<div class="news"><div class="date">2002-01-01</div><h4 class="title">outside</h4></div>'
    boxed = _page(F.col("rows"), f'{outside}<div class="news_box">', f"</div>{outside}")
    return pages.select("page_id", F.when(F.col("page_id") % 3 == 0, _page(F.col("rows"))).otherwise(boxed).alias("html"))


def _holdings(spark, d):
    return X.holding_rows(holding_pages(spark, d), SITE).drop("row")


def _nested_holdings(spark, d):
    """The same headlines, of which two in three hold boxes of their own before the date's end, behind the title, or stand in one."""
    pages, k = holding_pages(spark, d), F.col("page_id")
    more = F.replace("html", F.lit("</h4></div>"), F.lit('</h4><div class="more"><div>a</div><div>b</div></div></div>'))
    around = F.regexp_replace("html", '(<div class="news">.*?</h4></div>)', '<div class="row">$1</div>')
    return X.holding_rows(pages.withColumn("html", F.when(k % 3 == 1, more).when(k % 3 == 2, around).otherwise(F.col("html"))), SITE).drop("row")


# Element and class names of the news layouts the job reads.
NEWS_RULES = (
    X.news_rule(
        "cards", r"(?is)<div class=\"card\"[^>]*>(.*?)</div>", r'(?is)<a[^>]*data-testid="Title"[^>]*href="([^"]+)"',
        r'(?is)<h3[^>]*data-testid="Heading"[^>]*>(.*?)</h3>', SITE, nested=("div", "card"),
    ),
    X.news_rule("heads", r'(?is)<h3 class="item[^"]*"[^>]*>.*?</h3>', X.HREF, X.ANCHOR, SITE, timed=False, block_group=0),
    X.news_items_rule("items", X.tag("li", "newsList__item"), "newsList__date", "newsList__title", SITE, in_anchor=False, nested=("li", "newsList__item")),
    X.news_items_rule("notes", r"(?is)<a\b[^>]*>.*?</a>", "news-list-date", "news-list-title", SITE, in_anchor=True),
)


def news_blocks(link):
    """An event as a news item in the layout of every source, by rule name; ``link`` makes an address of the source's letter."""
    key, stamp = F.col("event_id").cast("string"), F.date_format("ts", "yyyy/MM/dd HH:mm")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    return {
        "cards": text('<div class="card"><time datetime="', iso, '">x</time><a data-testid="Title" href="/', link("a"), '"><h3 data-testid="Heading">A ', key, "</h3></a></div>"),
        "heads": text('<h3 class="item_x"> <a href="', SITE, "/", link("b"), '">B &amp; ', key, "</a></h3>"),
        "items": text('<ul><li class="newsList__item new"><span class="newsList__date"> </span><span class="newsList__date">', stamp, '</span><a class="x newsList__title" href="', link("c"), '">C  ', key, "</a></li></ul>"),
        "notes": text('<p><a href="/', link("d"), '"><span class="news-list-date">', stamp, '</span><span class="news-list-title">D ', key, "</span></a></p>"),
    }


def paged_news(events, block):
    pages = _paged(events.select("event_id", block.alias("r")), PAGE_ROWS, "event_id", "r", "event_id")
    return pages.select("page_id", _page(F.col("rows")).alias("html"))


def _news_articles(spark, d):
    """One event rendered in each of the four layouts on one page, cut by all rules in one pass; every rule picks up its own."""
    blocks = news_blocks(lambda letter: F.concat_ws("/", F.lit(letter), F.col("event_id").cast("string")))
    pages = paged_news(adapters.table(spark, d, "events"), F.concat(*blocks.values()))
    return X.extract_all(pages, NEWS_RULES).drop("row")


def _nested_news(spark, d):
    """Items that hold other elements of their own name before link and title: lists in list items, boxes in cards."""
    events = adapters.table(spark, d, "events")
    blocks = news_blocks(lambda letter: F.concat_ws("/", F.lit(letter), F.col("event_id").cast("string")))
    tags = '<ul class="tags"><li>x</li><li class="y">z</li></ul><!-- </li> -->'
    boxes = '<div class="pic"><div></div></div>'
    mixed = F.col("event_id") % 3 == 0
    items = F.replace(blocks["items"], F.lit('new">'), F.when(mixed, F.lit(f'new">{tags}')).otherwise(F.lit('new">')))
    cards = F.replace(blocks["cards"], F.lit('card">'), F.when(mixed, F.lit(f'card">{boxes}')).otherwise(F.lit('card">')))
    return X.extract_all(paged_news(events, F.concat(items, cards)), NEWS_RULES).filter("source IN ('items', 'cards')").drop("row")


# --- reference pages --------------------------------------------------------------------------


def _basic_info(spark, d):
    p = _dealt(adapters.table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_retailprice", "p_size", "p_brand"), "p_partkey")
    key = F.col("p_partkey")

    def t(*parts):
        return F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])

    html = t(
        '<html><div id="stockinfo_i1"><div class="si_i1_1"><h2><span>1234</span> ', F.col("p_name"), '</h2><span class="market">', F.col("p_type"),
        '</span></div><div class="si_i1_2"><span class="kabuka">', F.format_number("p_retailprice", 1), '円</span></div><dl class="si_i1_dl1"><dd><span>+', F.col("p_size"),
        "</span></dd><dd><span>+0.", F.col("p_size") % 10, '</span>%</dd></dl></div><div id="stockinfo_i3"><table><thead><tr><th>PER</th></tr></thead><tbody><tr><td>',
        F.when(key % 4 == 0, "－").otherwise(F.concat((key % 40).cast("string"), F.lit(".25"))), "<span>倍</span></td><td>", key % 3, ".5<span>倍</span></td><td>",
        key % 6, '.15<span>％</span></td><td>', key % 8, '.4<span>倍</span></td></tr><tr><td class="v_zika2">',
        F.when(key % 2 == 0, F.concat(F.lit("1"), F.lit("兆"), F.format_number(key, 0))).otherwise(F.format_number(key, 0)),
        '<span>億円</span></td></tr></tbody></table></div><!--stockinfo_i3--><div id="kobetsu_left"><table><tbody><tr><td>1</td></tr></tbody></table><table><tbody><tr><td>',
        F.format_number(key * 100, 0), '&nbsp;株</td></tr></tbody></table><h2>信用取引</h2><table><tbody><tr><th>2002/01/04</th><td>', F.format_number(key % 5, 0),
        "</td><td>", F.format_number(key * 10, 0), '</td><td>3.21倍</td></tr></tbody></table></div><div id="kobetsu_right"><div class="company_block"><h3>',
        F.col("p_name"), " &amp; Co</h3><table><tr><th>概要</th><td>about <b>", F.col("p_type"), "</b></td></tr><tr><th>業種</th><td>", F.col("p_brand"),
        '</td></tr></table></div><div class="gyouseki_block"><table><tbody><tr><td>0</td></tr><tr><td>', F.format_number(key * 3, 0), "</td><td>", key * 2, ".06</td><td>-", key,
        "</td></tr></tbody></table></div></div></html>",
    )
    broken = F.lit("<html>moved</html>")
    pages = p.select(key.cast("string").alias("code"), F.when(key % 50 == 7, broken).otherwise(html).alias("html"))
    return R.basic_info_numbers(R.basic_info(pages, "2002-01-04"))


def _handbook(spark, d):
    p = _dealt(adapters.table(spark, d, "part").select("p_partkey", "p_name", "p_type"), "p_partkey")
    key = F.col("p_partkey")
    markets = F.array(*[F.lit(m) for m in (*R.TARGET_MARKETS, "ETF・ETN")])
    dds = F.concat(*[F.concat(F.lit(f"<dt>{label}</dt><dd>"), (key % (k + 2)).cast("string"), F.lit("</dd>")) for k, label in enumerate(R.SCORE_LABELS.values())])
    some = F.concat(F.lit("<dt> 規模 </dt><dd>"), (key % 9).cast("string"), F.lit("</dd>"))
    html = F.concat(
        F.lit('<div class="planned-disclosure-date"><span class="label">x</span><span class="date">02/0'), (key % 9 + 1).cast("string"),
        F.lit('</span></div><dl class="information__list"><dt>特色</dt><dd>'), F.col("p_name"), F.lit(' &amp; <a href="/x">more</a></dd><dt>連結事業</dt><dd><a>'),
        F.col("p_type"), F.lit('</a></dd></dl><div class="score__head"><span class="num">'), (key % 5).cast("string"),
        F.lit('</span></div><div class="score__chart-wrapper__main"><dl>'), F.when(key % 3 == 0, some).otherwise(dds), F.lit("</dl></div>"),
    )
    pages = p.select(
        key.cast("string").alias("code"), F.element_at(markets, (key % 4 + 1).cast("int")).alias("market_class"),
        F.when(key % 25 == 1, "<html>wait</html>").otherwise(html).alias("html"),
    )
    return R.handbook(pages, "2002-01-04")


def _span_cleanup(spark, d):
    """Names marked up with spans: tags alone taken off, or the spans with all they hold."""
    p = adapters.table(spark, d, "part")
    cell = F.concat(F.lit('<b> '), F.col("p_name"), F.lit('</b> &amp; <SPAN class="x">'), F.col("p_brand"), F.lit("\n&nbsp;</SPAN><span>"), F.col("p_type"), F.lit("</span> end "))
    bare = F.regexp_replace(cell, "</?b>", "")
    return p.select("p_partkey", text.drop_span_tags(F.lower(bare)).alias("tags_off"), text.drop_spans(bare).alias("spans_off"))


def _reference_counts(spark, d):
    """What the two reference jobs did with their codes; the basic-information job skips none."""
    jobs = {"basic_info": _basic_info(spark, d), "handbook": _handbook(spark, d)}
    return reduce(lambda a, b: a.unionByName(b), [R.class_counts(rows).withColumn("job", F.lit(k)) for k, rows in jobs.items()])


# --- the given pages --------------------------------------------------------------------------


def _pages(spark, d):
    return adapters.table(spark, d, "pages")


QUERIES = {
    "extract_roundtrip": _price_roundtrip,
    "extract_ranked_lists": _ranked_lists,
    "extract_list_header": _list_header,
    "extract_night_morning": _night_morning,
    "extract_disclosures": _disclosures,
    "extract_earnings": _earnings,
    "extract_holdings": _holdings,
    "extract_holdings_nested": _nested_holdings,
    "extract_news": _news_articles,
    "extract_news_nested": _nested_news,
    "extract_basic_info": _basic_info,
    "extract_handbook": _handbook,
    "reference_counts": _reference_counts,
    "extract_links": lambda spark, d: X.links(_pages(spark, d)),
    "page_quality": lambda spark, d: X.page_quality(_pages(spark, d)),
    "page_quality_lists": _quality_rendered,
    "page_kinds": _page_kinds,
    "span_cleanup": _span_cleanup,
}

def _fmt(x: str, n: int) -> str:
    return f"format('{{:,.{n}f}}', CAST({x} AS DOUBLE))"


ORACLES = {
    "extract_roundtrip": f"""WITH {SQL_BARS_BRAND} SELECT code, asof_date, floor(open * 100) / 100 AS open, floor(high * 100) / 100 AS high,
  floor(low * 100) / 100 AS low, floor(close * 100) / 100 AS close, volume FROM bars_brand""",
    "extract_ranked_lists": f"""WITH r AS (
  SELECT p_partkey // 50 AS page_id, p_type AS list, CAST(row_number() OVER (PARTITION BY p_partkey // 50, p_type ORDER BY p_partkey) - 1 AS INTEGER) AS "row",
         'P' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS code, p_name AS name, p_brand AS market,
         {_fmt('p_retailprice', 1)} AS price, 'S' AS limit_flag, '+' || p_size AS t6, (p_size % 7) || ' %' AS t7, {_fmt('p_partkey * 1000', 0)} AS t8 FROM part)
SELECT page_id, list, "row", code, name, market, price, limit_flag, t6 AS diff, t7 AS diff_pct, t8 AS base_or_amount, 'day' AS kind FROM r
UNION ALL SELECT page_id, list, "row", code, name, market, price, limit_flag, t7, t8, t6, 'period' FROM r""",
    "extract_list_header": """SELECT p_partkey // 50 AS page_id, p_type AS list, '2002年01月04日' AS page_date, '15:30' AS page_time,
  CAST(4175 AS BIGINT) AS listed, count(*) AS captured FROM part GROUP BY 1, 2""",
    "page_quality_lists": """SELECT p_partkey // 50 AS page_id, p_type AS list, CAST(count(*) AS INTEGER) AS stock_rows,
  CAST(count(*) AS INTEGER) AS stock_links, 0 AS timed_rows, 0 AS stamped_rows FROM part GROUP BY 1, 2""",
    "reference_counts": """SELECT 'basic_info' AS job, class, CASE class WHEN 'ok' THEN (SELECT count(*) FROM part WHERE p_partkey % 50 <> 7)
    WHEN 'skip' THEN 0 ELSE (SELECT count(*) FROM part WHERE p_partkey % 50 = 7) END AS codes FROM (VALUES ('ok'), ('skip'), ('error')) v(class)
UNION ALL SELECT 'handbook', class, CASE class WHEN 'ok' THEN (SELECT count(*) FROM part WHERE p_partkey % 4 <> 3 AND p_partkey % 25 <> 1)
    WHEN 'skip' THEN (SELECT count(*) FROM part WHERE p_partkey % 4 = 3)
    ELSE (SELECT count(*) FROM part WHERE p_partkey % 4 <> 3 AND p_partkey % 25 = 1) END FROM (VALUES ('ok'), ('skip'), ('error')) v(class)""",
    "span_cleanup": """SELECT p_partkey, lower(p_name) || ' & ' || lower(p_brand) || ' ' || lower(p_type) || ' end' AS tags_off, p_name || ' & end' AS spans_off FROM part""",
    "page_kinds": """WITH n AS (
  SELECT 'list' AS kind, p_partkey // 50 AS page_id, count(*) AS n FROM part GROUP BY 2
  UNION ALL SELECT 'disclosures', o_orderkey // 100, count(*) FROM orders GROUP BY 2
  UNION ALL SELECT 'earnings', event_id // 100, count(*) FROM events GROUP BY 2
  UNION ALL SELECT 'holdings', c_custkey // 50, count(*) FROM customer GROUP BY 2),
k AS (SELECT kind, page_id, page_id % 11 = 7 AS short, page_id % 11 <> 7 AND page_id % 5 = 3 AS busy, page_id % 11 <> 7 AND page_id % 5 = 4 AS cut,
  CASE WHEN page_id % 11 = 7 THEN 0 ELSE n END AS n FROM n),
c AS (SELECT kind, page_id, NOT short AS long_enough, true AS has_open, NOT cut AS has_close, busy AS is_busy,
  CASE WHEN kind = 'list' THEN n ELSE 0 END AS stock_rows, CASE WHEN kind = 'list' THEN n ELSE 0 END AS stock_links,
  CASE WHEN kind = 'holdings' AND NOT short THEN n + CASE WHEN page_id % 3 = 0 THEN 0 ELSE 2 END ELSE 0 END AS news_blocks,
  CASE WHEN kind IN ('disclosures', 'earnings') THEN n ELSE 0 END AS timed_rows, CASE WHEN kind = 'earnings' THEN n ELSE 0 END AS stamped_rows,
  NOT short AND NOT cut AND NOT busy AS basic_ok FROM k)
SELECT *, basic_ok AND stock_rows = 50 AS list_ok, basic_ok AND news_blocks > 0 AS holdings_ok, basic_ok AND timed_rows > 0 AS disclosures_ok,
  basic_ok AND stamped_rows > 0 AS earnings_ok, basic_ok AND stock_links > 0 AS morning_ok FROM c""",
    "extract_night_morning": f"""SELECT 'night' AS list, CAST(s_suppkey AS VARCHAR) AS code, s_name AS name, CAST(s_nationkey AS VARCHAR) AS market,
  {_fmt('s_acctbal', 1)} AS close, '' AS limit_flag, {_fmt('s_acctbal', 2)} AS night_close_or_text, '+1' AS diff, '0.5' AS diff_pct, {_fmt('s_suppkey', 0)} AS volume FROM supplier
UNION ALL SELECT 'morning', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), {_fmt('c_acctbal', 1)}, 'S', c_mktsegment, '-1', '-0.5', '' FROM customer""",
    "extract_disclosures": """SELECT o_orderkey // 100 AS page_id, 'O' || o_orderkey AS code, 'Firm & ' || o_custkey AS company, o_orderstatus AS market,
  o_orderpriority AS kind, 'Notice <' || o_orderkey || '>' AS title, '/pdf/' || o_orderkey AS title_url,
  strftime(o_orderdate, '%y/%m/%d') || ' 15:30' AS datetime_str,
  CAST('20' || strftime(o_orderdate, '%y-%m-%d') AS DATE) AS day FROM orders""",
    "extract_earnings": """WITH e AS (SELECT *, ['最高益を更新', '業績を上方修正', '今期は減益', '配当を維持'][event_id % 4 + 1] || ' & ' || event_id AS body FROM events)
SELECT event_id // 100 AS page_id, strftime(ts, '%m/%d') AS date, strftime(ts, '%H:%M') AS time, CAST(user_id AS VARCHAR) AS code, event_type AS company, body,
  CASE event_id % 4 WHEN 0 THEN '最高益' WHEN 1 THEN '上方修正' WHEN 2 THEN '減益' ELSE 'ー' END AS class FROM e WHERE event_id % 9 <> 0""",
    "extract_holdings": """SELECT c_custkey // 50 AS page_id, '2002-01-0' || (c_custkey % 9 + 1) AS date,
  CASE c_custkey % 3 WHEN 0 THEN '買い増し' WHEN 1 THEN '保有減少' ELSE '増' END AS category, c_name AS reporter,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '会社' || c_custkey END AS target,
  CASE WHEN c_custkey % 5 = 0 THEN 'Corp' ELSE lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS code,
  'https://site.example/r/' || c_custkey AS url, '変更報告書を提出' AS content,
  c_name || 'が' || CASE WHEN c_custkey % 5 = 0 THEN 'Corp' || lpad(CAST(c_custkey AS VARCHAR), 4, '0')
                         ELSE '会社' || c_custkey || '＜' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || '＞' END
    || '株式の変更報告書を提出' || CASE c_custkey % 3 WHEN 0 THEN '（買い増し）' WHEN 1 THEN '（保有減少）' ELSE '' END AS title
FROM customer""",
    "extract_news": """SELECT event_id // 50 AS page_id, source, time_text, title, 'https://site.example/' || url AS url FROM (
  SELECT event_id, 'cards' AS source, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS time_text, 'A ' || event_id AS title, 'a/' || event_id AS url FROM events
  UNION ALL SELECT event_id, 'heads', '', 'B & ' || event_id, 'b/' || event_id FROM events
  UNION ALL SELECT event_id, 'items', strftime(ts, '%Y/%m/%d %H:%M'), 'C ' || event_id, 'c/' || event_id FROM events
  UNION ALL SELECT event_id, 'notes', strftime(ts, '%Y/%m/%d %H:%M'), 'D ' || event_id, 'd/' || event_id FROM events)""",
    "extract_news_nested": """SELECT event_id // 50 AS page_id, source, time_text, title, 'https://site.example/' || url AS url FROM (
  SELECT event_id, 'cards' AS source, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS time_text, 'A ' || event_id AS title, 'a/' || event_id AS url FROM events
  UNION ALL SELECT event_id, 'items', strftime(ts, '%Y/%m/%d %H:%M'), 'C ' || event_id, 'c/' || event_id FROM events)""",
    "extract_basic_info": f"""WITH p AS (SELECT *, p_partkey % 50 <> 7 AS ok, p_partkey AS k FROM part)
SELECT CAST(k AS VARCHAR) AS code, '2002-01-04' AS run_date, CASE WHEN ok THEN '正常' ELSE 'エラー：株探読み込みに失敗' END AS result,
  CASE WHEN ok THEN p_name ELSE '' END AS short_name, CASE WHEN ok THEN p_name || ' & Co' ELSE '' END AS name,
  CASE WHEN ok THEN p_brand ELSE '' END AS industry, CASE WHEN ok THEN 'about ' || p_type ELSE '' END AS summary,
  CASE WHEN ok THEN CASE WHEN k % 2 = 0 THEN 10000.0 + k ELSE CAST(k AS DOUBLE) END END AS market_cap,
  CASE WHEN ok THEN p_type ELSE '' END AS listing_class, CASE WHEN ok THEN CAST(k * 3 AS DOUBLE) END AS sales,
  CASE WHEN ok THEN CAST(k * 2 + 0.1 AS DOUBLE) END AS ordinary_profit, CASE WHEN ok THEN -CAST(k AS DOUBLE) + 0.0 END AS net_income,
  CASE WHEN ok THEN CASE WHEN k % 4 = 0 THEN 'ー' ELSE (k % 40) || '.3' END END AS per,
  CASE WHEN ok THEN CAST(k % 3 + 0.5 AS DOUBLE) END AS pbr, CASE WHEN ok THEN (k % 6) || '.15' ELSE '' END AS yield,
  CASE WHEN ok THEN format('{{:.1f}}', p_retailprice) ELSE '' END AS close, CASE WHEN ok THEN '+' || p_size ELSE '' END AS diff,
  CASE WHEN ok THEN '+0.' || (p_size % 10) ELSE '' END AS change_pct, CASE WHEN ok THEN CAST(k * 100 AS DOUBLE) END AS volume,
  CASE WHEN ok THEN '2002/01/04' ELSE '' END AS margin_date, CASE WHEN ok THEN CAST(k % 5 AS VARCHAR) ELSE '' END AS margin_short,
  CASE WHEN ok THEN CAST(k * 10 AS VARCHAR) ELSE '' END AS margin_long,
  CASE WHEN ok THEN CASE WHEN k % 5 = 0 OR k = 0 THEN 'ー' ELSE (k % 8) || '.4' END END AS margin_ratio
FROM p""",
    "extract_handbook": """WITH p AS (SELECT *, p_partkey AS k, p_partkey % 4 = 3 AS skip, p_partkey % 25 = 1 AS bad FROM part),
q AS (SELECT *, NOT skip AND NOT bad AS ok, NOT skip AND NOT bad AND k % 3 <> 0 AS six FROM p)
SELECT CAST(k AS VARCHAR) AS code, '2002-01-04' AS run_date,
  CASE WHEN skip THEN 'スキップ（市場対象外）' WHEN bad THEN 'エラー：四季報読み込みに失敗' ELSE '正常' END AS result,
  CASE WHEN ok THEN '02/0' || (k % 9 + 1) ELSE '' END AS planned_date, CASE WHEN ok THEN p_name || ' &' ELSE '' END AS feature,
  CASE WHEN ok THEN p_type ELSE '' END AS business, CASE WHEN ok THEN CAST(k % 5 AS VARCHAR) ELSE '' END AS score,
  CASE WHEN six THEN CAST(k % 2 AS VARCHAR) ELSE '' END AS growth, CASE WHEN six THEN CAST(k % 3 AS VARCHAR) ELSE '' END AS profitability,
  CASE WHEN six THEN CAST(k % 4 AS VARCHAR) ELSE '' END AS safety,
  CASE WHEN six THEN CAST(k % 5 AS VARCHAR) WHEN ok THEN CAST(k % 9 AS VARCHAR) ELSE '' END AS scale,
  CASE WHEN six THEN CAST(k % 6 AS VARCHAR) ELSE '' END AS cheapness, CASE WHEN six THEN CAST(k % 7 AS VARCHAR) ELSE '' END AS upside
FROM q""",
    "extract_links": """WITH a AS (SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS site, unnest(regexp_extract_all(html, '(?i)<a\\b[^>]*\\bhref="([^"]*)"[^>]*>([\\s\\S]*?)</a>', 0)) AS a,
         generate_subscripts(regexp_extract_all(html, '(?i)<a\\b[^>]*\\bhref="([^"]*)"[^>]*>([\\s\\S]*?)</a>', 0), 1) AS k FROM pages),
b AS (SELECT page_id, k, site, regexp_extract(a, '(?i)href="([^"]*)"', 1) AS href, regexp_replace(regexp_extract(a, '>([\\s\\S]*)</a>$', 1), '<[^>]*>', '', 'g') AS t FROM a)
SELECT page_id, CAST(k - 1 AS INTEGER) AS "row", CASE WHEN starts_with(href, '/') THEN site || href ELSE href END AS link,
  trim(regexp_replace(t, '\\s+', ' ', 'g')) AS text FROM b""",
    "page_quality": """WITH q AS (SELECT page_id, url, length(html) >= 1000 AS long_enough, regexp_matches(html, '(?i)<html') AS has_open, regexp_matches(html, '(?i)</html>') AS has_close,
  regexp_matches(html, 'アクセスが集中|しばらくしてから') AS is_busy,
  CAST(len(regexp_extract_all(html, '<td class="tac">\\s*<a href="/stock/\\?code=([0-9A-Z]{4})">')) AS INTEGER) AS stock_links,
  CAST(len(regexp_extract_all(html, '<div class="news">')) AS INTEGER) AS news_blocks,
  CAST(len(regexp_extract_all(html, '<tr[^>]*>[\\s\\S]*?<time[^>]*>[\\s\\S]*?</time>[\\s\\S]*?</tr>')) AS INTEGER) AS timed_rows,
  CAST(len(regexp_extract_all(html, '<tr[^>]*>[\\s\\S]*?<time[^>]*datetime="[^"]+"[\\s\\S]*?</tr>')) AS INTEGER) AS stamped_rows,
  CAST(len(list_filter(regexp_extract_all(html, '<td class="tac">\\s*<a href="/stock/\\?code=[0-9A-Z]{4}">[0-9A-Z]{4}</a>\\s*</td>'),
    lambda x: regexp_extract(x, 'code=([0-9A-Z]{4})', 1) = regexp_extract(x, '>([0-9A-Z]{4})</a>', 1))) AS INTEGER) AS stock_rows
  FROM pages)
SELECT *, long_enough AND has_open AND has_close AND NOT is_busy AS basic_ok,
  long_enough AND has_open AND has_close AND NOT is_busy AND stock_rows = 50 AS list_ok, long_enough AND has_open AND has_close AND NOT is_busy AND news_blocks >= 1 AS holdings_ok,
  long_enough AND has_open AND has_close AND NOT is_busy AND timed_rows >= 1 AS disclosures_ok, long_enough AND has_open AND has_close AND NOT is_busy AND stamped_rows >= 1 AS earnings_ok,
  long_enough AND has_open AND has_close AND NOT is_busy AND stock_links >= 1 AS morning_ok FROM q""",
}
ORACLES["extract_holdings_nested"] = ORACLES["extract_holdings"]
