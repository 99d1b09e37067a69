"""Reference data: code masters, base information, handbook scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions.text import clean_many, strip_tags, without_span_tags
from .dedupe import last_wins
from .extract import at, every, first

# Market classes the handbook job covers, and its status texts.
TARGET_MARKETS = ("プライム（内国株式）", "スタンダード（内国株式）", "グロース（内国株式）")
RESULT_OK = "正常"
RESULT_SKIPPED = "スキップ（市場対象外）"
RESULT_HANDBOOK_FAILED = "エラー：四季報読み込みに失敗"
RESULT_BASIC_FAILED = "エラー：株探読み込みに失敗"
KEY_HEADERS = ("証券コード", "更新日", "実行結果")


def until_blank(master: DataFrame, key: str = "code", order: str = "row_idx") -> DataFrame:
    """Rows before the first blank key; everything after it is ignored.

    The position of that blank is one number, found by a partial aggregation.
    """
    blank = F.coalesce(F.trim(key), F.lit("")) == ""
    stop = master.filter(blank).agg(F.min(order)).scalar()
    return master.filter(F.coalesce(F.col(order) < stop, F.lit(True)))


def without_blanks(master: DataFrame, key: str = "code") -> DataFrame:
    return master.filter(F.trim(key) != "")


def distinct_in_order(master: DataFrame, key: str = "code", order: str = "row_idx") -> DataFrame:
    """Every key once, with the position it was first seen at."""
    return master.groupBy(F.trim(key).alias(key)).agg(F.min(order).alias(order))


def wide_master(sheet: DataFrame, skip: tuple[str, ...] = KEY_HEADERS, code: str | None = None) -> DataFrame:
    """Header-driven master: first column is the code, named columns are carried, the last row of a code wins."""
    key = code or next(c for c in sheet.columns if c != "row_idx")
    carried = [c for c in sheet.columns if c.strip() and c not in (*skip, key, "row_idx", "code")]
    rows = sheet.select(F.trim(key).alias("code"), "row_idx", *carried).filter("code <> ''")
    return last_wins(rows, ["code"], ["row_idx"]).drop("row_idx")


def tag_market(master: DataFrame, markets: tuple[str, ...] = TARGET_MARKETS, column: str = "market_class") -> DataFrame:
    """``result`` is the skip text for codes of other markets; no row is lost."""
    return master.withColumn("result", F.when(~F.trim(column).isin(*markets), RESULT_SKIPPED))


def all_blank(*cols: str) -> Column:
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in cols]).isNull()


# Ids, class names and labels of the stock information page.
_ID_MARK = 'id="stockinfo_i1"'
_SHORT_NAME = r'(?is)<div id="stockinfo_i1".*?<h2>(.*?)</h2>'
_MARKET = r'(?is)<span class="market">(.*?)</span>'
_CLOSE = r'(?is)<div class="si_i1_2">.*?<span class="kabuka">(.*?)</span>'
_CHANGES = r'(?is)<dl class="si_i1_dl1">(.*?)</dl>'
_RATIOS = (r'(?is)<div id="stockinfo_i3">(.*?)</div><!--stockinfo_i3-->', r'(?is)<div id="stockinfo_i3">(.*?)</div>')
_CAP = r'(?is)class="v_zika2">(.*?)</td>'
_COMPANY = r'(?is)<div id="kobetsu_right".*?<div class="company_block">.*?'
_RESULTS = r'(?is)<div id="kobetsu_right".*?<div class="gyouseki_block">.*?<tbody>(.*?)</tbody>'
_LEFT = r'(?is)<div id="kobetsu_left">(.*?)</div>'
_CREDIT = (
    r'(?is)<div id="kobetsu_left".*?<h2[^>]*>\s*信用取引.*?</h2>.*?<table[^>]*>(.*?)</table>'
)
_TABLE = r"(?is)<table.*?</table>"
_ROW = r"(?is)<tr[^>]*>(.*?)</tr>"
_CELL = r"(?is)<td[^>]*>(.*?)</td>"
_DD = r"(?is)<dd>(.*?)</dd>"
_BODY = r"(?is)<tbody>(.*?)</tbody>"
INDUSTRY_LABEL, SUMMARY_LABEL = "業種", "概要"


def _cells_of_row(block: Column, row: int) -> Column:
    return every(at(every(block, _ROW), row), _CELL)


def _labelled_cell(table: Column, label: str) -> Column:
    return first(table, rf"(?is)<th[^>]*>{label}</th>\s*<td[^>]*>(.*?)</td>")


def basic_info(pages: DataFrame, run_date: str) -> DataFrame:
    """One row per (code, html) page: the 20 fields as page text, numbers freed from their units."""
    # Cut the page into its blocks first; the page text itself goes no further.
    html = F.col("html")
    blocks = {
        "_ok": html.contains(_ID_MARK),
        "_name": first(html, _SHORT_NAME),
        "_market": first(html, _MARKET),
        "_close": first(html, _CLOSE),
        "_changes": every(first(html, _CHANGES), _DD),
        "_ratios": F.coalesce(*[F.nullif(first(html, p), F.lit("")) for p in _RATIOS], F.lit("")),
        "_company": first(html, _COMPANY + r"<h3>(.*?)</h3>"),
        "_table": first(html, _COMPANY + r"<table[^>]*>(.*?)</table>"),
        "_results": _cells_of_row(first(html, _RESULTS), 1),
        "_left": at(every(first(html, _LEFT), _TABLE, 0), 1),
        "_credit": first(first(html, _CREDIT), _BODY),
    }
    cut = pages.select("code", *[c.alias(n) for n, c in blocks.items()])
    # Cells that several fields are made of are cut once, in selects of their own.
    cut = cut.withColumns({"_ratio_cells": _cells_of_row(first(F.col("_ratios"), _BODY), 0), "_credit_row": at(every(F.col("_credit"), _ROW), 0)})
    cut = cut.withColumn("_credit_cells", every(F.col("_credit_row"), _CELL))
    ratios, credit_row, credit = F.col("_ratio_cells"), F.col("_credit_row"), F.col("_credit_cells")
    raw = {
        "short_name": without_span_tags(F.col("_name")),
        "name": strip_tags(F.col("_company")),
        "industry": strip_tags(_labelled_cell(F.col("_table"), INDUSTRY_LABEL)),
        "summary": strip_tags(_labelled_cell(F.col("_table"), SUMMARY_LABEL)),
        "market_cap": without_span_tags(first(F.col("_ratios"), _CAP)),
        "listing_class": strip_tags(F.col("_market")),
        "sales": strip_tags(at(F.col("_results"), 0)),
        "ordinary_profit": strip_tags(at(F.col("_results"), 1)),
        "net_income": strip_tags(at(F.col("_results"), 2)),
        "per": without_span_tags(at(ratios, 0)),
        "pbr": without_span_tags(at(ratios, 1)),
        "yield": without_span_tags(at(ratios, 2)),
        "close": strip_tags(F.col("_close")),
        "diff": strip_tags(at(F.col("_changes"), 0)),
        "change_pct": strip_tags(at(F.col("_changes"), 1)),
        "volume": strip_tags(at(_cells_of_row(first(F.col("_left"), _BODY), 0), 0)),
        "margin_date": strip_tags(first(credit_row, r"(?is)<th[^>]*>(.*?)</th>")),
        "margin_short": strip_tags(at(credit, 0)),
        "margin_long": strip_tags(at(credit, 1)),
        "margin_ratio": strip_tags(at(credit, 2)),
        "_ratio_margin": without_span_tags(at(ratios, 3)),
    }
    read = _decoded_columns(cut, ["code", "_ok"], raw)
    no_unit = {c: N.drop_units(F.col(c)) for c in ("yield", "close", "change_pct", "volume", "margin_short", "margin_long")}
    freed = {
        **no_unit,
        "short_name": N.trim(F.regexp_replace("short_name", r"^\d{4}\s*", "")),
        "market_cap": N.trim(F.regexp_replace("market_cap", "億円", "")),
        "per": N.trim(F.regexp_replace("per", N.TIMES_UNIT, "")),
        "pbr": N.trim(F.regexp_replace("pbr", N.TIMES_UNIT, "")),
        "margin_date": F.regexp_replace("margin_date", r"[^\d./-]", ""),
        "margin_ratio": F.coalesce(
            F.nullif(N.drop_units(F.col("_ratio_margin")), F.lit("")), N.drop_units(F.col("margin_ratio"))
        ),
    }
    names = [n for n in raw if not n.startswith("_")]
    return read.select(
        "code",
        F.lit(run_date).alias("run_date"),
        F.when(F.col("_ok"), RESULT_OK).otherwise(RESULT_BASIC_FAILED).alias("result"),
        *[F.when(F.col("_ok"), freed.get(n, F.col(n))).otherwise("").alias(n) for n in names],
    )


def _decoded_columns(cut: DataFrame, keep: list[str], raw: dict[str, Column]) -> DataFrame:
    """Raw texts as columns, decoded together."""
    staged = cut.select(*keep, *[c.alias(f"_raw{n}") for n, c in raw.items()])
    staged = staged.select(*keep, clean_many([F.col(f"_raw{n}") for n in raw]).alias("_texts"))
    return staged.select(*keep, *[at(F.col("_texts"), k).alias(n) for k, n in enumerate(raw)])


def basic_info_numbers(info: DataFrame) -> DataFrame:
    """Report formats: one decimal, market value in 10^8, dashes where a ratio has no meaning."""
    c = F.col
    return info.withColumns(
        {
            "market_cap": N.market_cap(c("market_cap")),
            "sales": N.one_decimal(c("sales")),
            "ordinary_profit": N.one_decimal(c("ordinary_profit")),
            "net_income": N.one_decimal(c("net_income")),
            "per": N.per_display(c("per")),
            "pbr": N.one_decimal(F.regexp_replace("pbr", N.TIMES_UNIT, "")),
            "volume": N.number_without_units(c("volume")),
            "margin_ratio": N.margin_ratio_display(c("margin_ratio"), c("margin_short"), c("margin_long")),
        }
    )


# Class names and labels of the handbook page.
_PLANNED = (
    r'(?is)<div[^>]*class="[^"]*planned-disclosure-date[^"]*"[^>]*>.*?'
    r'<span[^>]*class="[^"]*date[^"]*"[^>]*>(.*?)</span>'
)
_INFO_LIST = r'(?is)<dl[^>]*class="[^"]*information__list[^"]*"[^>]*>(.*?)</dl>'
_SCORE_HEAD = (
    r'(?is)<div[^>]*class="[^"]*score__head[^"]*"[^>]*>.*?<span[^>]*class="[^"]*num[^"]*"[^>]*>(.*?)</span>'
)
_SCORE_CHART = r'(?is)<div[^>]*class="[^"]*score__chart-wrapper__main[^"]*"[^>]*>(.*)'
_ANY_DD = r"(?is)<dd[^>]*>(.*?)</dd>"
_LABELLED = r"(?is)<dt[^>]*>(.*?)</dt>\s*<dd[^>]*>(.*?)</dd>"
FEATURE_LABEL, BUSINESS_LABEL = "特色", "連結事業"
SCORE_LABELS = {
    "growth": "成長性", "profitability": "収益性", "safety": "安全性", "scale": "規模", "cheapness": "割安度",
    "upside": "値上がり",
}


def _own_text(cell: Column) -> Column:
    """Text directly inside a cell, not inside its links; all of its text when there is none of its own."""
    own = strip_tags(F.regexp_replace(cell, r"(?s)<(\w+)[^>]*>.*?</\1>", ""))
    return F.when(own.rlike(r"(?U)[^\s]"), own).otherwise(strip_tags(cell))


def _by_label(block: Column, label: str) -> Column:
    terms = F.arrays_zip(every(block, _LABELLED, 1).alias("t"), every(block, _LABELLED, 2).alias("d"))
    hit = F.filter(terms, lambda z: F.regexp_replace(F.regexp_replace(z["t"], "<[^>]*>", ""), r"(?U)\s+", "") == label)
    return F.coalesce(F.get(F.transform(hit, lambda z: z["d"]), F.size(hit) - 1), F.lit(""))


def handbook(pages: DataFrame, run_date: str) -> DataFrame:
    """One row per (code, market_class, html): ten fields by position, by label where positions are missing.

    Codes of other markets are kept with the skip text; a page with no field at all is an error.
    """
    html = F.col("html")
    blocks = {
        "_planned": first(html, _PLANNED),
        "_info": F.array_join(every(html, _INFO_LIST), "\n"),
        "_score": first(html, _SCORE_HEAD),
        "_chart": first(html, _SCORE_CHART),
    }
    cut = pages.select("code", "market_class", *[c.alias(n) for n, c in blocks.items()])
    info, chart = every(F.col("_info"), _ANY_DD), every(F.col("_chart"), _ANY_DD)
    two, six = F.size(info) >= 2, F.size(chart) >= 6
    fields = {
        "planned_date": strip_tags(F.col("_planned")),
        "feature": _own_text(F.when(two, at(info, 0)).otherwise(_by_label(F.col("_info"), FEATURE_LABEL))),
        "business": _own_text(F.when(two, at(info, 1)).otherwise(_by_label(F.col("_info"), BUSINESS_LABEL))),
        "score": strip_tags(F.col("_score")),
    }
    for k, (name, label) in enumerate(SCORE_LABELS.items()):
        fields[name] = strip_tags(F.when(six, at(chart, k)).otherwise(_by_label(F.col("_chart"), label)))
    read = _decoded_columns(cut, ["code", "market_class"], fields)
    skipped = ~F.trim("market_class").isin(*TARGET_MARKETS)
    result = (
        F.when(skipped, RESULT_SKIPPED).when(all_blank(*fields), RESULT_HANDBOOK_FAILED).otherwise(RESULT_OK)
    )
    return read.select(
        "code",
        F.lit(run_date).alias("run_date"),
        result.alias("result"),
        *[F.when(skipped, "").otherwise(F.col(n)).alias(n) for n in fields],
    )


def result_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("result").agg(F.count(F.lit(1)).alias("codes"))


def class_counts(rows: DataFrame) -> DataFrame:
    """(class, codes): what a job did with its codes, ``ok``, ``skip`` or ``error`` (any other result); a class without codes counts 0."""
    kinds = {"ok": F.col("result") == RESULT_OK, "skip": F.col("result") == RESULT_SKIPPED}
    kinds["error"] = ~F.coalesce(kinds["ok"] | kinds["skip"], F.lit(False))
    counted = rows.agg(*[F.count_if(c).alias(k) for k, c in kinds.items()])
    pairs = F.array(*[F.struct(F.lit(k).alias("class"), F.col(k).alias("codes")) for k in kinds])
    return counted.select(F.inline(pairs))


__all__ = [
    "all_blank", "basic_info", "basic_info_numbers", "class_counts", "distinct_in_order", "handbook", "result_counts",
    "tag_market", "until_blank", "wide_master", "without_blanks",
]
