"""Scalar functions with values worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.functions import dates, numbers, text, titles


def one(spark, value, make, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(make(F.col("x")).alias("y")).collect()[0]["y"]


@pytest.mark.parametrize(
    "raw,want",
    [("1,234.5", 1234.5), (" 1 234 ", 1234.0), ("1　000", 1000.0), ("-", None), ("—", None), ("", None), ("1d", None),
     ("NaN", None), ("Infinity", None), ("1e3", 1000.0), (None, None), ("-.5", -0.5)],
)
def test_float_or_null(spark, raw, want):
    assert one(spark, raw, numbers.float_or_null) == want


@pytest.mark.parametrize(
    "raw,want", [("4,175銘柄", 4175), ("-12.9", -12), ("", 0), ("-", 0), (".", 0), ("abc", 0), ("1.2.3", 1), ("3-1", 3)]
)
def test_lenient_int(spark, raw, want):
    assert one(spark, raw, numbers.lenient_int) == want


@pytest.mark.parametrize(
    "raw,want",
    [("1兆2,345億円", 12345.0), ("987億円", 987.0), ("5,000", 5000.0), ("", None), ("億円", None), ("2兆", 20000.0), ("1.25億", 1.3)],
)
def test_market_cap(spark, raw, want):
    assert one(spark, raw, numbers.market_cap) == want


@pytest.mark.parametrize("raw,want", [("1,000株", 1000.0), ("－", 0.0), ("ー", 0.0), ("", None), ("3.5％", 3.5), ("円", 0.0), ("x", 0.0)])
def test_number_without_units(spark, raw, want):
    assert one(spark, raw, numbers.number_without_units) == want


@pytest.mark.parametrize("raw,want", [("－", "ー"), ("12.34倍", "12.3"), ("15", "15"), ("", None)])
def test_per_display(spark, raw, want):
    assert one(spark, raw, numbers.per_display) == want


@pytest.mark.parametrize("short,long_,want", [("0", "5", "ー"), ("5", "－", "ー"), ("", "", "2.5"), ("1", "1", "2.5")])
def test_margin_ratio_display(spark, short, long_, want):
    df = spark.createDataFrame([("2.46倍", short, long_)], "r string, s string, l string")
    got = df.select(numbers.margin_ratio_display(F.col("r"), F.col("s"), F.col("l")).alias("y")).collect()[0]["y"]
    assert got == want


@pytest.mark.parametrize("x,want", [(12.0, "12"), (12.5, "12.5"), (0.1234567, "0.123457"), (-3.0, "-3"), (None, None), (1e-9, "0")])
def test_plain_number(spark, x, want):
    assert one(spark, x, numbers.plain_number, "double") == want


@pytest.mark.parametrize("x,want", [(1.239, 1.23), (-1.231, -1.24), (float("inf"), None), (float("nan"), None), (None, None)])
def test_floor2(spark, x, want):
    assert one(spark, x, numbers.floor2, "double") == want


def test_ascii_digits(spark):
    assert one(spark, " １２,３45 ", numbers.ascii_digits) == "12345"


@pytest.mark.parametrize(
    "raw,want",
    [("2026-1-5", dt.date(2026, 1, 5)), ("2026/01/05", dt.date(2026, 1, 5)), ("26/1/5", dt.date(2026, 1, 5)),
     ("2026-01-05T20:00:00Z", dt.date(2026, 1, 6)), ("2026-01-05T08:00:00+09:00", dt.date(2026, 1, 5)),
     ("2026-13-05", None), ("soon", None), ("", None)],
)
def test_any_date(spark, raw, want):
    assert one(spark, raw, dates.any_date) == want


def test_market_time_does_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert one(spark, "2026-01-18T01:23:45Z", dates.market_time_text) == "2026-01-18 10:23:45"
            assert one(spark, "2026-01-18T01:23:45", dates.market_time_text) == "2026-01-18 01:23:45"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "raw,want",
    [("01/17 08:00", "2026-01-17 08:00:00"), ("12/31 23:59", "2025-12-31 23:59:00"), ("2024/05/01 07:30:15", "2024-05-01 07:30:15"),
     ("01/18 12:00", "2026-01-18 12:00:00"), ("01/18 12:01", "2025-01-18 12:01:00"), ("x", None)],
)
def test_inferred_time(spark, raw, want):
    run = F.lit("2026-01-18 12:00:30").cast("timestamp_ntz")
    assert one(spark, raw, lambda c: F.date_format(dates.inferred_time(c, run), "yyyy-MM-dd HH:mm:ss")) == want


def test_compare_days_invalid(spark):
    assert one(spark, "2026-99-01", lambda c: dates.compare_days(c, F.lit("2026-01-01"))) is None
    assert one(spark, "2026-99-01", lambda c: dates.compare_days(c, F.lit("2026-01-01"), True)) == 0


def test_date_inside(spark):
    assert one(spark, "26/02/03 15:30", dates.date_inside) == dt.date(2026, 2, 3)
    assert one(spark, "at 2026/02/03 15:30", dates.date_inside) == dt.date(2026, 2, 3)
    assert one(spark, "126/02/03", dates.date_inside) is None


@pytest.mark.parametrize(
    "raw,want",
    [("a<b>c</b> &amp; d&nbsp;&nbsp;e　f", "ac & d e f"), ("&lt;x&gt; &unknown; &#65;", "<x> &unknown; A"), (None, None), ("plain", "plain")],
)
def test_clean_text(spark, raw, want):
    assert one(spark, raw, text.clean_text) == want


def test_clean_many_keeps_order_and_blanks(spark):
    df = spark.createDataFrame([(" a&amp;b ", None, "c \n d\x01")], "a string, b string, c string")
    got = df.select(text.clean_many([F.col("a"), F.col("b"), F.col("c")]).alias("y")).collect()[0]["y"]
    assert got == ["a&b", "", "c d"]


@pytest.mark.parametrize(
    "title,company,body",
    [("A社、B：C", "A社", "B：C"), ("A:B、C", "A:B", "C"), ("X - Y-Z", "X", "Y-Z"), ("X-Y", "X", "Y"), ("plain", "", "plain"), ("A / B", "A", "B")],
)
def test_company_and_body(spark, title, company, body):
    got = one(spark, title, titles.company_and_body)
    assert (got["company"], got["body"]) == (company, body)


def test_first_keyword_follows_list_order(spark):
    assert one(spark, "今期は減益、最高益は遠い", titles.first_keyword) == "最高益"
    assert one(spark, "何もなし", titles.first_keyword) == "ー"


@pytest.mark.parametrize(
    "title,want",
    [
        ("田中が株式会社B＜7063＞株式の変更報告書を提出（保有減少）", ("保有減少", "田中", "株式会社B", "7063", "変更報告書を提出")),
        ("田中がBird<290A>株式の大量保有報告書を提出（買い増し）", ("買い増し", "田中", "Bird", "290A", "大量保有報告書を提出")),
        ("田中がBird 1234 株式の報告", ("flag", "田中", "", "Bird", "報告")),
        ("田中が佐藤＜ABCDE", ("flag", "田中", "佐藤", "ABCD", "E")),
        ("題名のみ", ("flag", "題名のみ", "", "", "")),
        ("AがBがC社＜1111＞", ("flag", "A", "BがC社", "1111", "")),
    ],
)
def test_holding_parts(spark, title, want):
    got = one(spark, title, lambda c: titles.holding_parts(c, F.lit("flag"), F.lit("u")))
    assert (got["category"], got["reporter"], got["target"], got["code"], got["content"]) == want


def test_hyperlink_cell(spark):
    df = spark.createDataFrame([('u"1', 't"2', "f"), ("u", "", "f"), ("", "t", "f"), (None, None, "f")], "u string, t string, f string")
    got = [r["y"] for r in df.select(text.hyperlink_cell(F.col("u"), F.col("t"), F.col("f")).alias("y")).collect()]
    assert got == ['=HYPERLINK("u""1","t""2")', '=HYPERLINK("u","f")', "t", "f"]


def test_absolute_link(spark):
    assert one(spark, "/a", lambda c: text.absolute_link(c, "https://s")) == "https://s/a"
    assert one(spark, "a", lambda c: text.absolute_link(c, "https://s")) == "a"
    assert one(spark, "a", lambda c: text.absolute_link(c, "https://s", True)) == "https://s/a"
    assert one(spark, "HTTP://x/a", lambda c: text.absolute_link(c, "https://s", True)) == "HTTP://x/a"
    assert one(spark, "", lambda c: text.absolute_link(c, "https://s", True)) == "https://s/"
    assert one(spark, "", lambda c: text.absolute_link(c, "https://s")) == ""
    assert one(spark, "/a/b", lambda c: text.absolute_link(c, "https://s/$1\\2")) == "https://s/$1\\2/a/b"


def test_references_are_decoded_on_arrow_arrays():
    """A batch without a reference is handed on as it is; of others only the texts with one become Python objects."""
    import pyarrow as pa

    from barloom.functions import text

    plain = pa.array(["a", None, ""], pa.string())
    assert text.html_unescape.func(plain) is plain
    assert text.html_unescape.func(pa.array(["a &amp; b", None, "&x", "c"])).to_pylist() == ["a & b", None, "&x", "c"]
