"""Fixed schemas of the data model."""

from pyspark.sql import types as T

_S, _D = T.StringType(), T.DoubleType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _S) for n in names])


BARS = T.StructType(
    [T.StructField("code", _S, False), T.StructField("asof_date", T.DateType(), False)]
    + [T.StructField(n, _D) for n in ("open", "high", "low", "close", "volume")]
)

RAW_BARS = _strings("code", "asof_date", "open", "high", "low", "close", "volume")

PAGES = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", _S), T.StructField("html", _S)]
)

LISTING = T.StructType(
    [
        T.StructField("code", _S),
        T.StructField("name", _S),
        T.StructField("market", _S),
        T.StructField("td", T.ArrayType(_S)),
    ]
)

BASIC_INFO = _strings(
    "code", "run_date", "result", "short_name", "name", "industry", "summary", "market_cap", "listing_class",
    "sales", "ordinary_profit", "net_income", "per", "pbr", "yield", "close", "diff", "change_pct", "volume",
    "margin_date", "margin_short", "margin_long", "margin_ratio",
)

HANDBOOK = _strings(
    "code", "run_date", "result", "planned_date", "feature", "business", "score", "growth", "profitability",
    "safety", "scale", "cheapness", "upside",
)

RANKED_LIST = _strings("list", "code", "name", "market", "price", "limit_flag", "diff", "diff_pct", "base_or_amount")

NIGHT_LIST = _strings(
    "list", "code", "name", "market", "close", "limit_flag", "night_close_or_text", "diff", "diff_pct", "volume"
)

NEWS = T.StructType(
    [T.StructField("ts", T.TimestampType())] + [T.StructField(n, _S) for n in ("source", "title", "url", "id", "read")]
)
