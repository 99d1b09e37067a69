"""Writers: report CSVs, and the order in which news are read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import BOM


def report_headers(df: DataFrame, fixed: dict[str, str] | None = None) -> dict[str, str]:
    """Column name to spreadsheet header, from column metadata and the given names."""
    named = {f.name: f.metadata["header"] for f in df.schema.fields if "header" in f.metadata}
    return {**named, **(fixed or {})}


def write_csv(
    df: DataFrame, path: str, headers: dict[str, str] | None = None, bom: bool = False, mode: str = "error"
) -> None:
    """CSV with a header row, missing values as empty cells, quotes doubled.

    ``bom`` puts a byte-order mark before the first header, for spreadsheet programs. The number of
    files follows the data; nothing is funnelled through one task.
    """
    names = [(headers or {}).get(c, c) for c in df.columns]
    if bom:
        names[0] = BOM + names[0]
    out = df.toDF(*names)
    out.write.mode(mode).options(header=True, escape='"', emptyValue="", nullValue="").csv(path)


def newest_first(news: DataFrame) -> DataFrame:
    """Global order by time; the id splits equal times, so no range of the sort gets too big."""
    return news.orderBy(F.desc("ts"), "id")
