"""Text clean-up used by the extraction, listing and news jobs."""

from __future__ import annotations

import html
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .numbers import NBSP, trim

_SEP = "\x01"
_ENTITY = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")


@F.arrow_udf(StringType())
def html_unescape(s: pa.Array) -> pa.Array:
    """Decode character references; texts without an ampersand pass through untouched and never become Python objects."""
    hit = pc.fill_null(pc.match_substring(s, "&"), False)
    if not pc.any(hit).as_py():
        return s
    done = [_ENTITY.sub(lambda m: html.unescape(m.group(0)), t) for t in s.filter(hit).to_pylist()]
    return pc.replace_with_mask(s, hit, pa.array(done, s.type))


def strip_tags(s: Column) -> Column:
    return F.regexp_replace(s, "<[^>]*>", "")


def squeeze(s: Column) -> Column:
    """Every run of white space, wide blanks included, to one blank; ends trimmed."""
    return trim(F.regexp_replace(s, r"(?U)\s+", " "))


def squeeze_ascii(s: Column) -> Column:
    return trim(F.regexp_replace(s, r"[ \t\r\n]+", " "))


def cell_text(s: Column) -> Column:
    """Table cell without tags; no-break space to blank."""
    return trim(F.regexp_replace(F.regexp_replace(s, "<[^>]+>", ""), NBSP, " "))


def _decoded(s: Column) -> Column:
    return squeeze(F.regexp_replace(html_unescape(s), NBSP, " "))


def clean_text(s: Column) -> Column:
    """Tags off, references decoded, blanks squeezed."""
    return _decoded(strip_tags(s))


def clean_many(parts: list[Column]) -> Column:
    """Several texts decoded and squeezed by one call of the decoder, as an array in the same order."""
    joined = F.concat_ws(_SEP, *[F.translate(F.coalesce(p, F.lit("")), _SEP, "") for p in parts])
    return F.transform(F.split(_decoded(joined), _SEP), trim)


def without_span_tags(s: Column) -> Column:
    return F.regexp_replace(s, "<span[^>]*>|</span>", "")


def drop_span_tags(s: Column) -> Column:
    """Remove span tags, keep what they enclose."""
    return _decoded(without_span_tags(s))


def drop_spans(s: Column) -> Column:
    """Remove spans together with what they enclose."""
    return _decoded(F.regexp_replace(s, r"(?is)<span[^>]*>.*?</span>", ""))


def no_blanks(s: Column) -> Column:
    """Remove every kind of blank, so that keywords match across spacing."""
    return F.regexp_replace(s, r"(?U)\s+", "")


def hyperlink_cell(url: Column, text: Column, fallback: Column) -> Column:
    """Spreadsheet link formula; plain text when there is no link."""
    shown = F.coalesce(F.nullif(text, F.lit("")), fallback, F.lit(""))

    def doubled(c: Column) -> Column:
        return F.replace(c, F.lit('"'), F.lit('""'))

    formula = F.concat(F.lit('=HYPERLINK("'), doubled(url), F.lit('","'), doubled(shown), F.lit('")'))
    return F.when(F.coalesce(url, F.lit("")) == "", shown).otherwise(formula)


def absolute_link(href: Column, prefix: str, force_slash: bool = False) -> Column:
    """Prefix site-relative links. ``href`` stands in the expression once, as it is mostly a pattern over a whole block.

    ``force_slash`` also prefixes links that start with neither a scheme nor a slash.
    """
    if force_slash:
        href = F.regexp_replace(href, r"(?i)\A(?!https?://|/)", "/")
    return F.regexp_replace(href, r"\A(?=/)", re.sub(r"([\\$])", r"\\\1", prefix))


def short_id(time_text: Column, title: Column) -> Column:
    """First 16 hex digits of SHA-256 over time, bar and title."""
    return F.substring(F.sha2(F.concat_ws("|", time_text, title), 256), 1, 16)
