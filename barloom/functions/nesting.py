"""Elements of a page cut with the nesting of their tags, where a pattern would end at the first inner end tag."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

_AT_ONCE = 64


def elements(html: Column, name: str, cls: str | None = None, outer: bool = True) -> Column:
    """Every outermost element of this name (and class token), in page order; NULL for NULL.

    Events of the standard parser tell tags from comments, scripts and attribute values. An element ends with the end tag that closes
    it, whatever of the same name it holds; one that is never closed ends with the page. ``outer`` keeps the element's own tags.
    One Arrow-batched call per expression; of a batch only ``_AT_ONCE`` pages are Python objects at a time.
    """

    @F.arrow_udf(ArrayType(StringType()))
    def cut(pages: pa.Array) -> pa.Array:
        from html.parser import HTMLParser

        class Reader(HTMLParser):
            def __init__(self, page: str):
                super().__init__(convert_charrefs=False)
                self.lines, at = [0], page.find("\n")
                while at >= 0:
                    self.lines.append(at + 1)
                    at = page.find("\n", at + 1)
                self.page, self.depth, self.found, self.open = page, 0, [], (0, 0)
                self.feed(page)
                self.close()
                if self.depth:
                    self.end(len(page), len(page))

            def place(self) -> int:
                line, column = self.getpos()
                return self.lines[line - 1] + column

            def end(self, inner: int, outside: int) -> None:
                begin, after = self.open
                self.found.append(self.page[begin:outside] if outer else self.page[after:inner])
                self.depth = 0

            def handle_starttag(self, tag: str, attrs: list) -> None:
                if tag != name:
                    return
                if self.depth:
                    self.depth += 1
                elif cls is None or cls in (dict(attrs).get("class") or "").split():
                    at = self.place()
                    self.open, self.depth = (at, at + len(self.get_starttag_text())), 1

            def handle_startendtag(self, tag: str, attrs: list) -> None:
                if not self.depth and tag == name and (cls is None or cls in (dict(attrs).get("class") or "").split()):
                    self.found.append(self.get_starttag_text() if outer else "")

            def handle_endtag(self, tag: str) -> None:
                if tag == name and self.depth:
                    self.depth -= 1
                    if not self.depth:
                        at = self.place()
                        self.end(at, self.page.find(">", at) + 1 or len(self.page))

        kind = pa.list_(pa.string())
        parts = [
            pa.array([None if p is None else Reader(p).found for p in pages.slice(lo, _AT_ONCE).to_pylist()], kind)
            for lo in range(0, len(pages), _AT_ONCE)
        ]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return cut(html)
