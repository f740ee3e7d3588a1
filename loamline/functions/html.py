"""HTML: titles, links and visible text."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Elements whose text isn't content, and the least length of a page's text.
SKIPPED = ("script", "style", "nav", "footer", "header", "svg", "noscript", "form")
LEAST = 200


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.depth = 0
        self.body = False

    def handle_starttag(self, tag: str, attrs) -> None:
        self.body |= tag == "body"
        self.depth += tag in SKIPPED

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIPPED and self.depth:
            self.depth -= 1

    def handle_data(self, data: str) -> None:
        if self.body and not self.depth and (text := data.strip()):
            self.parts.append(text)


def body_text(html: str | None) -> str | None:
    if html is None:
        return None
    parser = _Text()
    parser.feed(html)
    parser.close()
    return "\n".join(parser.parts)


@F.pandas_udf(StringType())
def text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Text nodes of the body outside SKIPPED, one a line."""
    for pages in parts:
        yield pages.map(body_text, na_action=None)


#: Extractors by name; another, such as one for main content, may be put in.
EXTRACTORS: dict[str, Callable[[Column], Column]] = {"default": text}


def title(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))


def links(html: Column) -> Column:
    """Distinct href values without fragments, sorted."""
    found = F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*"([^"]*)\""""), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, lambda x: F.regexp_replace(x, "#.*$", "")), lambda x: x != "")))


def links_under(html: Column, prefix: Column) -> Column:
    return F.filter(links(html), lambda x: x.startswith(prefix))
