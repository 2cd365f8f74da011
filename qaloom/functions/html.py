"""HTML to text. The parser is the standard library's, in an Arrow-fed pandas UDF; native() is for plain markup."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import flatten_lines, paragraph_lines

#: Entities that native() knows. Fixed values.
ENTITIES = {"&quot;": '"', "&copy;": "©", "&middot;": "·", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


class _Text(HTMLParser):
    def __init__(self, structured: bool):
        super().__init__(convert_charrefs=True)
        self.structured, self.parts, self.hidden, self.open_p = structured, [], None, 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hidden = tag
        elif self.structured and tag == "br":
            self.parts.append("\n")
        elif self.structured and tag == "p":
            self.open_p += 1

    def handle_endtag(self, tag):
        if tag == self.hidden:
            self.hidden = None
        elif self.structured and tag == "p" and self.open_p:
            self.open_p -= 1
            self.parts.append("\n\n")

    def handle_data(self, data):
        if self.hidden is None:
            self.parts.append(data)


def parse(markup: str, structured: bool = False) -> str:
    """The text nodes outside script and style; with structure, paragraphs end in two newlines and breaks in one."""
    reader = _Text(structured)
    reader.feed(markup)
    reader.close()
    return "".join(reader.parts) + "\n\n" * reader.open_p


def _safe(markup: str | None, structured: bool) -> str | None:
    if markup is None:
        return None
    try:
        return parse(markup, structured)
    except Exception:  # a page that the parser can't read stays as it is
        return markup


@F.pandas_udf(StringType())
def html_plain(markup: pd.Series) -> pd.Series:
    return markup.map(lambda m: _safe(m, False), na_action=None)


@F.pandas_udf(StringType())
def html_structured(markup: pd.Series) -> pd.Series:
    return markup.map(lambda m: _safe(m, True), na_action=None)


def html_text(markup: Column) -> Column:
    """One line of text."""
    return flatten_lines(html_plain(markup))


def html_paragraphs(markup: Column) -> Column:
    """Text whose paragraphs are parted by newlines."""
    return paragraph_lines(html_structured(markup))


def native(markup: Column) -> Column:
    """html_text without Python, for pages with matched script and style tags and the entities above."""
    text = markup
    # what nothing closes runs to the end, so each character is looked at a few times only
    for pattern in (r"(?is)<script\b.*?(?:</script\s*+>|\z)", r"(?is)<style\b.*?(?:</style\s*+>|\z)", r"(?s)<!--.*?(?:-->|\z)", r"<[!/a-zA-Z][^>]*+(?:>|\z)"):
        text = F.regexp_replace(text, pattern, "")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return flatten_lines(text)
