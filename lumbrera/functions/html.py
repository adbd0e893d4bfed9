"""Visible text of HTML: headings, paragraphs and list items, or all text where there are none."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCKS = frozenset(("h1", "h2", "h3", "h4", "p", "li"))
DROPPED = frozenset(("script", "style", "nav", "header", "footer", "noscript"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))


class _Blocks(HTMLParser):
    """Keeps the stack of open elements; a text belongs to every open block, so nested blocks hold it once each.

    An end tag closes up to the nearest open element of its name, one without such an element is ignored.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int]] = []
        self.blocks: list[list[str]] = []
        self.loose: list[str] = []
        self.dropped = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            return
        at = -1
        if tag in DROPPED:
            self.dropped += 1
        elif tag in BLOCKS and not self.dropped:
            at = len(self.blocks)
            self.blocks.append([])
        self.open.append((tag, at))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if any(name == tag for name, _ in self.open):
            while True:
                name, _ = self.open.pop()
                self.dropped -= name in DROPPED
                if name == tag:
                    break

    def handle_data(self, data: str) -> None:
        text = data.strip()
        if text and not self.dropped:
            self.loose.append(text)
            for _, at in self.open:
                if at >= 0:
                    self.blocks[at].append(text)


def html_text(raw: str) -> str:
    parser = _Blocks()
    parser.feed(raw)
    parser.close()
    if parser.blocks:
        return "\n\n".join(" ".join(b) for b in parser.blocks if b)
    return "\n".join(parser.loose)


def from_html(raw: Column) -> Column:
    @F.pandas_udf("string")
    def parse(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else html_text(t))

    return parse(raw)
