"""Marks elements of HTML pages: the one step that needs an HTML tokenizer.

``mark_elements(rules)`` gives an Arrow function from page text to an array of marks. A mark is one element
that matches a rule: its name, its start and end position in document order, its text, one attribute, and where the marks
inside it begin and end in the array. Which marks make up
a tag, a table row or a score block is decided by Column expressions in ``operators.html_facts``.
"""

from __future__ import annotations

from bisect import bisect_right
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

MARKS = T.ArrayType(
    T.StructType()
    .add("mark", T.StringType())
    .add("first", T.IntegerType())
    .add("last", T.IntegerType())
    .add("text", T.StringType())
    .add("attr", T.StringType())
    .add("inner", T.IntegerType())
    .add("upto", T.IntegerType())
)

# Elements without an end tag, and elements that a new one of the same group closes.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSES = {
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "li": ({"li"}, {"ul", "ol"}),
}


class Rule(NamedTuple):
    """Elements to mark: by tag, class or attribute value, only inside an element marked ``within``."""

    mark: str
    tag: str | None = None
    css_class: str | None = None
    where: tuple[str, str] | None = None
    within: str | None = None
    keep: str | None = None
    raw: bool = False


class _Marker(HTMLParser):
    def __init__(self, rules: tuple[Rule, ...]) -> None:
        super().__init__(convert_charrefs=True)
        self.rules = rules
        self.stack: list[tuple[str, list[tuple[Rule, int, int, str | None]]]] = []
        self.open: dict[str, int] = {}
        self.chunks: list[str] = [""]
        self.clock = 0
        self.found: list[dict] = []

    def handle_starttag(self, tag, attrs):
        group, limit = CLOSES.get(tag, (None, None))
        if group:
            names = [name for name, _ in self.stack]
            for depth in range(len(names) - 1, -1, -1):
                if names[depth] in limit:
                    break
                if names[depth] in group:
                    self._close_to(depth)
                    break
        self._node_boundary()
        values = {k: v or "" for k, v in reversed(attrs)}
        classes = values.get("class", "").split()
        marks = [
            (r, self.clock, len(self.chunks) - 1, values.get(r.keep) if r.keep else None)
            for r in self.rules
            if (r.tag is None or r.tag == tag)
            and (r.css_class is None or r.css_class in classes)
            and (r.where is None or values.get(r.where[0]) == r.where[1])
            and (r.within is None or self.open.get(r.within))
        ]
        for rule, *_ in marks:
            self.open[rule.mark] = self.open.get(rule.mark, 0) + 1
        self.stack.append((tag, marks))
        if tag in VOID:
            self._close_to(len(self.stack) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self._node_boundary()
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == tag:
                self._close_to(depth)
                return

    def handle_data(self, data):
        self.chunks[-1] += data

    def handle_comment(self, data):
        self._node_boundary()

    def _node_boundary(self):
        self.clock += 1
        if self.chunks[-1]:
            self.chunks.append("")

    def _close_to(self, depth):
        self._node_boundary()
        while len(self.stack) > depth:
            for rule, first, start, attr in self.stack.pop()[1]:
                self.open[rule.mark] -= 1
                pieces = self.chunks[start:]
                text = "".join(pieces) if rule.raw else " ".join(" ".join(pieces).split())
                self.found.append(
                    {"mark": rule.mark, "first": first, "last": self.clock, "text": text, "attr": attr}
                )

    def marks(self, page: str) -> list[dict]:
        self.feed(page)
        self.close()
        self._close_to(0)
        found = sorted(self.found, key=lambda m: m["first"])
        firsts = [m["first"] for m in found]
        for m in found:
            m["inner"], m["upto"] = bisect_right(firsts, m["first"]), bisect_right(firsts, m["last"])
        return found


def mark_elements(*rules: Rule):
    """Arrow function: page text to its marks in document order; null stays null."""

    @pandas_udf(MARKS)
    def mark(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: _Marker(rules).marks(page), na_action="ignore")

    return mark


