"""Fields and metric tiles out of whole page markup.

Label and value of a page sit in nested elements that patterns cannot pair up
reliably, so this one step runs in Python: an Arrow-batched function over the
markup column alone. Which elements to read is data (see ``fixed``); everything
after it is columns again.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections import Counter
from collections.abc import Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.fixed import METRIC_LABEL, METRIC_TILE, METRIC_VALUE, METRICS_CONTAINER

# Executors need no copy of this package: the parser travels with the function.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
# Elements that a start tag ends if they are open, and what keeps it from looking further out.
_TABLE = ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption")
_SCOPE = ("td", "th", "table", "button", "caption")
_IMPLIED = {
    "li": (("p", "li"), ("ul", "ol", *_SCOPE)),
    "dt": (("p", "dt", "dd"), ("dl", *_SCOPE)),
    "dd": (("p", "dt", "dd"), ("dl", *_SCOPE)),
    "option": (("option",), ("select", "datalist")),
    **{cell: (("td", "th"), ("table",)) for cell in ("td", "th")},
    "tr": (("tr",), ("table",)),
    **{part: (("thead", "tbody", "tfoot"), ("table",)) for part in ("thead", "tbody", "tfoot")},
}
_BLOCKS = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
Rule = Mapping[str, object]


class _Page(HTMLParser):
    """Elements of a page in document order, with the span of their text."""

    def __init__(self, markup: str) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.size = 0
        self.elements: list[dict] = []
        self.by_tag: dict[str, list[int]] = {}
        self.open: list[int] = []
        self.open_tags: Counter[str] = Counter()
        self.feed(markup)
        self.close()
        self._finish(0)
        self.whole = "".join(self.pieces)
        self.found: dict[str, list[int]] = {}
        self.under: dict[tuple, list[bool]] = {}

    def handle_starttag(self, tag, attrs):
        self._close_implied(tag)
        values = {k: v or "" for k, v in attrs}
        at = len(self.elements)
        self.elements.append(
            {
                "tag": tag,
                "cls": values.get("class", ""),
                "attrs": values,
                "parent": self.open[-1] if self.open else -1,
                "own": [],
                "first": self.size,
                "last": self.size,
                "end": at + 1,
            }
        )
        self.by_tag.setdefault(tag, []).append(at)
        if tag not in _VOID:
            self.open.append(at)
            self.open_tags[tag] += 1

    def _close_implied(self, tag: str) -> None:
        """Close what a page may leave open before ``tag``, as HTML defines."""
        ends, scope = _IMPLIED.get(tag, (("p",), _SCOPE) if tag in _BLOCKS else ((), ()))
        for ended in ends:
            if not self.open_tags[ended]:
                continue
            for depth in range(len(self.open) - 1, -1, -1):
                name = self.elements[self.open[depth]]["tag"]
                if name == ended:
                    self._finish(depth)
                    break
                if name in scope:
                    break

    def handle_endtag(self, tag):
        if not self.open_tags[tag]:
            return
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.elements[self.open[depth]]["tag"]
            if name == tag:
                self._finish(depth)
                return
            if name in ("td", "th") and tag not in _TABLE:
                return

    def handle_data(self, data):
        self.pieces.append(data)
        self.size += len(data)
        if self.open:
            self.elements[self.open[-1]]["own"].append(data)

    def _finish(self, depth: int) -> None:
        for at in self.open[depth:]:
            element = self.elements[at]
            element["last"], element["end"] = self.size, len(self.elements)
            self.open_tags[element["tag"]] -= 1
        del self.open[depth:]

    def text(self, at: int) -> str:
        element = self.elements[at]
        return self.whole[element["first"] : element["last"]]

    def holds(self, at: int, part: str) -> bool:
        """Whether the element's text has ``part``; the page is searched for it once."""
        if part not in self.found:
            places, place = [], self.whole.find(part)
            while place >= 0:
                places.append(place)
                place = self.whole.find(part, place + 1)
            self.found[part] = places
        places, element = self.found[part], self.elements[at]
        next_ = bisect_left(places, element["first"])
        return next_ < len(places) and places[next_] + len(part) <= element["last"]

    def own_holds(self, at: int, parts: Sequence[str]) -> bool:
        own = "".join(self.elements[at]["own"])
        return any(part in own for part in parts)

    def has_above(self, at: int, cls: Sequence[str], part: str) -> bool:
        """Whether some ancestor has the class parts and the text; found for all at once."""
        key = (*cls, part)
        if key not in self.under:
            flags: list[bool] = []
            for element in self.elements:
                up = element["parent"]
                flags.append(up >= 0 and (flags[up] or (self._is(up, "", cls) and self.holds(up, part))))
            self.under[key] = flags
        return self.under[key][at]

    def _is(self, at: int, tag: str, cls: Sequence[str]) -> bool:
        element = self.elements[at]
        return (not tag or element["tag"] == tag) and all(c in element["cls"] for c in cls)

    def matching(self, tag: str, cls: Sequence[str], start: int = 0, end: int | None = None):
        end = len(self.elements) if end is None else end
        at_all = self.by_tag.get(tag, []) if tag else range(len(self.elements))
        for i in range(bisect_left(at_all, start), len(at_all)):
            if at_all[i] >= end:
                return
            if self._is(at_all[i], tag, cls):
                yield at_all[i]

    def _holders(self, tag: str, cls: str, n: int):
        """Elements that are the n-th such child of their parent."""
        seen: Counter[int] = Counter()
        for at in self.matching(tag, [cls]):
            parent = self.elements[at]["parent"]
            seen[parent] += 1
            if seen[parent] == n:
                yield at

    def _labels(self, cls: str, text: str):
        for at in self.matching("div", [cls]):
            if self.holds(at, text) if cls else self.own_holds(at, [text]):
                yield at

    def _places(self, rule: Rule):
        """The elements, in order, that the rule may mean by where they are."""
        tag, cls = rule["tag"], rule.get("cls", ())
        if "inside" in rule:
            for holder in self._holders(*rule["inside"]):
                for at in self.matching(tag, cls, holder, self.elements[holder]["end"]):
                    if not rule.get("child") or self.elements[at]["parent"] == holder:
                        yield at
            return
        start = 0
        if "after" in rule or "sibling" in rule:
            label = next(self._labels(*rule.get("after", rule.get("sibling"))), None)
            if label is None:
                return
            start = self.elements[label]["end"]
        if "sibling" in rule:
            yield from self._siblings(label, start, rule)
            return
        yield from self.matching(tag, cls, start)

    def _siblings(self, label: int, start: int, rule: Rule):
        """The next element beside the label, or an earlier one that has the class part ``beside``."""
        parent = self.elements[label]["parent"]
        begin, end = (parent + 1, self.elements[parent]["end"]) if parent >= 0 else (0, len(self.elements))
        for at in self.matching(rule["tag"], (), begin, end):
            if self.elements[at]["parent"] == parent and (
                at >= start or ("beside" in rule and rule["beside"] in self.elements[at]["cls"])
            ):
                yield at
                return

    def _fits(self, at: int, rule: Rule) -> bool:
        if "has" in rule and rule["has"] not in self.elements[at]["attrs"].get(rule["attr"], ""):
            return False
        if "own" in rule and not self.own_holds(at, rule["own"]):
            return False
        if "text" in rule and not any(self.holds(at, t) for t in rule["text"]):
            return False
        return "within" not in rule or self.has_above(at, rule["within"], rule.get("within_text", ""))

    def find(self, rule: Rule) -> str | None:
        for at in self._places(rule):
            if not self._fits(at, rule):
                continue
            if "part" in rule:
                at = next(self.matching("div", [rule["part"]], at + 1, self.elements[at]["end"]), None)
                if at is None:
                    return None
            if "attr" in rule:
                return self.elements[at]["attrs"].get(rule["attr"])
            return self.text(at).strip()
        return None

    def metrics(self) -> list[dict[str, str]]:
        found = []
        for box in self.matching("div", [METRICS_CONTAINER]):
            for tile in self.matching("div", [METRIC_TILE], box + 1, self.elements[box]["end"]):
                end = self.elements[tile]["end"]
                holder, inner = METRIC_LABEL
                labels = [
                    at
                    for label in self.matching("div", [holder], tile + 1, end)
                    for at in self.matching("div", [inner], label + 1, self.elements[label]["end"])
                ]
                values = list(self.matching("div", [METRIC_VALUE], tile + 1, end))
                if labels and values:
                    found.append({"label": self.text(labels[0]).strip(), "value": self.text(values[0])})
        return found


def parse(markup: Column, rules: Sequence[Rule], metrics: bool = False) -> Column:
    """A struct with one text per rule (NULL where nothing fits) and, with
    ``metrics``, the page's metric tiles in order as label and raw value."""
    fields = [rule["field"] for rule in rules]
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    if metrics:
        tile = T.StructType([T.StructField(n, T.StringType()) for n in ("label", "value")])
        schema = schema.add("metrics", T.ArrayType(tile))

    def read(text: str | None) -> dict[str, object]:
        page = _Page(text or "")
        row: dict[str, object] = {rule["field"]: page.find(rule) for rule in rules}
        if metrics:
            row["metrics"] = page.metrics()
        return row

    @F.pandas_udf(schema)
    def read_batch(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read(t) for t in texts], columns=schema.fieldNames())

    # Parsing is dear. Marked so, it is not repeated for a filter on its result.
    return read_batch.asNondeterministic()(markup)


def metric(metrics: Column, label: str) -> Column:
    """The last value a page shows under a label; NULL when it has none."""
    mine = F.filter(metrics, lambda m: m["label"] == label)
    return F.try_element_at(mine, F.lit(-1))["value"]
