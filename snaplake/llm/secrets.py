"""Secrets in texts, by patterns and by what a literal is assigned to.

Patterns give the base spans. Beside them every text is read as source or configuration:
assignments of all common spellings (``name = "…"``, ``name: …``, ``"name": "…"``,
``map["name"] = "…"``, ``name => …``, ``--name …``, ``#define name …``, ``<name>…</name>``,
``key="name" value="…"``) become pairs of a name and the literals in its value. A value may
also name constants, alone, in a sum or inside a string; these are followed to the literals
that they stand for, through any number of steps. A literal is scored by the most sensitive
of the names that it reaches and by its own looks; the pairs that score high enough are
added.

A text is read once from left to right, and no pattern looks back over what another has
read, so the time follows the length of the text. Rows stay where they are read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm import words
from snaplake.llm.frames import whole_text

KINDS = ["assign", "access", "hex"]
_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")

Span = tuple[int, int, int, bool]  # begin, end, kind, base


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by begin, then kind."""
    found = [(m.start(), m.end(), 0, True) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    found += [(m.start(), m.end(), 1, True) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), 2, True) for m in _HEX.finditer(text)]
    return sorted(found)


# A name with an operator behind it. Quantifiers are possessive: a word is read once.
_NAME = r"[A-Za-z_$](?:[\w$]|[.-](?=[\w$]))*+"
_SITE = re.compile(
    rf"""(?P<open><(?P<tag>{_NAME})>)
    |(?P<flag>(?<![\w-])--(?P<long>{_NAME})(?:=|[\x20\t]+))
    |(?P<define>\#[\x20\t]*define[\x20\t]+(?P<macro>{_NAME})[\x20\t]+)
    |(?P<attr>\b(?:key|name)\s*=\s*(?P<aq>["'])(?P<named>[^"'\n]++)(?P=aq)[\s,]+(?:value|default)\s*=\s*(?=["']))
    |(?:(?P<q>["'])(?P<key>[^"'\n]++)(?P=q)\]?|(?<![\w$.-])(?P<name>{_NAME}))
     (?:[\x20\t]*+:[\x20\t]*+[A-Za-z_][\w.]*+(?:\[[\w,.\x20]*+\])?+(?=[\x20\t]*=[^=>]))?+
     [\x20\t]*+(?P<op>:=|=>|\+=|=(?!=)|:(?!:))[\x20\t]*+""",
    re.X | re.A,
)
_STRING = re.compile(r"""[rRbBuUfF]{0,2}(?:"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`([^`\n]*+)`)""")
_REF = re.compile(rf"(?:\$\{{|\$|%)?({_NAME})\}}?%?", re.A)
#: A bare word ends where another name's value may begin, but for the padding of base64.
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>=&]++=*+""")
_BARE_AFTER_COLON = re.compile(r"""[^\s"'`,;(){}\[\]<>=&:]++=*+""")
_CALL = re.compile(r"[\x20\t]*+\(")
_OPEN = re.compile(r"[\x20\t]*+(?:\([\x20\t]*+(?:\n[\x20\t]*+)?+|\\\n[\x20\t]*+)?+")
_LINE_ENDS = re.compile(r"[\x20\t]*+(?=[\r\n#,;}]|//|\Z)")
_NEXT = r"[\x20\t]*+(?:\\?\n[\x20\t]*+)?+"
#: What joins terms: after a string, and after a name, where a plus needs room or a string.
_SUM = re.compile(rf"[\x20\t]*+(?:\+|\|\||&|\.{{1,2}}(?=[\x20\t\"'$])){_NEXT}")
_NAME_SUM = re.compile(rf"(?:[\x20\t]++(?:\+|\|\||&|\.{{1,2}})|\+(?=[\x20\t\"'])|\.(?=[\x20\t]*[\"'])){_NEXT}")
_BESIDE = re.compile(r"[\x20\t]*+(?:\\\n[\x20\t]*+)?+(?=[rRbBuUfF]{0,2}[\"'])")
_BELOW = re.compile(r"\s*+(?=[rRbBuUfF]{0,2}[\"'])")
_INSIDE = re.compile(rf"\$\{{({_NAME})\}}|\$({_NAME})|\{{({_NAME})\}}|%\(({_NAME})\)s", re.A)

#: Parts of names that make them sensitive, and parts that say the value is something else.
STRONG = {
    "password", "passwd", "pwd", "passphrase", "passcode", "secret", "apikey", "authtoken", "accesskey",
    "privatekey", "secretkey", "credential", "credentials", "apisecret", "accesstoken", "dbpass", "pass", "token",
}
PAIRS = {
    ("api", "key"), ("access", "key"), ("private", "key"), ("secret", "key"), ("auth", "key"), ("encryption", "key"),
    ("signing", "key"), ("client", "key"), ("account", "key"), ("storage", "key"), ("shared", "key"), ("master", "key"),
}
WEAK = {"auth", "key", "salt", "signature", "bearer", "cookie", "session", "pin", "seed", "cert", "dsn"}
HARMLESS = {
    "length", "len", "count", "size", "max", "min", "num", "type", "name", "id", "field", "label", "hint", "path",
    "file", "dir", "url", "uri", "endpoint", "host", "regex", "pattern", "format", "policy", "reset", "expiry",
    "expires", "ttl", "timeout", "limit", "limits", "public", "error", "message", "msg", "title", "text", "prompt",
    "header", "param", "env", "var", "enabled", "required", "index", "column", "primary", "foreign", "sort",
}
#: Values that stand for a secret without being one.
PLACEHOLDER = re.compile(
    r"(?i)(?:x{3,}|\*{3,}|\.{3,}|-{3,}|_{3,}|0{4,}|1234(?:5678)?)\W*\Z"
    r"|(?:<.*>|\$.*|%.*%|\{\{.*\}\}|\[.*\])\Z"
    r"|.*(?:change_?me|example|placeholder|your[_-]|dummy|redacted|replace_?me|insert|todo)"
    r"|(?:true|false|null|none|nil|undefined|string|str|int|bool|default|required|optional|yes|no|test|password|secret|token)\Z"
)
THRESHOLD = 0.6
_WORD = re.compile(r"[\w$.-]+")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def sensitivity(name: str) -> float:
    """0 to 1: how surely a name is that of a secret. Its last part says what the value is."""
    parts = [p.lower() for p in _PART.findall(name)]
    if not parts:
        return 0.0
    joined = {a + b for a, b in zip(parts, parts[1:], strict=False)}
    if parts[-1].rstrip("s") in HARMLESS or parts[-1] in HARMLESS:
        return 0.1
    strong = any(p in STRONG for p in parts) or bool(joined & STRONG)
    if strong or any(pair in PAIRS for pair in zip(parts, parts[1:], strict=False)):
        return 0.2 if "public" in parts else 1.0
    return 0.65 if any(p in WEAK for p in parts) else 0.0


def looks(value: str, quoted: bool) -> float:
    """0 to 1: how much a literal looks like a secret rather than a word, a sentence or a stand-in."""
    if len(value) < 8 or PLACEHOLDER.match(value) or (not quoted and value[:1] in "/.#&|"):
        return 0.0
    if not quoted and _WORD.fullmatch(value) and not any(c.isdigit() for c in value):
        return 0.0  # a bare word is rather a constant
    if value.count(" ") > 1 or "://" in value and "@" not in value:
        return 0.2
    kinds = sum(
        any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum())
    )
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    score = 0.15 * kinds + 0.15 * min(entropy, 4.0) + (0.1 if len(value) >= 16 else 0.0) + (0.1 if quoted else 0.0)
    if value.isalpha() and (value.islower() or value.istitle()):
        score -= 0.2 if quoted else 0.45
    return max(0.0, min(1.0, score))


@dataclass
class Pair:
    """A name, the literals of its value (begin, end, quoted), and the constants that it names."""

    name: str
    begin: int
    literals: list[tuple[int, int, bool]] = field(default_factory=list)
    names: list[str] = field(default_factory=list)


def _value(text: str, at: int, pair: Pair, colon: bool) -> int:
    """Read the terms of a value from ``at`` on into ``pair``; where to look for names next.

    That is inside the first string, or the last one of several, so none is read again and again.
    """
    start, resume = _OPEN.match(text, at), at
    beside, at = _BELOW if "(" in start[0] else _BESIDE, start.end()
    while True:
        if string := _STRING.match(text, at):
            group = string.lastindex
            pair.literals.append((*string.span(group), True))
            pair.names.extend(next(filter(None, x.groups())) for x in _INSIDE.finditer(text, *string.span(group)))
            joined = _SUM.match(text, string.end()) or beside.match(text, string.end())
            if not joined:
                return resume
            at = joined.end()
            if _STRING.match(text, at):
                resume = at
            continue
        name = _REF.match(text, at)
        if name and (joined := _NAME_SUM.match(text, name.end())):
            pair.names.append(name[1])
            at = joined.end()
            continue
        word = (_BARE_AFTER_COLON if colon else _BARE).match(text, at)
        if not word or (name and _CALL.match(text, name.end())):
            return resume  # what a function gives is not in the text
        if name and name.end() == word.end():
            pair.names.append(name[1])
        # After a colon a bare word is a value only if nothing else is on the line.
        if not pair.literals and len(pair.names) <= 1 and (not colon or _LINE_ENDS.match(text, word.end())):
            pair.literals.append((*word.span(), False))
        return resume


def pairs(text: str) -> list[Pair]:
    """The assignments of a text, in order."""
    found, at = [], 0
    while m := _SITE.search(text, at):
        group = next(g for g in ("tag", "long", "macro", "named", "key", "name") if m[g] is not None)
        pair = Pair(m[group], m.start(group))
        at = m.end()
        if group == "tag":
            end = text.find("<", at)
            if end >= 0 and text.startswith(f"</{m['tag']}>", end) and "\n" not in text[at:end].strip():
                pair.literals.append((at, end, True))
        else:
            at = _value(text, at, pair, m["op"] == ":")
        if pair.literals or pair.names:
            found.append(pair)
    return found


def reached(found: list[Pair]) -> list[float]:
    """For each pair, the greatest sensitivity among its own name and those its value reaches.

    A constant stands for the last value given to it before it is used, or the first after.
    """
    defined: dict[str, list[int]] = {}
    for i, pair in enumerate(found):
        defined.setdefault(pair.name.rpartition(".")[2], []).append(i)
    most = [sensitivity(p.name) for p in found]
    for i in sorted(range(len(found)), key=lambda i: -most[i]):
        waiting = [i]
        while waiting:
            j = waiting.pop()
            for name in found[j].names:
                places = defined.get(name.rpartition(".")[2])
                if not places:
                    continue
                k = places[max(bisect_left(places, j) - 1, 0)]
                if k != j and most[k] < most[i]:
                    most[k] = most[i]
                    waiting.append(k)
    return most


def added_spans(text: str, base: list[Span], threshold: float = THRESHOLD) -> list[Span]:
    """Pairs whose literal is a secret by name and looks; not where base spans hold the whole literal."""
    found = pairs(text)
    constants = {p.name.rpartition(".")[2] for p in found}
    covered: list[tuple[int, int]] = []
    for begin, end, _, _ in base:  # in order of begin
        if covered and begin <= covered[-1][1]:
            covered[-1] = (covered[-1][0], max(end, covered[-1][1]))
        else:
            covered.append((begin, end))
    begins = [b for b, _ in covered]
    out: set[Span] = set()
    for pair, sensitive in zip(found, reached(found), strict=True):
        if sensitive < threshold:
            continue
        value = "".join(text[a:b] for a, b, _ in pair.literals)
        quoted = any(q for _, _, q in pair.literals)
        if sensitive * looks(value, quoted) < threshold or (not quoted and value in constants):
            continue
        for i, (a, b, _) in enumerate(pair.literals):
            at = bisect_left(begins, a + 1) - 1
            if b > a and not (at >= 0 and covered[at][1] >= b):
                out.add((a if i else pair.begin, b, 0, False))
    return sorted(out)


SPANS = "spans array<struct<begin:bigint,end:bigint,kind:int,base:boolean>>"


def find_secrets(
    docs: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id`` and ``spans``, a row per document.

    ``spans`` is an array of (begin, end, kind, name, base) in code points, end exclusive, by
    begin, then kind as in KINDS: all base spans, and as ``assign`` the pairs that are added,
    from their name to the end of the literal (from the literal's begin for a further literal
    of one value). An added span may overlap a base span that does not hold its literal. A
    missing text is an empty one and has none; rows that repeat or miss their id are rows of
    their own; other columns are not read; an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            spans = []
            for value in batch.column("text").to_pylist():
                base = base_spans(value)
                both = sorted(base + added_spans(value, base, threshold), key=lambda s: (s[0], s[2], s[1], not s[3]))
                spans.append([dict(zip(("begin", "end", "kind", "base"), s, strict=True)) for s in both])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, _SPANS)], ["doc_id", "spans"])

    lean = docs.select(F.col(doc_id).alias("doc_id"), whole_text(F.col(text)).alias("text"))
    kind_of = lean.schema["doc_id"].dataType.simpleString()
    found = lean.mapInArrow(run, f"doc_id {kind_of}, {SPANS}")
    name = F.array(*(F.lit(k) for k in KINDS))
    return found.select(
        "doc_id",
        F.transform(
            "spans",
            lambda s: F.struct(
                s["begin"].alias("begin"),
                s["end"].alias("end"),
                s["kind"].alias("kind"),
                F.get(name, s["kind"]).alias("name"),
                s["base"].alias("base"),
            ),
        ).alias("spans"),
    )


_SPANS = pa.list_(
    pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("base", pa.bool_())])
)


def named(spans: Column) -> Column:
    """``kind:begin:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["begin"].cast("string"), s["end"].cast("string"))),
        ",",
    )
