"""Personal data: loose generators propose spans, boosted trees choose among them.

Strict rules give the base spans. Loose rules propose more, overlapping each other
and the base: a card is proposed from each group of digits to each end of a group. Gradient boosted trees learn to tell base spans, their marks taken off, from
candidates that fail a checksum or range; they see the shape of the span and its context
but not what the strict rules test (checksums, a leading plus, an at sign, ranges). A loose
proposal that passes those tests and meets no base span is neither: it is what the trees
are asked about. The trees learn from a bounded sample of each kind; all held-out candidates
of the table that are known to be right or wrong give each kind the lowest score at which
they are nearly always right; proposals above it are added. All of it is DataFrame work; no
row passes through Python.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.frames import dropped, staged, whole_text

KINDS = ["email", "ip", "card", "phone"]
# Runs are possessive and begin where one may, which finds the same matches in linear time.
_MAIL = r"[A-Za-z0-9._%+-]"
STRICT = {
    "email": rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT, _DOT = r"(?:\s?@\s?|\s?[(\[]at[)\]]\s?|\sat\s)", r"(?:\.|\s?[(\[]dot[)\]]\s?|\sdot\s)"
LOOSE = {
    "email": rf"(?<!{_MAIL}){_MAIL}++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:[.,:][0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?=(?:[\x20./-]?[0-9]){12})",
    "phone": r"(?<![0-9])\(?[0-9]{1,4}+\)?(?:[\x20./-]{1,2}+\(?[0-9]{2,4}+\)?){2,4}(?![0-9])",
}
#: A loose card begins at any group of digits and ends at any: the pattern finds the begins, and
#: these, of the first sign and what follows it, a span for each number of digits that ends a group.
_JOINT = r"[\x20./-]"
_CARD_SIGNS = 19 + 18
_CARD_ENDS = [rf"^[0-9](?:[\x20./-]?[0-9]){{{n - 1}}}(?![0-9])" for n in range(13, 20)]
#: A text without any of these has no candidate of the kind; a cheap test before the patterns.
NEEDS = {"email": "(?i)@|[(\\[\\s]at[)\\]\\s]", "ip": "[0-9][.,:][0-9]", "card": "[0-9]", "phone": "[0-9]"}
_ADDRESS = (
    r"^(?!\.)(?![^@]*\.[.@])[^@]{1,64}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])$"
)
_Y, _M, _D = "(?:19|20)[0-9]{2}", "(?:0?[1-9]|1[0-2])", "(?:0?[1-9]|[12][0-9]|3[01])"
_DATE = rf"^(?:{_Y}([ .-]){_M}\1{_D}|{_D}([ .-]){_M}\2{_Y}|{_M}([ .-]){_D}\3{_Y})(?![0-9])"
CONTEXT = 32
_HINT = r"(?i)\b(mail|e-mail|contact|write|ip|host|server|address|card|visa|pay|phone|tel|call|fax|mobile)\b"


def _matches(text: Column, kind: str, pattern: str, strict: bool) -> Column:
    """Each match with the length of the gap before it and its context, which other matches do not cut."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    ahead = CONTEXT if strict or kind != "card" else CONTEXT + _CARD_SIGNS - 1  # room for the card itself

    def pieces(x: Column, cut: Callable[[Column, Column], Column]) -> Column:
        """Gaps and matches in turn, as much of each as a context may hold."""
        matches = F.concat(x["found"], F.array(F.lit("")))
        return F.flatten(
            F.zip_with(x["gaps"], matches, lambda g, m: F.array(cut(g, F.lit(ahead)), cut(m, F.lit(ahead))))
        )

    # The gaps are named once per row, not split again for each match; so are the pieces.
    # Matches are not empty, so 2 * ahead + 1 pieces are enough.
    named_gaps = F.array(F.struct(found.alias("found"), gaps.alias("gaps")))
    with_pieces = F.transform(
        named_gaps,
        lambda x: F.struct(
            x["found"].alias("found"),
            x["gaps"].alias("gaps"),
            pieces(x, F.left).alias("lefts"),
            pieces(x, F.right).alias("rights"),
        ),
    )
    most = 2 * ahead + 1
    with_gaps = F.transform(
        with_pieces,
        lambda x: F.transform(
            x["found"],
            lambda match, at: F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                F.lit(strict).alias("strict"),
                at.alias("nth"),
                F.char_length(F.get(x["gaps"], at)).alias("gap"),
                match.alias("match"),
                F.right(
                    F.array_join(
                        F.slice(
                            x["rights"], F.greatest(2 * at + 2 - most, F.lit(1)), F.least(2 * at + 1, F.lit(most))
                        ),
                        "",
                    ),
                    F.lit(CONTEXT),
                ).alias("before"),
                F.left(F.array_join(F.slice(x["lefts"], 2 * at + 3, F.lit(most)), ""), F.lit(ahead)).alias("after"),
            ),
        ),
    )
    return F.when(F.regexp_like(text, F.lit(NEEDS[kind])), F.flatten(with_gaps))


def _cards_ended(placed: DataFrame) -> DataFrame:
    """``placed`` with the spans of loose cards, seven at most, in place of their first digits."""
    begun = (F.col("kind") == KINDS.index("card")) & ~F.col("strict")
    signs = F.concat("match", "after")
    ended = F.filter(F.array(*(F.regexp_extract(signs, end, 0) for end in _CARD_ENDS)), lambda x: x != "")
    whole = placed.withColumn("span", F.explode(F.when(begun, ended).otherwise(F.array("match"))))
    rest = F.substring(signs, F.length("span") + 1, F.lit(CONTEXT))
    return whole.withColumns(
        {
            "after": F.when(begun, rest).otherwise(F.col("after")),
            "match": F.col("span"),
            "end": F.col("begin") + F.length("span"),
        }
    ).drop("span")


def _unmarked(kind: Column, before: Column, after: Column) -> tuple[Column, Column]:
    """The context without a plus before a phone, and without one or two short groups of digits
    at a card: a strict card ends where digits do, a loose one may have a date or code beside it."""
    return (
        F.when(kind == 3, F.rtrim(before, F.lit("+")))
        .when(kind == 2, F.regexp_replace(before, rf"(?<![0-9])(?:[0-9]{{1,4}}{_JOINT}){{1,2}}$", ""))
        .otherwise(before),
        F.when(kind == 2, F.regexp_replace(after, rf"^(?:{_JOINT}[0-9]{{1,4}}){{1,2}}(?![0-9])", "")).otherwise(after),
    )


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Every second digit from the right counts double, as the sum of its digits."""
    reversed_ = F.split(F.reverse(digits), "")
    value = F.transform(
        reversed_,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")
        ),
    )
    return F.aggregate(value, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    """What a strict match must also meet."""
    digits = _digits(match)
    parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    in_range = F.forall(
        parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)
    )
    return (
        F.when(kind == 0, True)
        .when(kind == 1, in_range)
        .when(kind == 2, F.length(digits).between(16, 19) & passes_luhn(digits))
        .otherwise(F.length(digits).between(8, 15))
    )


def _plain(kind: Column, match: Column) -> Column:
    """A candidate as strict rules would write it, without the marks that they ask for."""
    mail = F.regexp_replace(F.regexp_replace(match, _AT, "@"), _DOT, ".")
    return (
        F.when(kind == 0, mail)
        .when(kind == 1, F.regexp_replace(match, "[,:]", "."))
        .when(kind == 2, F.regexp_replace(match, "[./]", "-"))
        .otherwise(F.regexp_replace(F.ltrim(match, F.lit("+")), "/", "-"))
    )


def _possible(kind: Column, plain: Column) -> Column:
    """What a loose proposal must meet, so as not to be known to be wrong.

    An address has a name, host and top-level domain of lawful form, numbers are in range,
    a card of 13 to 19 digits passes its checksum, and a phone does not read as a date.
    """
    digits = _digits(plain)
    return (
        F.when(kind == 0, F.regexp_like(plain, F.lit(_ADDRESS)))
        .when(kind == 1, _valid(kind, plain))
        .when(kind == 2, F.length(digits).between(13, 19) & passes_luhn(digits))
        .otherwise(F.length(digits).between(8, 15) & ~F.regexp_like(plain, F.lit(_DATE)))
    )


def _count(pattern: str, text: str = "plain") -> Column:
    return F.regexp_count(F.col(text), F.lit(pattern)).cast("double")


def _features() -> dict[str, Column]:
    """Shape and context of a candidate; none of the strict rules' own tests or marks."""
    first, last = F.left("after", F.lit(1)), F.right("before", F.lit(1))
    groups = F.transform(F.regexp_extract_all("plain", F.lit("[0-9]+"), F.lit(0)), F.length)
    return {
        **{f"is_{k}": (F.col("kind") == i).cast("double") for i, k in enumerate(KINDS)},
        "letters": _count("[A-Za-z]"),
        "groups": F.size(groups).cast("double"),
        "longest": F.coalesce(F.array_max(groups), F.lit(0)).cast("double"),
        "shortest": F.coalesce(F.array_min(groups), F.lit(0)).cast("double"),
        "dots": _count(r"\."),
        "dashes": _count("-"),
        "spaces": _count(r"\s"),
        "brackets": _count(r"[()\[\]]"),
        "space_before": last.rlike(r"\s").cast("double"),
        "word_before": last.rlike(r"[\p{L}0-9]").cast("double"),
        "starts": (F.col("before") == "").cast("double"),
        "space_after": first.rlike(r"\s").cast("double"),
        "word_after": first.rlike(r"[\p{L}0-9]").cast("double"),
        "ends": (F.col("after") == "").cast("double"),
        "hint": _count(_HINT, "before"),
        "digits_near": _count("[0-9]", "before") + _count("[0-9]", "after"),
        "quotes_near": _count("[\"'=]", "before"),
    }


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, list[str]]:
    """All rows (``row``, ``doc_id``), their candidates, and the folders these are kept in.

    A candidate has ``kind``, ``begin``, ``end``, ``strict``, ``base``, ``covered`` (it meets
    a base span of any kind), ``label`` and its features. The label is 1 for a base span, 0 for
    what fails the tests of its kind and meets no base span of it, and missing for all else.
    """
    whole = whole_text(F.col(text))
    proposed = F.concat(
        *(
            F.coalesce(_matches(F.col("text"), kind, rules[kind], rules is STRICT), F.array())
            for rules in (STRICT, LOOSE)
            for kind in KINDS
        )
    )
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text")).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), proposed.alias("found")
    )
    rows, rows_path = staged(rows, "pii-rows")

    flat = rows.where(F.size("found") > 0).select("row", F.explode("found").alias("x")).select("row", "x.*")
    so_far = Window.partitionBy("row", "kind", "strict").orderBy("nth")
    placed = flat.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(so_far)).withColumn(
        "begin", F.col("end") - F.length("match")
    )
    placed = _cards_ended(placed).withColumn("base", F.col("strict") & _valid(F.col("kind"), F.col("match")))

    def meets_base(*scope: str) -> Column:
        """Whether a base span within the same ``scope`` overlaps the candidate.

        Both frames end at the current row, one of them in reverse order: Spark keeps a running
        value for such a frame, and goes over the rest again for each row of one that begins there.
        """
        so_far = Window.partitionBy(*scope).rowsBetween(Window.unboundedPreceding, 0)
        onward = so_far.orderBy("begin", F.desc("base"), "end", "kind", "strict")
        back = so_far.orderBy(F.desc("begin"), "base", F.desc("end"), F.desc("kind"), F.desc("strict"))
        ended = F.max(F.when(F.col("base"), F.col("end"))).over(onward)
        next_ = F.min(F.when(F.col("base"), F.col("begin"))).over(back)
        return F.coalesce(ended > F.col("begin"), F.lit(False)) | F.coalesce(next_ < F.col("end"), F.lit(False))

    label = F.when(F.col("base"), 1.0).when(~F.col("met") & ~F.col("possible"), 0.0)
    described = (
        placed.withColumn("met", meets_base("row", "kind"))
        .withColumn("covered", meets_base("row"))
        .withColumn("plain", _plain(F.col("kind"), F.col("match")))
        .withColumns(dict(zip(("before", "after"), _unmarked(*map(F.col, ("kind", "before", "after"))), strict=True)))
        .withColumn("possible", ~F.col("strict") & _possible(F.col("kind"), F.col("plain")))
        .withColumn("label", label)
        .where(F.col("label").isNotNull() | ~F.col("covered"))  # the others are neither learnt from nor added
        .select(
            *("row", "kind", "begin", "end", "strict", "base", "covered", "label"),
            *(c.alias(n) for n, c in _features().items()),
        )
    )
    described, path = staged(described, "pii-candidates")
    return rows.select("row", "doc_id"), described, [rows_path, path]


def _scored(model: GBTClassificationModel, found: DataFrame) -> DataFrame:
    vector = VectorAssembler(inputCols=list(_features()), outputCol="features")
    return model.transform(vector.transform(found)).withColumn(
        "score", vector_to_array("probability")[1]
    )


def train(found: DataFrame, rows: int = 20_000, right: float = 0.95, bins: int = 50) -> tuple[GBTClassificationModel | None, dict[int, float]]:
    """Boosted trees and, by kind, the score from which proposals are taken.

    Only labelled candidates count. One in four, by hash, is held out. The trees learn from
    about ``rows`` of the others, in even shares for each kind, label and sort of pattern, so
    what is frequent does not take the places of what is rare. Thresholds come from all
    held-out candidates of the table: a kind's is the lowest bin of scores from which on a
    share of ``right`` or more of them, and half of the bin's own, are base spans. Without
    candidates of both labels there is no model.
    """
    place = F.xxhash64("row", "kind", "strict", "begin", "end")
    known = found.where(F.col("label").isNotNull()).withColumn("held", place % 4 == 0)
    seen, held = known.where(~F.col("held")), known.where("held")
    groups = ["kind", "label", "strict"]
    sizes = seen.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).collect()  # twelve rows at most
    if len({r["label"] for r in sizes}) < 2:
        return None, {}
    share = F.coalesce(
        *(
            F.when(reduce(and_, (F.col(g) == r[g] for g in groups)), F.lit(rows / len(sizes) / r["n"]))
            for r in sizes
        )
    )
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "row", "kind", "strict", "begin", "end"), F.lit(1 << 40)) / (1 << 40)
    some, path = staged(seen.where(drawn < share), "pii-sample")
    if some.select("label").distinct().count() < 2:
        return None, {}
    vector = VectorAssembler(inputCols=list(_features()), outputCol="features")
    model = GBTClassifier(
        maxIter=10, maxDepth=4, stepSize=0.3, seed=1, checkpointInterval=-1, minInstancesPerNode=5
    ).fit(vector.transform(some).select("features", "label"))
    by_bin = (
        _scored(model, held)
        .groupBy("kind", F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("base"))
        .collect()
    )
    thresholds: dict[int, float] = {}
    for kind in range(len(KINDS)):
        n = base = 0.0
        for row in sorted((r for r in by_bin if r["kind"] == kind), key=lambda r: -r["bin"]):
            n, base = n + row["n"], base + row["base"]
            if base >= right * n and 2 * row["base"] >= row["n"]:
                thresholds[kind] = row["bin"] / bins
    dropped(found, path)
    return model, thresholds


def find_personal_data(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    model: tuple[GBTClassificationModel | None, dict[int, float]] | None = None,
) -> DataFrame:
    """``doc_id`` and ``spans``, a row per document.

    ``spans`` is an array of (kind, begin, end, name, base), in code points, end
    exclusive, by kind as in KINDS, then begin: all base spans, and the proposals that the model adds (it is
    trained on these documents if none is given). A proposal that meets a base span of any
    kind is not listed beside it, nor is one that fails a checksum or range. A missing text is empty; rows that repeat or miss their
    id are rows of their own; other columns are not read; an empty table gives an
    empty one.
    """
    rows, found, _ = candidates(docs, doc_id, text)
    trees, thresholds = model or train(found)
    chosen = found.where("base").select("row", "kind", "begin", "end", "base")
    if trees is not None and thresholds:
        least = F.coalesce(
            *(F.when(F.col("kind") == k, F.lit(t)) for k, t in thresholds.items()), F.lit(2.0)
        )
        added = _scored(trees, found.where(~F.col("covered") & F.col("label").isNull())).where(F.col("score") >= least)
        chosen = chosen.unionByName(added.select("row", "kind", "begin", "end", "base").distinct())
    name = F.get(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    span = F.struct("kind", "begin", "end", name.alias("name"), "base")
    spans = chosen.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    return rows.join(spans, "row", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans")
    )


def named(spans: Column) -> Column:
    """``kind:begin:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["begin"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redacted(text: Column, spans: Column, mark: str = "█") -> Column:
    """The text with every sign inside a span replaced; spans may overlap."""
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"))))
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, span: Column) -> Column:
        begin, end = F.greatest(span["begin"], state["at"]), F.greatest(span["end"], state["at"])
        plain = F.substring(text, (state["at"] + 1).cast("int"), (begin - state["at"]).cast("int"))
        return F.struct(
            F.concat(state["done"], plain, F.repeat(F.lit(mark), (end - begin).cast("int"))).alias("done"),
            end.alias("at"),
        )

    rest = F.char_length(text)
    return F.aggregate(
        by_place, start, step, lambda s: F.concat(s["done"], F.substring(text, (s["at"] + 1).cast("int"), rest))
    )
