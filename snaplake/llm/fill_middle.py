"""Fill-in-middle: cut a text at two drawn units and write the middle last.

A unit is a run of letters or any other code point. ``regexp_count`` gives their number
n, and two hashes of the id draw how many of them stand before each cut. One pattern per
row then captures prefix, middle and suffix in a single match: the unit ``{a}`` times, the
unit ``{b-a}`` times, the rest. The groups are possessive, as no text can be cut into
units in two ways, so a match runs in linear time and without recursion however long the
text. All of it is DataFrame work; a row stays where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.frames import unused, whole_text, without

UNIT = "[A-Za-z]+|[^A-Za-z]"
_UNIT = "(?:[A-Za-z]++|[^A-Za-z])"
#: Marks of the form; a text that holds one is left plain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARK = f"{PREFIX}|{SUFFIX}|{MIDDLE}"
RESULT = ("n", "form", "output", "prefix_chars", "middle_chars")


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the id; a missing id counts as an empty one."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(named, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transformed(
    docs: DataFrame,
    seed: int = 1,
    plain_percent: int = 10,
    spm_percent: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with ``n``, ``form``, ``output``, ``prefix_chars`` and ``middle_chars``.

    ``form`` is psm (prefix, suffix, middle) or spm (suffix, prefix, middle); it is plain,
    the text as it is and no lengths, for ``plain_percent`` of the ids, for empty and
    missing texts and those that hold a mark. Both cuts may fall on one place or on an
    end. Rows with the same id and text come out alike, a missing id draws like an empty
    one, and an empty table gives an empty one. Columns of ``docs`` with a name above are
    replaced, all others stay.
    """
    docs = without(docs, RESULT)
    whole, first, second, kind, order, pattern = unused(docs, "whole", "first", "second", "kind", "order", "pattern")
    h1, h2, h3, h4 = _draws(F.col(doc_id), seed)
    units = F.col("n") + 1
    low, high = F.least(h1 % units, h2 % units), F.greatest(h1 % units, h2 % units)
    marked = F.regexp_like(F.col(whole), F.lit(_MARK))
    plain = (F.col(whole) == "") | marked | (F.col(kind) % 100 >= 100 - plain_percent)
    written = (
        docs.withColumn(whole, whole_text(F.col(text)))
        .withColumns({"n": F.regexp_count(whole, F.lit(UNIT)).cast("long"), kind: h3, order: h4})
        .withColumns({first: low, second: high})
        .withColumn("form", F.when(plain, "plain").when(F.col(order) % 100 < spm_percent, "spm").otherwise("psm"))
        .withColumn(
            pattern,
            F.concat(
                F.lit(rf"(?s)\A({_UNIT}{{"),
                F.col(first).cast("string"),
                F.lit(rf"}}+)({_UNIT}{{"),
                (F.col(second) - F.col(first)).cast("string"),
                F.lit("}+)(.*+)"),
            ),
        )
    )
    by_form = F.when(F.col("form") == "psm", F.lit(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")).otherwise(
        F.lit(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    )
    return (
        written.withColumn(
            "output",
            F.when(F.col("form") == "plain", F.col(whole)).otherwise(
                F.regexp_replace(F.col(whole), F.col(pattern), by_form)
            ),
        )
        .withColumns(dict(zip(RESULT[3:], _lengths(F.col("output"), F.col("form")), strict=True)))
        .drop(whole, first, second, kind, order, pattern)
    )


def _between(output: Column, start: str, end: str) -> Column:
    """Code points between two marks of a written text."""
    return (F.locate(end, output) - F.locate(start, output) - len(start)).cast("long")


def _lengths(output: Column, form: Column) -> list[Column]:
    prefix = F.when(form == "psm", _between(output, PREFIX, SUFFIX)).when(
        form == "spm", _between(output, PREFIX, MIDDLE)
    )
    middle = F.char_length(output) - F.locate(MIDDLE, output) - len(MIDDLE) + 1
    return [prefix, F.when(form != "plain", middle.cast("long"))]


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from: its parts between the marks, in their first order."""
    parts = F.split(output, _MARK, -1)  # an empty one, then two and the middle
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
