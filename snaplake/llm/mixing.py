"""Mix sources to target weights with nested histograms over a document hash.

The hash of a document is a fixed position in its source. A source takes every
document ``epochs`` times and those below a threshold once more. The threshold
comes from a histogram of words by hash bucket: the bucket that the budget falls
into, and no other, is divided again, until the budget lies between two hashes.
Nothing is sorted by document; the last step is a filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.frames import dropped, staged, unused, whole_text, without, word_count

HASH_BITS = 60
#: Rows of one number range that are counted by one task when equal rows are numbered.
RANGE_BITS = 16
RESULT = ("size", "source_size", "target", "copies", "taken")


def position(doc_id: Column, text: Column) -> Column:
    """A document's place among 2^60; rows with the same id and text share it."""
    named = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), whole_text(text))
    return F.conv(F.substring(F.md5(named), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(
    sized: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3
) -> DataFrame:
    """``source``, ``source_size`` and ``target``, a row per source.

    Targets share the total by weight, none above ``cap`` times its source. What
    a capped source leaves goes to the others by weight: they all get the same
    ``level`` per unit of weight, found where sources in the order of
    ``cap * size / weight`` begin to lie above it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "rank")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(
        F.array(*(F.lit(w) for w in weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")
    )
    ranked = (
        totals.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * cap)
        .withColumn("ratio", F.col("most") / F.col("weight"))
    )
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    total = F.sum("source_size").over(everything)
    leveled = ranked.withColumn(
        "level",
        (total - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(onward),
    )
    first_free = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level")))
    leveled = leveled.withColumn("free", first_free.over(everything))
    share = F.col("weight") * F.col("free.level")
    return leveled.select(
        "source",
        "source_size",
        F.coalesce(F.least(share, F.col("most")), F.col("most")).cast("double").alias("target"),
    )


def source_rules(
    sized: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3, level_bits: int = 12
) -> DataFrame:
    """``source``, ``source_size``, ``target``, ``epochs``, ``threshold``, ``cut`` and ``part``.

    ``sized`` has ``source``, ``size`` and ``position``. A document is in its
    source's last, partial round if its position is below ``threshold``; the one on
    the cut is in if half of it fits. Where equal rows share the position of the cut,
    that is ``cut``, and ``part`` of them are in.
    """
    spark = sized.sparkSession
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    targets = source_targets(sized, weights, cap).withColumn("epochs", epochs)
    targets, path = staged(targets.withColumn("budget", budget), "mix-targets")

    whole = F.col("budget") >= F.col("source_size")
    none = F.lit(None).cast("long")
    found = targets.select(
        "source",
        F.when(whole, F.lit(1 << HASH_BITS)).otherwise(F.lit(0)).alias("at"),
        none.alias("cut"),
        none.alias("part"),
    )
    open_ = targets.where((F.col("budget") > 0) & ~whole).select(
        "source", "budget", F.lit(0).cast("long").alias("base"), F.lit(0).cast("long").alias("prefix")
    )
    paths, closed = [path], []
    for bits in range(level_bits, HASH_BITS + level_bits, level_bits):
        shift = max(HASH_BITS - bits, 0)
        above = shift + level_bits if bits <= HASH_BITS else HASH_BITS % level_bits
        inside = F.col("source").eqNullSafe(F.col("of"))
        if bits > level_bits:
            inside &= F.shiftright("position", above) == F.col("prefix")
        # The open sources are a few rows; positions outside the open bucket go here.
        histogram = (
            sized.join(open_.withColumnRenamed("source", "of"), inside)
            .groupBy("source", "budget", "base", F.shiftright("position", shift).alias("bucket"))
            .agg(
                F.sum("size").alias("own"),
                F.count(F.lit(1)).alias("rows"),
                F.min("position").alias("low"),
                F.max("position").alias("high"),
            )
        )
        so_far = Window.partitionBy("source").orderBy("bucket")
        cut = (
            histogram.withColumn("before", F.col("base") + F.sum("own").over(so_far) - F.col("own"))
            .withColumn("past", F.col("before") >= F.col("budget"))
            .withColumn("crossed", ~F.col("past") & (F.col("before") + F.col("own") > F.col("budget")))
            .groupBy("source", "budget")
            .agg(
                F.min(F.when(F.col("past"), F.shiftleft("bucket", shift))).alias("edge"),
                F.max(F.when(F.col("crossed"), F.struct("bucket", "before", "own", "low", "high", "rows"))).alias("cut"),
                F.max("high").alias("last"),
            )
        )
        cut, path = staged(cut, "mix-cut")
        paths.append(path)
        single = F.col("cut.low") == F.col("cut.high")
        # Rows at one position have the same size; one is in if half of it fits beside those before it.
        each = F.col("cut.own") / F.col("cut.rows")
        room = 2 * (F.col("budget") - F.col("cut.before")) + each
        fits = F.least(F.floor(room / (2 * each)), F.col("cut.rows"))
        alone = F.col("cut.rows") == 1
        at = F.when(single, F.col("cut.low") + F.when(alone, fits).otherwise(0)).otherwise(
            F.coalesce("edge", F.col("last") + 1)
        )
        closed.append(
            cut.where(F.col("cut").isNull() | single).select(
                "source",
                at.alias("at"),
                F.when(single & ~alone, F.col("cut.low")).alias("cut"),
                F.when(single & ~alone, fits).alias("part"),
            )
        )
        open_ = cut.where(F.col("cut").isNotNull() & ~single).select(
            "source", "budget", F.col("cut.before").alias("base"), F.col("cut.bucket").alias("prefix")
        )
        if open_.isEmpty():
            break
    for frame in closed:
        found = found.unionByName(frame)
    found = found.groupBy(F.col("source").alias("of")).agg(
        F.max("at").alias("threshold"), F.max("cut").alias("cut"), F.max("part").alias("part")
    )
    rules = targets.join(found, F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "source_size", "target", "epochs", "threshold", "cut", "part"
    )
    rules, _ = staged(rules, "mix-rules")
    return dropped(rules, *paths)


def _numbered(rows: DataFrame, group: str, number: str) -> DataFrame:
    """``rows`` with their place, from 0, among those of their ``group``; no task counts a whole group.

    Rows are written first, so that their ids hold; a range of ids is numbered by itself,
    and after what the ranges before it hold.
    """
    row, span, before = unused(rows, "row", "span", "before")
    rows, _ = staged(rows.withColumn(row, F.monotonically_increasing_id()), "mix-equal")
    rows = rows.withColumn(span, F.shiftright(row, RANGE_BITS))
    earlier = Window.partitionBy(group).orderBy(span).rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        rows.groupBy(group, span)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col(group).alias(f"{group}_of"),
            F.col(span).alias(f"{span}_of"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before),
        )
    )
    in_range = F.row_number().over(Window.partitionBy(group, span).orderBy(row)) - 1
    joined = rows.withColumn(number, in_range).join(
        ranges, F.col(group).eqNullSafe(F.col(f"{group}_of")) & (F.col(span) == F.col(f"{span}_of"))
    )
    return joined.withColumn(number, F.col(number) + F.col(before)).drop(
        row, span, before, f"{group}_of", f"{span}_of"
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    cap: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with ``size`` in words, ``source_size``, ``target``, ``copies`` and ``taken``.

    A missing text has no words, and a missing source is a source of its own.
    Rows of a source with the same id and text are taken alike but where the cut falls
    among them: as many are in as come nearest to the target, and which ones, where other
    columns tell them apart, may differ between runs. A source without words has target 0; an empty
    table gives an empty one. Columns of ``docs`` with a name above are replaced.
    """
    docs = without(docs, RESULT)
    place = position(F.col(doc_id), F.col(text))
    sized = docs.select(
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        place.alias("position"),
    )
    sized, path = staged(sized, "mix-sizes")
    rules = dropped(source_rules(sized, weights, cap), path)
    at = dict(zip(rules.columns, unused(docs, *rules.columns), strict=True))
    cut = not rules.where(F.col("cut").isNotNull()).isEmpty()  # a row per source
    rules = rules.toDF(*at.values())
    joined = docs.withColumn("size", word_count(F.col(text))).join(
        rules, docs[source].eqNullSafe(rules[at["source"]])
    )
    again = place < F.col(at["threshold"])
    if cut:
        (number,) = unused(joined, "number")
        among = F.coalesce(place == F.col(at["cut"]), F.lit(False))
        equal = _numbered(joined.where(among), at["source"], number)
        joined = joined.where(~among).withColumn(number, F.lit(None).cast("long")).unionByName(equal)
        again |= F.coalesce(F.col(number) < F.col(at["part"]), F.lit(False))
    mixed = (
        joined.withColumn("source_size", F.col(at["source_size"]))
        .withColumn("target", F.col(at["target"]))
        .withColumn("copies", (F.col(at["epochs"]) + again.cast("long")).cast("long"))
        .withColumn("taken", F.col("size") * F.col("copies"))
    )
    return mixed.select(*docs.columns, *RESULT)


def mixed_rows(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken, with all their columns.

    Rows without words, also with a missing or empty text, come as often as others of their
    place in the source; long texts count whole; rows that repeat are taken one by one; an
    empty table gives an empty one.
    """
    names = ["_" + str(i) for i in range(len(docs.columns))]  # apart from what the mix adds
    at = {c.lower(): n for c, n in zip(docs.columns, names, strict=True)}
    taken = mix(
        docs.toDF(*names), weights, cap, doc_id=at["doc_id"], text=at["text"], source=at["source"]
    ).where("copies > 0")
    repeated = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return repeated.select(*names).toDF(*docs.columns)
