"""Find benchmark passages in a corpus with a positional inverted index.

The index is a table with a row per slice of documents and term: the places of the
term in one running numbering of the slice's words, with gaps between documents. It
holds every word of the corpus and does not depend on the benchmark. Windows of the
benchmark are a table as well, with their terms in the order of how rare they are in
the corpus. A window goes to the slices that hold its rarest term; there the
postings of its terms, less the term's offset in the window, are intersected in that
order. A task holds the postings of one slice and sees its windows one after the
other, so neither the corpus nor the benchmark bounds what fits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm import words
from snaplake.llm.frames import digest128, small_batches, staged, unused

#: A-Z become a-z; digits, a-z and all bytes beyond ASCII stay; the rest separates.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
#: Places in one row of the index; the postings of a frequent term are several rows.
PIECE = 16_384
#: Windows of an item sent on at once.
WINDOWS = 4096

INDEX = (
    "slice long, term long, piece int, n int, steps array<int>, "
    "docs array<struct<doc_id: long, k1: long, k2: long, n_words: long>>"
)
MATCH = "k1 long, k2 long, w1 long, w2 long, start int, length int, near boolean"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _term_hashes(terms: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, terms)), np.int64)


def _lists(ends: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """``item_id``, ``terms``: a row for each run of ``window`` words, or for all words of a shorter item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), words.texts(batch, "text"), strict=True):
                terms = _term_hashes(terms_of(text))
                size = min(window, len(terms))
                if not size:
                    continue
                found = np.lib.stride_tricks.sliding_window_view(terms, size)
                for a in range(0, len(found), WINDOWS):
                    part = found[a : a + WINDOWS]
                    ends = np.arange(len(part) + 1) * size
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(part), pa.int64()), _lists(ends, part.ravel(), pa.int64())],
                        ["item_id", "terms"],
                    )

    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    return small_batches(rows).mapInArrow(run, "item_id long, terms array<long>")


def build_index(docs: DataFrame, gap: int, slice_bytes: int = words.SLICE_BYTES) -> DataFrame:
    """Postings of all words, as steps from place to place; a row without term lists a slice's documents."""
    about = pa.struct([(c, pa.int64()) for c in ("doc_id", "k1", "k2", "n_words")])
    schema = pa.schema(
        [
            ("slice", pa.int64()),
            ("term", pa.int64()),
            ("piece", pa.int32()),
            ("n", pa.int32()),
            ("steps", pa.list_(pa.int32())),
            ("docs", pa.list_(about)),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in words.slices(batches, "text", slice_bytes):
            codes_of: defaultdict[bytes, int] = defaultdict()
            codes_of.default_factory = codes_of.__len__
            sizes, codes = [], []
            for text in words.texts(batch, "text"):
                found = terms_of(text)
                sizes.append(len(found))
                codes.append(np.fromiter(map(codes_of.__getitem__, found), np.int32, len(found)))
            sizes = np.array(sizes, np.int64)
            flat = np.concatenate(codes)
            places = np.arange(len(flat)) + gap * np.repeat(np.arange(len(sizes)), sizes)
            places = places[np.argsort(flat, kind="stable")]
            counts = np.bincount(flat, minlength=len(codes_of))
            pieces = -(-counts // PIECE)
            piece = np.arange(pieces.sum()) - np.repeat(words.offsets(pieces)[:-1], pieces)
            ends = np.append(np.repeat(words.offsets(counts)[:-1], pieces) + PIECE * piece, len(places))
            steps = np.diff(places, prepend=0)
            steps[ends[:-1]] = places[ends[:-1]]
            rows = len(piece)
            posted = {
                "slice": pa.array(np.full(rows, number), pa.int64()),
                "term": pa.array(np.repeat(_term_hashes(list(codes_of)), pieces), pa.int64()),
                "piece": pa.array(piece, pa.int32()),
                "n": pa.array(np.diff(ends), pa.int32()),
                "steps": _lists(ends, steps, pa.int32()),
            }
            each = [batch.column(c) for c in ("doc_id", "k1", "k2")] + [pa.array(sizes)]
            listed = {"slice": [number], "docs": [pa.StructArray.from_arrays(each, fields=list(about)).to_pylist()]}
            for row, size in ((posted, rows), (listed, 1)):
                columns = [
                    pa.array(row[f.name], f.type) if f.name in row else pa.nulls(size, f.type) for f in schema
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
            number += 1

    return small_batches(docs).mapInArrow(run, INDEX)


def by_rarity(windows: DataFrame, index: DataFrame) -> DataFrame:
    """``w1``, ``w2``, ``ats``, ``terms``: offsets and terms of each window, rarest in the corpus first.

    A window with a term that the corpus does not have is left out.
    """
    each = windows.select("w1", "w2", F.size("terms").alias("length"), F.posexplode("terms").alias("at", "term"))
    rarity = (
        index.where("term IS NOT NULL")
        .select("term", "n")
        .join(each.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
    )
    ranked = each.join(rarity, "term").groupBy("w1", "w2", "length")
    steps = ranked.agg(F.array_sort(F.collect_list(F.struct("n", "at", "term"))).alias("s"))
    return steps.where("size(s) = length").selectExpr("w1", "w2", "s.at AS ats", "s.term AS terms")


def find(offsets: list[int], postings: list[np.ndarray], slop: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a window begins, word for word, and where all its terms lie within ``slop`` places of that
    (nowhere without ``slop``).

    Offsets in the window and the postings there are given from the rarest term on.
    """
    at = postings[0] - offsets[0]
    if not slop:
        for offset, held in zip(offsets[1:], postings[1:], strict=True):
            place = np.searchsorted(held[:-1], at + offset)
            at = at[held[place] == at + offset]
            if not len(at):
                break
        return at, at[:0]
    shifts = np.arange(-slop, slop + 1)
    exact = np.tile(shifts == 0, len(at))
    at = np.repeat(at, len(shifts)) + np.tile(shifts, len(at))
    for offset, held in zip(offsets[1:], postings[1:], strict=True):
        lows = np.searchsorted(held, at + (offset - slop))
        near = held[np.minimum(lows, len(held) - 1)] <= at + (offset + slop)
        near &= lows < len(held)
        same = np.searchsorted(held, at + offset)
        exact &= held[np.minimum(same, len(held) - 1)] == at + offset
        at, exact = at[near], exact[near]
        if not len(at):
            break
    return np.unique(at[exact]), np.unique(at)


class Slice:
    """The documents and postings of one slice, and the matches of windows looked up in it."""

    def __init__(self, number: int | None, gap: int, slop: int):
        self.number, self.gap, self.slop = number, gap, slop
        self.steps: dict[int, list[np.ndarray]] = defaultdict(list)
        self.places: dict[int, np.ndarray] = {}

    def list_documents(self, docs: list[dict]) -> None:
        self.k1, self.k2, sizes = (np.array([d[c] for d in docs], np.int64) for c in ("k1", "k2", "n_words"))
        self.begins = words.offsets(sizes + self.gap)[:-1]

    def postings(self, term: int) -> np.ndarray:
        if term not in self.places:
            self.places[term] = np.concatenate([np.cumsum(s, dtype=np.int64) for s in self.steps.pop(term)])
        return self.places[term]

    def look_up(self, ats: list[int], terms: list[int]) -> tuple[np.ndarray, np.ndarray] | None:
        if not all(t in self.steps or t in self.places for t in terms):
            return None
        return find(ats, [self.postings(t) for t in terms], self.slop)

    def matches(self, found: list[tuple[int, int, int, bool, np.ndarray]]) -> pa.RecordBatch:
        """Places where windows were found, as places of documents."""
        counts = [len(f[-1]) for f in found]
        at = np.concatenate([f[-1] for f in found])
        doc = np.searchsorted(self.begins, at + self.slop, "right") - 1
        w1, w2, length, near = (np.repeat(x, counts) for x in list(zip(*found, strict=True))[:-1])
        columns = self.k1[doc], self.k2[doc], w1, w2, at - self.begins[doc], length, near
        arrays = [pa.array(c, t) for c, t in zip(columns, _MATCH.types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=_MATCH)


_MATCH = pa.schema(
    [
        *((c, pa.int64()) for c in ("k1", "k2", "w1", "w2")),
        ("start", pa.int32()),
        ("length", pa.int32()),
        ("near", pa.bool_()),
    ]
)


def search_index(index: DataFrame, windows: DataFrame, gap: int, slop: int) -> DataFrame:
    """A row for each place of a document where a window begins, or is near if ``slop`` is given."""
    wanted = windows.select(F.explode("terms").alias("term")).distinct()
    postings = index.join(wanted, "term", "left_semi")
    lookups = (
        postings.where("piece = 0")
        .select("slice", "term")
        .join(windows.withColumn("term", F.element_at("terms", 1)), "term")
    )

    def row(df: DataFrame, kind: int, *names: str) -> DataFrame:
        kinds = {
            "term": "long", "piece": "int", "steps": "array<int>", "docs": index.schema["docs"].dataType,
            "w1": "long", "w2": "long", "ats": "array<int>", "terms": "array<long>",
        }
        columns = [F.col(c) if c in names else F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
        return df.select("slice", F.lit(kind).alias("kind"), *columns)

    stream = (
        row(index.where("term IS NULL"), 0, "docs")
        .unionByName(row(postings, 1, "term", "piece", "steps"))
        .unionByName(row(lookups, 2, "w1", "w2", "ats", "terms"))
        .repartition("slice")
        .sortWithinPartitions("slice", "kind", "term", "piece")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = Slice(None, gap, slop)
        for batch in batches:
            numbers, kinds = batch.column("slice").to_pylist(), batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), len(kinds)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if numbers[a] != at.number:
                    at = Slice(numbers[a], gap, slop)
                part = {c: batch.column(c).slice(a, b - a) for c in batch.schema.names}
                if kinds[a] == 0:
                    at.list_documents(part["docs"][0].as_py())
                elif kinds[a] == 1:
                    ends = part["steps"].offsets.to_numpy()
                    values = part["steps"].values.to_numpy()
                    for term, i, j in zip(part["term"].to_pylist(), ends.tolist(), ends[1:].tolist(), strict=False):
                        at.steps[term].append(values[i:j])
                else:
                    found = []
                    ends = part["terms"].offsets.to_numpy().tolist()
                    first = ends[0]
                    ats, terms = (part[c].flatten().to_numpy().tolist() for c in ("ats", "terms"))
                    keys = zip(part["w1"].to_pylist(), part["w2"].to_pylist(), strict=True)
                    for (w1, w2), i, j in zip(keys, ends, ends[1:], strict=False):
                        i, j = i - first, j - first
                        for places, near in zip(at.look_up(ats[i:j], terms[i:j]) or (), (False, True), strict=False):
                            if len(places):
                                found.append((w1, w2, j - i, near, places))
                    if found:
                        yield at.matches(found)

    return small_batches(stream).mapInArrow(run, MATCH)


def _words_in(spans: Column) -> Column:
    """How many words ranges of start and length cover together; the ranges are in order."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(acc: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        new = F.greatest(end - F.greatest(acc["end"], span["start"]), F.lit(0))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + new).alias("n"))

    return F.aggregate(spans, zero, add, lambda acc: acc["n"])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    slop: int = 0,
    slice_bytes: int = words.SLICE_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """A row per document: ``doc_id``, ``n_words``, ``n_hit``, ``items``, ``near_items``, ``k1``, ``k2``.

    ``n_hit`` counts the words inside any occurrence of ``window`` consecutive
    words of an item, or of all its words if it has fewer. ``items`` holds the
    ids of items with an occurrence, as text and in order. ``near_items`` holds
    those with a window all of whose terms lie within ``slop`` places of where
    the phrase would have them; it is empty without ``slop``. Missing texts have
    no words; items without words or id take no part; items that repeat count once;
    rows that repeat, or miss their id, are judged one by one. Other columns are
    not read. Empty tables on either side give no hits. A slice has ``slice_bytes`` of
    text, or one longer document. Terms are told apart by 64 bits of hash, windows and
    rows by 128. Both tables are read once for their words, so it does not matter whether
    rows come in the same order each time they are read.
    """
    items = benchmark.select(
        F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")
    )
    keys = digest128(F.col(doc_id), F.col(text), salt="row")
    lean = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        *(k.alias(n) for k, n in zip(keys, ("k1", "k2"), strict=True)),
    )
    gap = window + 2 * slop + 1
    index, _ = staged(build_index(lean, gap, slice_bytes), "positions")
    w1, w2 = digest128(F.col("terms"), salt="window")
    asked, _ = staged(item_windows(items, window).select("item_id", "terms", w1.alias("w1"), w2.alias("w2")), "position-items")
    windows, _ = staged(by_rarity(asked.dropDuplicates(["w1", "w2"]), index), "position-windows")
    matches, _ = staged(search_index(index, windows, gap, slop), "position-matches")

    # Equal rows give equal matches: one of each is enough, and no copies meet in a group.
    spans = matches.where("NOT near").select("k1", "k2", "start", "length").distinct().groupBy("k1", "k2")
    hit = spans.agg(_words_in(F.array_sort(F.collect_list(F.struct("start", "length")))).alias("n_hit"))
    members = asked.select("w1", "w2", "item_id").distinct()
    found = matches.select("k1", "k2", "w1", "w2", "near").distinct().join(members, ["w1", "w2"])

    def ids(of: str) -> Column:
        return F.collect_set(F.when(F.expr(of), F.col("item_id").cast("string")))

    named = found.groupBy("k1", "k2").agg(ids("NOT near").alias("items"), ids("near").alias("near_items"))
    known = index.where("term IS NULL").selectExpr("inline(docs)")
    merged = named.join(hit, ["k1", "k2"], "left")

    def in_order(names: str) -> Column:
        return F.array_sort(F.coalesce(names, F.array().cast("array<string>"))).alias(names)

    return known.join(merged, ["k1", "k2"], "left").select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        in_order("items"),
        in_order("near_items"),
        "k1",
        "k2",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` that have no word of a benchmark window, with all their columns.

    Missing and empty texts have no words and stay; rows that repeat stay or go alike, each
    one by its id and text; a long text is judged whole. Empty tables on either side leave all rows.
    """
    found = contamination(docs, benchmark, window)
    names = unused(docs, "k1", "k2")
    bad, _ = staged(found.where("n_hit > 0").select("k1", "k2").distinct().toDF(*names), "contaminated")
    keys = digest128(F.col("doc_id"), F.col("text"), salt="row")
    keyed = docs.withColumns(dict(zip(names, keys, strict=True)))
    return keyed.join(bad, names, "left_anti").drop(*names)
