"""One snapshot, from landed pages to tables and sheets.

Each table is written before those that need it are computed, and later steps read it
back; tables that do not need each other are loaded at the same time. So no step repeats the page parsing of an earlier one, nothing depends on
an executor staying alive, and a run that starts again finds what is stored and
goes on from there.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snaplake.fixed import NA, SHEET_NAMES
from snaplake.functions import text, values
from snaplake.functions.dates import label
from snaplake.functions.urls import canonical_url
from snaplake.operators.dedup import dedup_dual_key, dedup_first
from snaplake.operators.enrich import (
    children_of,
    enrich_creator_links,
    lookup_first,
    top_shops,
)
from snaplake.operators.reshape import label_columns, product_dim
from snaplake.operators.resume import resume_anti
from snaplake.plans import records
from snaplake.schemas import OTHER_METRICS, SCHEMAS, SEQ, SNAPSHOT, conform, headers
from snaplake.sources import sheets, tables
from snaplake.sources.pages import LANDED, read_pages

PRODUCT = ["shop_link", "product_name"]


class Saved(int):
    """The number of rows added to a table; also how many were loaded for it, and stored ones changed."""

    loaded: int
    updated: int

    def __new__(cls, added: int, loaded: int = 0, updated: int = 0) -> Saved:
        self = super().__new__(cls, added)
        self.loaded, self.updated = loaded, updated
        return self


class _Watch:
    """Counts rows where they pass in a write, so that nothing is read again to count it."""

    def __init__(self) -> None:
        self.seen: list[Observation] = []

    def __call__(self, rows: DataFrame, counted: Column | None = None) -> DataFrame:
        self.seen.append(Observation())
        count = F.count(F.lit(1)) if counted is None else F.count_if(counted)
        return rows.observe(self.seen[-1], count.alias("rows"))

    def total(self) -> int:
        """Rows of the writes that are done."""
        return sum(o.get["rows"] for o in self.seen)


@contextmanager
def _all_counted(spark: SparkSession) -> Iterator[None]:
    """While this holds, no part of a plan is left out because another turns out empty:
    the rows that pass in it would not be counted. The setting is put back in the end."""
    setting = "spark.sql.adaptive.optimizer.excludedRules"
    before = spark.conf.get(setting, None)
    rules = [before] if before else []
    spark.conf.set(setting, ",".join([*rules, "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"]))
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


class _Day:
    """The stored and the new rows of one snapshot."""

    def __init__(self, spark: SparkSession, warehouse: str, snapshot: str, shop_base: str) -> None:
        self.spark, self.warehouse, self.snapshot = spark, warehouse, snapshot
        self.shop_base = shop_base
        self.saved: dict[str, Saved] = {}
        self.loaded = _Watch()

    def apart(self) -> _Day:
        """The same day for a step that runs beside others: rows loaded are its own, ``saved`` is shared."""
        return copy.copy(self)

    def path(self, table: str) -> str:
        return tables.table_path(self.warehouse, table)

    def stored(self, table: str) -> DataFrame:
        rows = tables.load_table(self.spark, self.warehouse, table)
        if SNAPSHOT not in rows.columns:
            return rows
        return rows.where(F.col(SNAPSHOT) == self.snapshot)

    def seeds(self, table: str) -> DataFrame:
        """Stored rows under the canonical shop address; rows without a shop are no seeds."""
        link = canonical_url(F.col("shop_link"), self.shop_base)
        rows = self.stored(table).withColumn("shop_link", link)
        return rows.where(~F.col("shop_link").isin("", NA))

    def load(self, parsed: DataFrame) -> DataFrame:
        """Count the rows that pages give for the next table that is saved."""
        self.loaded = _Watch()
        return self.loaded(parsed)

    def save(self, table: str, new: DataFrame, write: Callable[[DataFrame, _Watch], None]) -> None:
        """Write new rows through ``write``, which counts them where they are written."""
        added = _Watch()
        write(tables.stamp(conform(new, SCHEMAS[table])), added)
        tables.add_partition(self.spark, table, self.path(table), self.snapshot)
        self.saved[table] = Saved(added.total(), self.loaded.total())

    def append(self, table: str, new: DataFrame) -> None:
        self.save(table, new, lambda rows, added: tables.append_rows(added(rows), self.path(table)))


def _together(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Run steps that read nothing the others write at the same time, so that jobs too
    small for the cluster do not wait for each other. All end before an error is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        done = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in done:
        step.result()


def run(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    start: str | date,
    end: str | date,
    shop_base: str,
    live_host: str,
    max_shops: int | None = None,
    book: str | None = None,
) -> dict[str, Saved]:
    """Load one snapshot; returns for each table the number of rows added, loaded and updated.

    Pages landed by :func:`~snaplake.sources.pages.land_pages` lie by snapshot and
    kind, so each table reads its own only. ``shop_base`` is the address an id is
    appended to, ``live_host`` the host of livestream pages. ``max_shops`` takes that many shops in list order with all
    that belongs to them. With ``book`` the sheets of the snapshot are rewritten.
    """
    snapshot = label(start, end)
    day = _Day(spark, warehouse, snapshot, shop_base)
    landed = read_pages(spark, landing, LANDED).where(F.col(SNAPSHOT) == snapshot)
    landed = records.with_shop(landed, shop_base)
    if max_shops is not None:
        # A shop that landed again counts once, where it came first.
        shops = landed.where(F.col("kind") == "shop")
        listed = shops.groupBy("shop_link").agg(F.min(SEQ).alias(SEQ))
        landed = children_of(landed, top_shops(listed, [F.asc(SEQ)], max_shops), ["shop_link"])

    def pages(kind: str) -> DataFrame:
        return landed.where(F.col("kind") == kind)

    with _all_counted(spark):
        _together(
            spark,
            lambda: _load_shops(day.apart(), pages),
            lambda: _load_shop_creators(day.apart(), pages),
            lambda: _load_products(day.apart(), pages),
        )
        _load_creators(day, pages)
        _together(
            spark,
            lambda: _load_videos(day.apart(), pages),
            lambda: _load_lives(day.apart(), pages, live_host),
        )
    if book is not None:
        write_book(spark, warehouse, book, snapshot)
    return day.saved


def _new_rows(day: _Day, table: str, parsed: DataFrame, key: list[str]) -> DataFrame:
    """First rows of the keys that are not stored.

    Pages are parsed where they are read; only the short fields are shuffled.
    """
    return dedup_first(resume_anti(day.load(parsed), day.seeds(table), key), key, SEQ)


def _load_shops(day: _Day, pages: Callable[[str], DataFrame]) -> None:
    parsed = conform(records.shops(pages("shop")), SCHEMAS["shop_metrics"])
    day.append("shop_metrics", _new_rows(day, "shop_metrics", parsed, ["shop_link"]))


def _load_shop_creators(day: _Day, pages: Callable[[str], DataFrame]) -> None:
    key = ["shop_link", "creator_name"]
    rows = records.with_row(pages("shop_creator"), "shop_creator")
    rows = rows.withColumn("creator_name", F.col("row.name"))
    parsed = conform(records.shop_creators(rows), SCHEMAS["shop_creators"])
    day.append("shop_creators", _new_rows(day, "shop_creators", parsed, key))


def _load_products(day: _Day, pages: Callable[[str], DataFrame]) -> None:
    rows = records.with_row(pages("product"), "product")
    rows = rows.withColumn("product_name", text.clean_name(F.col("row.name")))
    parsed = conform(records.products(rows), SCHEMAS["product_metrics"])
    day.append("product_metrics", _new_rows(day, "product_metrics", parsed, PRODUCT))

    dim = product_dim(day.load(day.stored("product_metrics")), SEQ, keep_seq=True)
    day.save(
        "product_dim",
        dim,
        lambda rows, added: tables.upsert_dim(rows, day.path("product_dim"), PRODUCT, watch=added),
    )


def _with_product_link(day: _Day, rows: DataFrame) -> DataFrame:
    linked = lookup_first(
        rows, day.seeds("product_metrics"), PRODUCT, "tiktok_product_link", SEQ
    )
    return linked.withColumnRenamed("tiktok_product_link", "product_link")


def _load_creators(day: _Day, pages: Callable[[str], DataFrame]) -> None:
    stored = day.seeds("product_creators")
    rows = records.with_row(pages("creator"), "creator")
    rows = rows.withColumn("creator_name", F.col("row.name"))
    parsed = conform(records.product_creators(rows), SCHEMAS["product_creators"])
    kept = dedup_dual_key(
        day.load(parsed), stored, PRODUCT, "creator_name", "tiktok_link", SEQ, exempt_na=False
    )
    day.append("product_creators", _with_product_link(day, kept.drop("product_link")))


def _load_videos(day: _Day, pages: Callable[[str], DataFrame]) -> None:
    stored = day.seeds("videos")
    rows = records.with_row(pages("video"), "video")
    rows = rows.withColumn("item_title", F.col("row.name"))
    parsed = conform(records.videos(rows), SCHEMAS["videos"])
    kept = dedup_dual_key(day.load(parsed), stored, PRODUCT, "item_title", "link", SEQ, exempt_na=True)
    _append_content(day, "videos", kept)


def _load_lives(day: _Day, pages: Callable[[str], DataFrame], live_host: str) -> None:
    # Livestreams have no key of their own; a page taken once is not taken again.
    rows = records.with_row(pages("live"), "live")
    rows = rows.withColumn("item_title", F.col("row.name"))
    parsed = conform(records.lives(rows, live_host), SCHEMAS["lives"])
    _append_content(day, "lives", resume_anti(day.load(parsed), day.stored("lives"), SEQ))


def _append_content(day: _Day, table: str, new: DataFrame) -> None:
    """Append with links filled in, then fill those of the rows stored before.

    Creators may be stored after the content that names them. Only rows whose link is
    still open can change, as the first creator of a name stays the first; the partition
    is written again only if some of them do.
    """
    creators = day.stored("product_creators")
    linked = _with_product_link(day, new.drop("product_link"))
    day.append(table, enrich_creator_links(linked, creators))

    stored = day.stored(table)
    open_ = values.na_default(F.col("creator_link")) == NA
    known = enrich_creator_links(stored.where(open_), creators).where(F.col("creator_link") != NA)
    if not known.isEmpty():
        updated = _Watch()
        filled = enrich_creator_links(stored.withColumn("_open", open_), creators)
        filled = updated(filled, F.col("_open") & (F.col("creator_link") != NA)).drop("_open")
        tables.replace_snapshots(filled, day.path(table))
        before = day.saved[table]
        day.saved[table] = Saved(int(before), before.loaded, updated.total())


def write_book(
    spark: SparkSession, warehouse: str, book: str, snapshot: str, fmt: str = "parquet"
) -> None:
    """The sheets of a snapshot, read from the written tables.

    Labels that no header declares are columns of the sheet as well, if a page of the
    snapshot shows them. A sheet that fails does not keep the others from being written.
    """
    errors: list[Exception] = []
    for table, sheet in SHEET_NAMES.items():
        rows = tables.load_table(spark, warehouse, table)
        try:
            here = rows.where(F.col(SNAPSHOT) == snapshot) if SNAPSHOT in rows.columns else rows
            shown = here.select(*headers(table))
            if OTHER_METRICS in rows.columns:
                other = label_columns(here, OTHER_METRICS, shown.columns)
                shown = here.select(*headers(table), *(c.alias(n) for n, c in other.items()))
            if SNAPSHOT in rows.columns:
                sheets.write_sheet(shown, book, sheet, fmt, partition=SNAPSHOT, value=snapshot)
            else:
                sheets.write_sheet(shown, book, sheet, fmt)
        except Exception as error:
            errors.append(error)
    if errors:
        raise errors[0]

