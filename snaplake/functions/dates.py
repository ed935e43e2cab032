"""Snapshot labels, day parsing and zone conversion."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaplake import fixed


def label(start: str | date, end: str | date) -> str:
    """The label of one snapshot, for use as a literal."""
    return f"{start}{fixed.SNAPSHOT_SEPARATOR}{end}"


def snapshot_label(start: Column, end: Column) -> Column:
    first, last = (day.cast("date").cast("string") for day in (start, end))
    return F.concat(first, F.lit(fixed.SNAPSHOT_SEPARATOR), last)


def day_snapshot(moment: Column) -> Column:
    return snapshot_label(moment, moment)


def month_snapshot(moment: Column) -> Column:
    return snapshot_label(F.trunc(moment, "month"), F.last_day(moment))


def snapshot_start(snapshot: Column) -> Column:
    return parse_day(F.split_part(snapshot, F.lit(fixed.SNAPSHOT_SEPARATOR), F.lit(1)))


def snapshot_end(snapshot: Column) -> Column:
    return parse_day(F.split_part(snapshot, F.lit(fixed.SNAPSHOT_SEPARATOR), F.lit(2)))


def parse_day(text: Column, default: str | None = None) -> Column:
    """A day, or the default (or NULL) when the text is not one.

    Month and day may have one digit, as ``strptime`` has it.
    """
    day = F.try_to_timestamp(text, F.lit(fixed.DAY_FORMAT)).cast("date")
    if default is None:
        return day
    return F.coalesce(day, F.lit(default).cast("date"))


def parse_span(start: Column, end: Column, defaults: tuple[str, str]) -> tuple[Column, Column]:
    """First and last day; when either text is no day, both defaults count."""
    days = parse_day(start), parse_day(end)
    both = days[0].isNotNull() & days[1].isNotNull()
    first, last = (
        F.when(both, day).otherwise(F.lit(default).cast("date"))
        for day, default in zip(days, defaults)
    )
    return first, last


def to_zone(moment: Column, zone: str = fixed.LOCAL_ZONE) -> Column:
    """A naive moment is UTC; the result is naive local time in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), moment.cast("timestamp_ntz"))
