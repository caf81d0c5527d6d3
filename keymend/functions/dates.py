"""Validity windows (half-open) and cutoffs."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def end_or_open(c: Column, open_end: str = OPEN_END) -> Column:
    return F.coalesce(c, F.lit(datetime.date.fromisoformat(open_end)))


def overlaps(from_a: Column, to_a: Column, from_b: Column, to_b: Column) -> Column:
    """Whether two windows share a moment; a null end is open."""
    return (from_a < end_or_open(to_b)) & (from_b < end_or_open(to_a))


def contains(at: Column, start: Column, end: Column) -> Column:
    return (at >= start) & (at < end_or_open(end))


def clamped_to_start(at: Column, start: Column, end: Column) -> Column:
    """An event date outside its version's window becomes the window's start, on either side."""
    return F.when((at < start) | (at > end), start).otherwise(at)


def cutoff(mode: str = "d_minus_1", date: str | None = None) -> Column:
    """The last date, included, through which the legacy fact is authoritative."""
    if mode == "d_minus_1":
        return F.date_sub(F.current_date(), 1)
    if mode == "explicit":
        if not date:
            raise ValueError("cutoff_mode explicit needs cutoff_date")
        return F.lit(datetime.date.fromisoformat(date))
    raise ValueError(f"unknown cutoff_mode {mode!r}")
