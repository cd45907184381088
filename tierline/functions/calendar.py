"""Fiscal calendar (July to June) and month windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# A fiscal year starts half a calendar year early, so shifting a date forward
# by six months turns every fiscal part into the calendar part of that date.
_SHIFT = 6


def fiscal_year(day: Column) -> Column:
    return F.year(F.add_months(day, _SHIFT))


def fiscal_month(day: Column) -> Column:
    return F.month(F.add_months(day, _SHIFT))


def fiscal_quarter(day: Column) -> Column:
    return F.quarter(F.add_months(day, _SHIFT))


def year_quarter_label(year: Column, quarter: Column) -> Column:
    """``2025-1``; null when either part is."""
    return F.concat(year.cast("string"), F.lit("-"), quarter.cast("string"))


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMM")


def last_months(as_of: date, months: int) -> list[str]:
    """``yyyyMM`` of the month of ``as_of`` and of those before it, oldest first."""
    newest = as_of.year * 12 + as_of.month - 1
    return [f"{n // 12:04d}{n % 12 + 1:02d}" for n in range(newest - months + 1, newest + 1)]
