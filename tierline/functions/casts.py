"""Text to typed values, null when malformed, whatever the session's ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(col: Column) -> Column:
    """Integer from text; a well-formed fraction is cut off, anything else is null.

    The regular path is a single cast. Only values it rejects are looked at
    again, and of those only plain decimals such as ``1.9`` or ``-.5`` change.
    """
    without_fraction = F.regexp_replace(col, r"^(\s*[+-]?)(\d*)\.\d*\s*$", "$10$2")
    return F.coalesce(col.try_cast("int"), without_fraction.try_cast("int"))


def to_double(col: Column) -> Column:
    return col.try_cast("double")


def to_day(col: Column) -> Column:
    return col.try_cast("date")


def to_ts(col: Column) -> Column:
    return col.try_cast("timestamp")


def time_on_day(clock: Column, day: Column) -> Column:
    """Timestamp from ``clock``; a bare time of day is placed on ``day``.

    Spark would fill in the date the job happens to run on, which makes a
    re-run of the same batch give another answer.
    """
    bare = clock.rlike(r"^\s*T?\d{1,2}:\d{2}")
    on_day = F.concat(
        F.date_format(day, "yyyy-MM-dd"), F.lit("T"), F.regexp_replace(F.trim(clock), "^T", "")
    )
    return F.when(bare, to_ts(on_day)).otherwise(to_ts(clock))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def flag_or_null(condition: Column) -> Column:
    """1 / 0, null where the condition is unknown."""
    return condition.cast("int")
