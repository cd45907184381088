"""Data-quality checks on a table.

Checks produce rows ``(type, item, actual, expected, passed)``; ``require``
turns failing rows into an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.operators.shape import quoted

RESULT_COLUMNS = ("type", "item", "actual", "expected", "passed")


class QualityError(ValueError):
    """At least one check failed; ``rows`` holds the failing results."""

    def __init__(self, rows: list[dict[str, Any]]):
        super().__init__(f"quality checks failed: {rows}")
        self.rows = rows


def _result(kind: str, item: Column, actual: Column, expected: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("type"),
        item.cast("string").alias("item"),
        actual.cast("long").alias("actual"),
        expected.cast("long").alias("expected"),
        passed.alias("passed"),
    )


def _row_count(threshold: int) -> Column:
    rows = F.count(F.lit(1))
    return _result("row_count_min", F.lit(None), rows, F.lit(threshold), rows >= threshold)


def _nulls(column: str) -> Column:
    nulls = F.count_if(F.col(quoted(column)).isNull())
    return _result("null_check", F.lit(column), nulls, F.lit(0), nulls == 0)


def row_count_min(df: DataFrame, threshold: int = 1) -> DataFrame:
    return df.agg(F.array(_row_count(threshold)).alias("r")).select(F.inline("r"))


def null_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One result per column, all from one pass."""
    return df.agg(F.array(*[_nulls(c) for c in columns]).alias("r")).select(F.inline("r"))


def custom_sql(df: DataFrame, query: str, expected: int = 0) -> DataFrame:
    """First cell of a query that names the table as ``{table}``.

    No row, or a null, counts as 0. What is no whole number fails, with no
    actual value.
    """
    found = df.sparkSession.sql(query, table=df)
    cell = F.first(F.struct(F.col(quoted(found.columns[0])).cast("string").alias("text")))["text"]
    number = cell.try_cast("decimal(38,10)")
    whole = F.when(number == F.floor(number), number.try_cast("long"))
    actual = F.when(cell.isNull(), F.lit(0).cast("long")).otherwise(whole)
    verdict = _result("custom_sql", F.lit(query), actual, F.lit(expected), F.coalesce(actual == expected, F.lit(False)))
    return found.limit(1).agg(F.array(verdict).alias("r")).select(F.inline("r"))


def _unknown(df: DataFrame, kind: str) -> DataFrame:
    return df.sparkSession.range(1).select(
        _result(kind, F.lit(None), F.lit(None), F.lit(None), F.lit(False)).alias("r")
    ).select("r.*")


def run_checks(df: DataFrame, checks: Sequence[Mapping[str, Any]]) -> DataFrame | None:
    """Results of all configured checks; None if there are none.

    Row counts and null checks share one pass over the table, and only the
    columns they name are read. Each SQL check is a query of its own.
    """
    if not checks:
        return None
    counted: list[Column] = []
    others: list[DataFrame] = []
    for check in checks:
        kind = check["type"]
        if kind == "row_count_min":
            counted.append(_row_count(check.get("threshold", 1)))
        elif kind == "null_check":
            counted += [_nulls(c) for c in check.get("columns", [])]
        elif kind == "custom_sql":
            others.append(custom_sql(df, check["query"], check.get("expected", 0)))
        else:
            others.append(_unknown(df, kind))
    if counted:
        others.insert(0, df.agg(F.array(*counted).alias("r")).select(F.inline("r")))
    result = others[0] if others else None
    for frame in others[1:]:
        result = result.unionByName(frame)
    return result


def require(results: DataFrame | None) -> str:
    """``passed`` or ``skipped``; raises QualityError with the failing rows."""
    if results is None:
        return "skipped"
    # one row per configured check, never data
    failed = [row.asDict() for row in results.filter(~F.col("passed")).collect()]
    if failed:
        raise QualityError(failed)
    return "passed"
