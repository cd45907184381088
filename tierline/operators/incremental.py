"""High-water marks, month windows and the reads they bound."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.calendar import last_months
from tierline.operators.joins import upsert
from tierline.operators.shape import quoted

WATERMARK_SCHEMA = (
    "pipeline_name string, last_watermark_value string, last_successful_run string, last_execution_id string"
)


def read_watermark(control: DataFrame, pipeline: str) -> DataFrame:
    """Exactly one row, all null if the pipeline has not run yet."""
    return control.filter(F.col("pipeline_name") == pipeline).agg(
        *[
            F.first(source).alias(name)
            for name, source in {
                "last_value": "last_watermark_value",
                "last_run": "last_successful_run",
                "last_execution_id": "last_execution_id",
            }.items()
        ]
    )


def write_watermark(control: DataFrame, updates: DataFrame) -> DataFrame:
    """The control table after a run; an empty or null new value changes nothing.

    ``updates`` has the columns of the control table and one row per pipeline.
    """
    known = updates.filter(F.col("last_watermark_value") != "")
    owned = [c for c in control.columns if c != "pipeline_name"]
    return upsert(control, known, ["pipeline_name"], owned, seeds={})


def boundaries(watermark: DataFrame, incremental_key: str) -> DataFrame:
    """The key column and its exclusive lower bound; null means everything."""
    return watermark.select(
        F.lit(incremental_key).alias("incremental_key"), F.col("last_value").alias("start_after")
    )


def after(df: DataFrame, key: str, bound, inclusive: bool = False) -> DataFrame:
    """Rows beyond ``bound``, a literal the scan can use; all rows for none."""
    if bound is None:
        return df
    column = F.col(quoted(key))
    return df.filter(column >= F.lit(bound) if inclusive else column > F.lit(bound))


def batch_watermark(df: DataFrame, key: str) -> DataFrame:
    """Largest non-empty value, compared as text."""
    text = F.col(quoted(key)).cast("string")
    return df.agg(F.max(F.when(text != "", text)).alias("max_watermark"))


def table_watermark(df: DataFrame, key: str, mode: str = "incremental") -> DataFrame:
    """Largest value of the whole table; null unless the run is incremental."""
    column = F.col(quoted(key))
    if mode != "incremental":
        return df.limit(0).agg(F.max(column).alias("max_watermark"))
    return df.agg(F.max(column).alias("max_watermark"))


def rolling_months(df: DataFrame, period: Column, as_of: date, months: int = 3) -> DataFrame:
    """Rows whose ``yyyyMM`` period is in the month of ``as_of`` or just before.

    The months are literals, so partitions and row groups can be skipped.
    """
    return df.filter(period.isin(last_months(as_of, months)))


def parse_periods(periods: str | Sequence[str]) -> list[str]:
    """A comma-separated text or a list as a list; blanks dropped from a text."""
    if not isinstance(periods, str):
        return list(periods)
    return [p.strip() for p in periods.split(",") if p.strip()]


def in_periods(df: DataFrame, period: Column, periods: str | Sequence[str]) -> DataFrame:
    return df.filter(period.isin(parse_periods(periods)))


def strategy_of(cdc_strategy: str | None = None, mode: str | None = None, override: str | None = None) -> str:
    return override or cdc_strategy or mode or "full"


def read_incremental(
    df: DataFrame,
    strategy: str,
    key: str | None = None,
    bound=None,
    inclusive: bool = False,
    period: Column | None = None,
    as_of: date | None = None,
    months: int = 3,
    periods: str | Sequence[str] | None = None,
    default_periods: str | Sequence[str] | None = None,
) -> DataFrame:
    """The part of a table one run has to look at.

    Periods named for the run win over those the strategy would choose; the
    configured ``default_periods`` apply to full runs only.
    """
    if periods is not None:
        df = in_periods(df, period, periods)
    elif strategy == "rolling_window" and months > 0:
        df = rolling_months(df, period, as_of, months)
    elif strategy == "full" and default_periods is not None:
        df = in_periods(df, period, default_periods)
    if strategy == "incremental":
        df = after(df, key, bound, inclusive)
    return df


def run_unless_empty(df: DataFrame, action):
    """``action(df)``, or None for a batch without rows; looks at one row only."""
    return None if df.isEmpty() else action(df)
