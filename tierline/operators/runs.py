"""Run audit records and the questions asked of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierline.operators.shape import keep_first, quoted

AUDIT_SCHEMA = (
    "pipeline_name string, execution_id string, status string, end_time string, "
    "row_count long, column_count int, path string, schema_columns string, error_message string"
)


def observe_rows(df: DataFrame, name: str = "written") -> tuple[DataFrame, Observation]:
    """The frame, counting its rows while whatever uses it runs anyway."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("row_count")), observation


def audit_row(
    spark: SparkSession,
    pipeline: str,
    execution_id: str,
    status: str,
    end_time: str,
    row_count: int | None = None,
    columns: Sequence[str] | None = None,
    path: str | None = None,
    error: str | None = None,
) -> DataFrame:
    """One record of a run, to be appended to the audit table."""
    names = None if columns is None else F.to_json(F.array(*[F.lit(c) for c in columns]))
    return spark.range(1).select(
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(execution_id).alias("execution_id"),
        F.lit(status).alias("status"),
        F.lit(end_time).alias("end_time"),
        F.lit(row_count).cast("long").alias("row_count"),
        F.lit(None if columns is None else len(columns)).cast("int").alias("column_count"),
        F.lit(path).cast("string").alias("path"),
        (F.lit(None) if names is None else names).cast("string").alias("schema_columns"),
        F.lit(error).cast("string").alias("error_message"),
    )


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The newest ``n`` records of every key."""
    return keep_first(df, keys, order, n, rank)


def latest_run(audit: DataFrame, pipeline: str, order: Sequence[Column]) -> DataFrame:
    return newest(audit, [pipeline], order, 1)


def recent_runs(audit: DataFrame, pipeline: str, order: Sequence[Column], n: int = 10) -> DataFrame:
    return newest(audit, [pipeline], order, n, rank="recency")


def newest_version(tables: DataFrame, name: str, updated: str, columns: Sequence[str]) -> DataFrame:
    """Per table name the columns of its most recently updated version."""
    newest_row = F.max_by(F.struct(*[F.col(quoted(c)) for c in columns]), F.col(quoted(updated)))
    return tables.groupBy(name).agg(newest_row.alias("v")).select(name, "v.*")


def run_status(pipelines: DataFrame, audit: DataFrame, control: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Every known pipeline with its latest run and watermark, null if it has none."""
    latest = latest_run(audit, "pipeline_name", order)
    return pipelines.join(latest, "pipeline_name", "left").join(control, "pipeline_name", "left")
