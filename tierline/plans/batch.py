"""The two jobs of a batch: raw to processed, processed to curated."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierline.operators import runs, shape
from tierline.plans import steps
from tierline.sinks import layers, ledger
from tierline.sources.envelopes import explode_results
from tierline.workspace import new_dir


@dataclass(frozen=True)
class Run:
    """What identifies one run of a pipeline."""

    pipeline: str
    execution_id: str
    ingestion_time: str
    country: str = "global"
    now: str = ""

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{layers.layer_path(self.country, self.pipeline, self.execution_id, self.ingestion_time)}"


def staged_without_null_columns(df: DataFrame) -> DataFrame:
    """The batch as Parquet in the shared folder, less the columns null in every row.

    Values are counted by the write, so raw documents are parsed once, where a
    count before the write would parse them a second time.
    """
    path = new_dir(df.sparkSession, "staged")
    filled = Observation("filled values")
    counts = [F.count(F.col(shape.quoted(c))).alias(f"filled_{n}") for n, c in enumerate(df.columns)]
    df.observe(filled, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    if not filled.get.get("rows"):
        return staged
    return staged.drop(*[F.col(shape.quoted(c)) for n, c in enumerate(df.columns) if filled.get[f"filled_{n}"] == 0])


def processed(
    raw: DataFrame,
    run: Run,
    dedup_key: str | None = None,
    cleaning_sql: str | None = None,
    drop_nulls: bool = True,
    latest_by: Sequence[Column] = (),
) -> DataFrame:
    """Raw records to flat, clean columns, in the order the steps depend on.

    ``latest_by`` orders the rows of a key over the flat, tidy columns; the first stays.
    """
    df = shape.trim_strings(shape.tidy_names(shape.flatten(explode_results(raw))))
    if drop_nulls:
        df = staged_without_null_columns(df)
    if dedup_key:
        df = shape.dedup(df, dedup_key, latest_by)
    df = shape.processed_lineage(
        df, run.execution_id, run.ingestion_time, run.pipeline, run.country, run.now or run.ingestion_time
    )
    if cleaning_sql:
        df = steps.run_sql(df, cleaning_sql)
    return shape.primitive_only(df)


def curated(batch: DataFrame, run: Run, sql: str | None = None) -> DataFrame:
    df = steps.run_steps(batch, sql)
    return shape.primitive_only(shape.curated_lineage(df, run.execution_id, run.now or run.ingestion_time))


def write_layer(
    df: DataFrame, root: str, run: Run, audit_path: str, status: str, full: bool = True, ledger_path: str | None = None
) -> str:
    """Writes one run's folder and its audit record; rows are counted on the way.

    A failure is recorded too, with its message, and raised again. With ``ledger_path`` the columns and types of the
    run are recorded there, for reads over all runs.
    """
    spark: SparkSession = df.sparkSession
    path, finished = run.path(root), run.now or run.ingestion_time
    counted, observed = runs.observe_rows(df, f"rows of {run.execution_id}")
    try:
        layers.write_parquet(counted, path, full)
    except Exception as error:
        record = runs.audit_row(spark, run.pipeline, run.execution_id, f"{status}_failed", finished, error=str(error))
        record.write.mode("append").json(audit_path)
        raise
    if ledger_path:
        ledger.record(spark, ledger_path, run.execution_id, finished, df.schema)
    record = runs.audit_row(
        spark,
        run.pipeline,
        run.execution_id,
        f"{status}_complete",
        finished,
        row_count=observed.get["row_count"],
        columns=df.columns,
        path=path,
    )
    record.write.mode("append").json(audit_path)
    return path
