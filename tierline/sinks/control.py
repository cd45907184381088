"""Watermarks of pipelines as a log that is only added to.

A run adds its row as a file of its own, so pipelines that finish together
cannot lose each other's update; nothing is ever rewritten. The state is the
latest row of each pipeline in the order of its runs, not of the writes, so a
row that is written late or twice does not take a pipeline back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.incremental import WATERMARK_SCHEMA, read_watermark
from tierline.workspace import path_exists


def latest(log: DataFrame) -> DataFrame:
    """One row per pipeline, as in a control table. Rows with an empty or null value say nothing.

    One partial row per pipeline and task is shuffled, whatever the length of the log.
    """
    order = F.struct("last_successful_run", "last_execution_id", "last_watermark_value")
    known = log.filter(F.col("last_watermark_value") != "")
    return known.groupBy("pipeline_name").agg(F.max(order).alias("r")).select("pipeline_name", "r.*").select(*log.columns)


class ControlLog:
    """The log at a path; rows have the columns of the control table."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def add(self, updates: DataFrame) -> None:
        updates.select(*_names()).write.mode("append").json(self.path)

    def finish(self, pipeline: str, value: str | None, run_time: str, execution_id: str) -> None:
        """The row of one finished run."""
        self.add(self.spark.createDataFrame([(pipeline, value, run_time, execution_id)], WATERMARK_SCHEMA).coalesce(1))

    def rows(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], WATERMARK_SCHEMA)
        return self.spark.read.schema(WATERMARK_SCHEMA).json(self.path)

    def state(self) -> DataFrame:
        return latest(self.rows())

    def watermark(self, pipeline: str) -> DataFrame:
        """``read_watermark`` of the state; only this pipeline's rows are folded."""
        return read_watermark(latest(self.rows().filter(F.col("pipeline_name") == pipeline)), pipeline)


def _names() -> list[str]:
    return [part.split()[0] for part in WATERMARK_SCHEMA.split(", ")]
