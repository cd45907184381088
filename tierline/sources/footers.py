"""Row counts and bounds of Parquet tables from their footers."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.shape import quoted

# Types whose bounds Spark takes from footers; texts may be cut there, and times lie in several forms.
EXACT = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)

_NO_STATISTICS = "No min/max found"


def pushing(spark: SparkSession) -> SparkSession:
    """A session of the same context that answers aggregates from footers; the caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def extent(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """One row: ``row_count``, and ``min_<c>`` and ``max_<c>`` of columns, without reading any data where footers say it.

    Columns of other types than ``EXACT``, and files without statistics, are scanned as usual. Not a number is no bound in
    footers, so a column of floats that holds one is better scanned.
    """
    own = [paths] if isinstance(paths, str) else list(paths)
    told = _extent(_frame(pushing(spark), own, schema), columns)
    dtypes = {f.name: f.dataType for f in _frame(spark, own, schema).schema}
    if all(isinstance(dtypes[c], EXACT) for c in columns):
        try:
            told.first()
            return told
        except (Py4JJavaError, PySparkException) as error:
            # Spark finds out about a file without statistics only when it looks.
            if _NO_STATISTICS not in str(error):
                raise
    return _extent(_frame(spark, own, schema), columns)


def table_watermark_of_files(spark: SparkSession, paths: str | Sequence[str], key: str, mode: str = "incremental") -> DataFrame:
    """``incremental.table_watermark`` of a table on Parquet, from its footers; null unless the run is incremental."""
    bounds = extent(spark, paths, [key])
    top = F.col(quoted(f"max_{key}"))
    return bounds.select((top if mode == "incremental" else F.when(F.lit(False), top)).alias("max_watermark"))


def _frame(spark: SparkSession, paths: list[str], schema: T.StructType | str | None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(*paths)


def _extent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    bounds = [f(F.col(quoted(c))).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *bounds)
