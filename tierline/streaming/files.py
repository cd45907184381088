"""Incremental ingest and keyed upsert as file streams.

The checkpoint remembers which files were read, so each file counts exactly
once, also after a failure, and files that arrive with old times are not missed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierline.operators.shape import quoted
from tierline.sinks.tables import SnapshotTable


def new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    **options: object,
) -> DataFrame:
    """A stream of the rows of files that have not been read yet."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def table_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream over a Parquet table that is a folder of files or a single file."""
    table = spark.read.parquet(path)
    one = table.select(F.col("_metadata.file_path").alias("file")).first()
    folder, _, name = path.rstrip("/").rpartition("/")
    options = {}
    if one is not None and one.file.endswith("/" + name):
        path, options = folder, {"pathGlobFilter": name}
    return new_files(spark, path, table.schema, files_per_batch=files_per_batch, **options)


def ingest_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends what is new to a Parquet folder, then stops."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest_growing(spark: SparkSession, path: str, table: SnapshotTable, checkpoint: str, files_per_batch: int | None = None) -> StreamingQuery:
    """Appends JSON records, one per line, of new files to a table that takes on the columns they bring, then stops.

    The stream reads lines, so its own schema never changes and a new column needs no new stream. Each batch is parsed by the
    columns that it holds, found by a pass over its lines, and the table's commits are the log of schemas: a known column
    keeps its type, and a value that does not fit it is an error, as is a line that is no record. A column that is null in
    the whole batch brings nothing. A batch that was committed but not acknowledged is left out when it comes again.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        tag = f"{checkpoint}#{batch_id}"
        if table.has_commit(tag):
            return
        own = batch.sparkSession
        lines = getattr(batch.select("value")._jdf, "as")(own._jvm.org.apache.spark.sql.Encoders.STRING())
        reader = own._jsparkSession.read().option("mode", "FAILFAST").option("dropFieldIfAllNull", True)
        records = DataFrame(reader.json(lines), own)
        if records.columns:
            table.append(records, tag)

    return _each_batch(new_files(spark, path, "value string", "text", files_per_batch), add, checkpoint)


def upsert_available(
    stream: DataFrame,
    table: SnapshotTable,
    keys: Sequence[str],
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Merges what is new into a table, then stops.

    A batch that was committed but not acknowledged comes again after a
    restart; its tag is already in the table's commits, so it is left out.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        tag = f"{checkpoint}#{batch_id}"
        if not table.has_commit(tag):
            table.merge(prepare(batch) if prepare else batch, keys, tag)

    return _each_batch(stream, merge, checkpoint)


def upsert_partitions_available(
    stream: DataFrame, path: str, keys: Sequence[str], partitions: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Merges what is new into a partitioned table, then stops.

    Only the partitions a batch touches are rewritten. A batch that comes again
    under another checkpoint replaces its own rows, which needs a key in every
    row: a null is an error.
    """
    any_null = reduce(lambda a, b: a | b, [F.col(quoted(k)).isNull() for k in keys])
    first = F.col(quoted(keys[0]))
    checked = F.when(any_null, F.raise_error(F.lit(f"null in the merge key {list(keys)}"))).otherwise(first)
    table = SnapshotTable(stream.sparkSession, path, partition_by=partitions)
    return upsert_available(stream, table, keys, checkpoint, lambda batch: batch.withColumn(keys[0], checked))


def _each_batch(stream: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    query = (
        stream.writeStream.foreachBatch(action)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
