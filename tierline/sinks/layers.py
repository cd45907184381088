"""Files of the raw, processed and curated layers."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.operators.shape import quoted

# Documents of one landed file. A compressed file is read by one task, so a task that lands more writes several.
LANDED_DOCUMENTS = 200_000

LAYER_PARTITIONS = ("country", "pipeline", "year", "month", "day", "execution_id")


def layer_path(country: str, pipeline: str, execution_id: str, ingestion_time: str, dimension: str | None = None) -> str:
    """Folder of one run below the root of a layer."""
    day = datetime.fromisoformat(ingestion_time).strftime("%Y/%m/%d")
    middle = f"dimensions/{dimension}/" if dimension else ""
    return f"{country}/{pipeline}/{middle}{day}/{execution_id}/"


def write_parquet(df: DataFrame, path: str, full: bool = True) -> None:
    """Snappy Parquet; a full run replaces the folder.

    Timestamps come out in microseconds if the session has SESSION_SETTINGS.
    """
    df.write.mode("overwrite" if full else "append").option("compression", "snappy").parquet(path)


def with_layer_columns(df: DataFrame, country: str, pipeline: str, execution_id: str, ingestion_time: str) -> DataFrame:
    when = datetime.fromisoformat(ingestion_time)
    values: Mapping[str, object] = {
        "country": country,
        "pipeline": pipeline,
        "year": when.year,
        "month": when.month,
        "day": when.day,
        "execution_id": execution_id,
    }
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def write_partitioned(
    df: DataFrame, root: str, partitions: Sequence[str] = LAYER_PARTITIONS, full: bool = True, one_folder: bool = False
) -> None:
    """A layer as one table with a folder per run, so reads prune by run or day.

    Rows of a folder are brought together to avoid small files, and adaptive
    execution splits a folder that is too large for one task. A frame that goes
    to ``one_folder`` needs no such shuffle. With ``full`` only the folders this
    frame has rows for are replaced.
    """
    rows = df if one_folder else df.hint("rebalance", *[F.col(quoted(c)) for c in partitions])
    writer = rows.write.option("compression", "snappy")
    if full:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.partitionBy(*partitions).parquet(root)


def clustered(df: DataFrame, sort_keys: Sequence[str], num_files: int | None = None) -> DataFrame:
    """Ranges of the sort keys, each sorted, so that readers can skip files.

    Rows with equal keys, even whole copies, are spread over ranges by the
    partition they came from. That number is the same when a task runs again,
    which a random one would not be.
    """
    spread = "_from_partition"
    keys = [F.col(quoted(k)) for k in sort_keys]
    ranges = [num_files] if num_files else []
    return (
        df.withColumn(spread, F.spark_partition_id())
        .repartitionByRange(*ranges, *keys, F.col(spread))
        .sortWithinPartitions(*keys)
        .drop(spread)
    )


def land_json(df: DataFrame, path: str) -> None:
    """A batch as one JSON record per line, nulls included as such."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def land_documents(df: DataFrame, document: str, path: str) -> None:
    """Response documents, one per line, from a struct or array column.

    Every document repeats its names and headers, so the files are gzip, which the JSON scan reads as they are.
    """
    text = F.to_json(F.col(quoted(document)), {"ignoreNullFields": "false"})
    writer = df.select(text.alias("value")).write.mode("overwrite").option("maxRecordsPerFile", LANDED_DOCUMENTS)
    writer.options(**{"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}).text(path)


def land_array(df: DataFrame, path: str) -> None:
    """A batch as array documents, one for every task that writes; nulls included as such."""
    text = F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns]), {"ignoreNullFields": "false"})

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            if batch.num_rows:
                marks = pa.array([before, *[","] * (batch.num_rows - 1)], batch.column("value").type)
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(marks, batch.column("value"), "")], ["value"])
                before = ","
        yield pa.RecordBatch.from_arrays([pa.array(["]" if before == "," else "[]"])], ["value"])

    df.select(text.alias("value")).mapInArrow(lines, "value string").write.mode("overwrite").text(path)
