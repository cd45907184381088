"""File scans: JSON, CSV, Parquet."""

from __future__ import annotations

import codecs
import re
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tierline.operators.joins import concat
from tierline.operators.shape import quoted
from tierline.workspace import path_exists

CSV_SUFFIX = "*.[cC][sS][vV]"
_MALFORMED = "_malformed_line"


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False) -> DataFrame:
    """JSON records; an array document gives one row per element.

    Name the schema when it is known: without one Spark reads the input twice.
    ``multi_line`` is for documents that span lines. Such a file cannot be
    split, so land large batches one document per line.
    """
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; types inferred unless a schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_parquet(spark: SparkSession, *paths: str, schema: T.StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(*paths)


def pick_up_csv(
    spark: SparkSession,
    folder: str,
    sep: str = ",",
    encoding: str = "utf-8",
    modified_after: str | None = None,
    columns: Sequence[str] | None = None,
    mixed_headers: bool = False,
    file_columns: bool = False,
    multi_line: bool = True,
    drop_surplus: bool = False,
) -> DataFrame:
    """All CSV files below a drop folder, every value a string.

    An empty field is an empty string, not null. All files must share one
    header, which is checked; with ``mixed_headers`` files are grouped by their
    header instead and the groups concatenated by column name; for that the
    first line of each file is read, and no more. ``modified_after`` (strict) leaves out what a
    former run has seen. ``file_columns`` adds ``_file`` and ``_modified``.
    Quotes in quoted fields are doubled. A file is read by one task, since a
    field may hold line breaks; without ``multi_line``, for drops known to have
    none, large files are split. A line with more cells than the header is an
    error, or loses them with ``drop_surplus``.
    """
    dialect = {"header": True, "sep": sep, "encoding": _charset(encoding), "escape": '"', "multiLine": multi_line}

    def scan(path, header: Sequence[str]) -> DataFrame:
        names = list(header)
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _MALFORMED]])
        reader = _drop_folder_reader(spark, modified_after).options(**dialect).schema(schema)
        rows = reader.options(enforceSchema=False, columnNameOfCorruptRecord=_MALFORMED).csv(path)
        # a line of the right length has every field, so a null there was empty
        regular = F.col(_MALFORMED).isNull()
        if not drop_surplus and names:
            # too short a line has no last field; too long a line has them all
            last = F.col(quoted(names[-1]))
            message = F.concat(F.lit("more cells than the header has: "), F.col(_MALFORMED))
            checked = F.when(~regular & last.isNotNull(), F.raise_error(message).cast("string")).otherwise(last)
            rows = rows.select(*[F.col(quoted(n)) for n in names[:-1]], checked.alias(names[-1]), _MALFORMED, *_file_columns(file_columns))
            if file_columns:
                columns_of_file = [F.col("_file"), F.col("_modified")]
            else:
                columns_of_file = []
        else:
            columns_of_file = _file_columns(file_columns)
        return rows.select(
            *[F.when(regular, F.coalesce(F.col(quoted(n)), F.lit(""))).otherwise(F.col(quoted(n))).alias(n) for n in names],
            *columns_of_file,
        )

    if not mixed_headers:
        # the header of the files that are read, not of those a former run has seen
        fresh = _drop_folder_reader(spark, modified_after).options(**dialect)
        return scan(folder, columns or _header(fresh, folder) or _header(_drop_folder_reader(spark).options(**dialect), folder))
    groups = _files_by_header(spark, folder, dialect, modified_after)
    if not groups:
        return scan(folder, columns or [])
    return concat(*[scan(paths, header) for header, paths in groups])


def _header(reader: DataFrameReader, folder: str) -> list[str]:
    """Column names of the first file; none if there is no file."""
    try:
        return reader.csv(folder).columns
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return []


def _charset(encoding: str) -> str:
    """Spark's name of an encoding that may be written as Python knows it."""
    name = codecs.lookup(encoding).name
    return {"iso8859-1": "iso-8859-1", "ascii": "us-ascii", "utf-8-sig": "utf-8"}.get(name, name)


def _drop_folder_reader(spark: SparkSession, modified_after: str | None = None) -> DataFrameReader:
    reader = spark.read.options(pathGlobFilter=CSV_SUFFIX, recursiveFileLookup=True)
    return reader.option("modifiedAfter", modified_after) if modified_after else reader


def _file_columns(wanted: bool):
    if not wanted:
        return []
    return [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_modification_time").alias("_modified"),
    ]


def _files_by_header(
    spark: SparkSession, folder: str, dialect: Mapping[str, object], modified_after: str | None
) -> list[tuple[list[str], list[str]]]:
    """Column names and files of each distinct header line.

    Brings one line per file to the driver, which lists the files anyway.
    """
    firsts = _first_lines(spark, folder, modified_after).select("path", F.decode("line", str(dialect["encoding"])).alias("line"))
    groups: dict[str, list[str]] = defaultdict(list)
    for row in firsts.sort("path").collect():
        groups[row.line].append(unquote(row.path))
    result = []
    for line, paths in groups.items():
        header = spark.read.options(**dialect).csv(paths[0]).columns
        result.append((header, paths))
    return result


def _first_lines(spark: SparkSession, folder: str, modified_after: str | None = None) -> DataFrame:
    """(path, line): the bytes of the first line of each file, of which only the beginning is read.

    A session of its own deals each file whole to one task and hands over single lines; the task takes one and stops,
    which ends its reading wherever the file's buffer is.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", _ANY_SIZE)
    own.conf.set("spark.sql.files.openCostInBytes", _ANY_SIZE)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = _drop_folder_reader(own, modified_after).text(folder)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    named = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("line"))
    return named.mapInArrow(first, "path string, line binary")


# Above the size of any file, so that none is cut and no two share a task.
_ANY_SIZE = str(2**50)


def newest_file_time(rows: DataFrame) -> DataFrame:
    """Watermark of a pick-up read with ``file_columns``: one row, null if empty."""
    return rows.agg(F.max("_modified").alias("max_watermark"))


def read_run(spark: SparkSession, table_path: str, execution_id: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Only the rows one run wrote; files of other runs are not listed.

    The run's folder is looked for at each level of the table, so only folders
    above it are listed. The id is a string, whatever it looks like.
    """
    root = table_path.rstrip("/")
    name = "execution_id=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in execution_id)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    above = root
    while True:
        found = files.globStatus(hadoop.Path(f"{above}/{_literal(name)}"))
        if found:
            paths = [f.getPath().toString() for f in found]
            break
        above += "/*=*"
        if not files.globStatus(hadoop.Path(above)):
            return _named(read_parquet(spark, root, schema=schema).filter(F.lit(False)), {"execution_id": execution_id})
    reader = spark.read.option("basePath", root)
    return _named((reader.schema(schema) if schema else reader).parquet(*map(_literal, paths)), {"execution_id": execution_id})


# Characters that are written as %XX in the names of partition folders.
_ESCAPED = "\"#%'*/:=?\\{}[]^" + "".join(map(chr, [*range(1, 32), 127]))


def _literal(path: str) -> str:
    """The path with nothing that would be a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _named(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Folder values as the strings they are; inferred ones would turn digits into numbers."""
    return df.withColumns({k: F.lit(v) for k, v in values.items() if k in df.columns})


def read_below(spark: SparkSession, root: str, prefix: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Rows of files below a folder of a table; nothing else is listed.

    Columns that the folders between ``root`` and ``prefix`` stand for are kept, as strings.
    """
    reader = spark.read.option("basePath", root)
    rows = (reader.schema(schema) if schema else reader).parquet(f"{root.rstrip('/')}/{prefix.strip('/')}")
    folders = [part.partition("=") for part in prefix.strip("/").split("/")]
    return _named(rows, {k: unquote(v) for k, eq, v in folders if eq and v != "__HIVE_DEFAULT_PARTITION__"})


def read_all_runs(spark: SparkSession, root: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All runs under a folder, with the union of their columns.

    A given schema saves looking at the footer of every file.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    return (reader.schema(schema) if schema else reader.option("mergeSchema", True)).parquet(root)


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet folder, or no rows when nothing has been written there yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def extract_view(spark: SparkSession, view: str) -> DataFrame:
    """A named view as it is: typed cells, nulls kept, nothing collected."""
    return spark.table(view)
