"""Keyed warehouse tables on plain Parquet.

Every commit names the data folders the table now consists of. A load writes new
folders and then one commit file, whole under a name of its own, which is then
renamed to the next version unless that exists. So readers see the old or the
new state, nothing is overwritten, and a load that dies at any point leaves the
table as it was. That rests on a rename that one of two writers loses, which
HDFS and local disks have; for stores that have none, a table must be opened
with ``one_writer``, and the caller sees to it that there is only one.

A load may be dealt to parts: by columns that are in every key (``partition_by``,
such as the period, whose values are hashed to a bounded number of folders), or
by a hash of the merge key (``bucket_by``). A merge then reads and rewrites only
the parts its batch has rows for; without parts it rewrites the folders that
hold an arriving key. A replace by its own rows compacts. With a table format on
the cluster the same loads are ``MERGE INTO`` and ``INSERT`` statements.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.joins import concat, new_columns, with_matches, without_matches
from tierline.operators.shape import flatten_dimension, quoted, to_declared
from tierline.sinks.layers import clustered
from tierline.workspace import new_dir

PART = "_part"
# Folders that the values of ``partition_by`` are hashed to, unless the table says otherwise.
PARTS = 256
COMMIT_SCHEMA = "version long, tag string, folders array<string>, table_schema string, streams map<string,long>"
# File systems whose rename fails, for one of two writers, where the target exists.
SAFE_SCHEMES = ("file", "hdfs", "viewfs")


class ConcurrentCommit(RuntimeError):
    """Another writer committed after this one had looked at the table."""


class Rejected(RuntimeError):
    """A batch did not pass the checks before its commit; ``tag`` reads it."""

    def __init__(self, tag: str, reason: Exception) -> None:
        super().__init__(f"batch {tag} was not published: {reason}")
        self.tag = tag


def grown_schema(existing: T.StructType, incoming: T.StructType) -> T.StructType:
    """Existing columns, never retyped, then the new ones."""
    return T.StructType([*existing, *[T.StructField(f.name, f.dataType) for f in new_columns(incoming, existing)]])


def aligned(df: DataFrame, schema: T.StructType, lossy: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """The frame by name in the table's order and types; null where it has no such column.

    A value that does not fit the table's type is an error. With ``lossy`` it
    becomes null instead (``misfits`` counts these), but never in a key.
    """
    present = {f.name.lower(): f for f in df.schema}
    strict = {k.lower() for k in keys}

    def column(field: T.StructField) -> Column:
        own = present.get(field.name.lower())
        if own is None:
            return F.lit(None).cast(field.dataType)
        value = F.col(quoted(own.name))
        if own.dataType == field.dataType:
            return value
        fitted = value.try_cast(field.dataType)
        if lossy and field.name.lower() not in strict:
            return fitted
        message = F.lit(f"a value of {own.name} does not fit {field.dataType.simpleString()}")
        return F.when(value.isNotNull() & fitted.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(fitted)

    return df.select(*[column(f).alias(f.name) for f in schema])


def misfits(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column, lost): values of each column that a lossy load would null, from one pass."""
    present = {f.name.lower(): f for f in df.schema}
    counts = []
    for field in schema:
        own = present.get(field.name.lower())
        if own is not None:
            value = F.col(quoted(own.name))
            lost = F.count_if(value.isNotNull() & value.try_cast(field.dataType).isNull())
            counts.append(F.struct(F.lit(field.name).alias("column"), lost.alias("lost")))
    return df.agg(F.array(*counts).alias("r")).select(F.inline("r"))


def merged(target: DataFrame, staging: DataFrame, keys: Sequence[str], lossy: bool = False) -> DataFrame:
    """Target rows whose key does not arrive, and all staging rows.

    Duplicates within staging stay. Rows with a null in the key match nothing:
    those of the target stay, those of staging are added.
    """
    if not keys:
        raise ValueError("a merge needs key columns")
    schema = grown_schema(target.schema, staging.schema)
    batch = aligned(staging, schema, lossy, keys)
    return concat(without_matches(aligned(target, schema), batch, keys), batch)


def table_type(dtype: T.DataType) -> T.DataType:
    """Type a warehouse column gets for a column of this type."""
    as_is = (
        T.StringType,
        T.BinaryType,
        T.IntegerType,
        T.LongType,
        T.DoubleType,
        T.FloatType,
        T.BooleanType,
        T.DateType,
        T.TimestampType,
        T.TimestampNTZType,
        T.DecimalType,
        T.ArrayType,
        T.StructType,
        T.MapType,
    )
    return dtype if isinstance(dtype, as_is) else T.StringType()


def table_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, table_type(f.dataType)) for f in schema])


def _schema_of(commit) -> T.StructType:
    return T.StructType.fromJson(json.loads(commit.table_schema))


class SnapshotTable:
    """A table at a path; see the module text for the layout.

    ``partition_by`` (into ``parts`` folders) or ``bucket_by`` with ``buckets`` must be the same
    for every writer of a table. Keys of one bucketed table are merged by ``bucket_by``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        sort_keys: Sequence[str] = (),
        partition_by: Sequence[str] = (),
        bucket_by: Sequence[str] = (),
        buckets: int = 0,
        parts: int = PARTS,
        one_writer: bool = False,
    ):
        if partition_by and bucket_by or bool(bucket_by) != bool(buckets):
            raise ValueError("a table has partitions, or buckets and their number, or neither")
        self.spark = spark
        self.path = path.rstrip("/")
        self.sort_keys = tuple(sort_keys)
        self.part_columns = tuple(partition_by or bucket_by)
        self.buckets = buckets or parts
        files, log = self._log()
        scheme = files.makeQualified(log).toUri().getScheme()
        if not one_writer and scheme not in SAFE_SCHEMES:
            raise ValueError(f"{scheme} has no rename that keeps writers apart; open the table with one_writer")

    # -- reading

    def _log(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _versions(self) -> list[int]:
        """The numbers of all commit files, whatever they hold."""
        files, path = self._log()
        names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
        return sorted(int(n.removesuffix(".json")) for n in names if re.fullmatch(r"[0-9]{12}\.json", n))

    def _commit_of(self, version: int):
        """What a commit says; None for a file that an older writer left empty or torn."""
        path = f"{self.path}/commits/{version:012d}.json"
        return self.spark.read.schema(COMMIT_SCHEMA).json(path).filter("version is not null and table_schema is not null").first()

    def _current(self, until: int | None = None):
        """The last commit (up to a version); one file is read, whatever the number of commits."""
        for version in reversed(self._versions()):
            if until is None or version <= until:
                found = self._commit_of(version)
                if found is not None:
                    return found
        return None

    def exists(self) -> bool:
        return self._current() is not None

    def version(self) -> int:
        current = self._current()
        return current.version if current else 0

    def tag(self) -> str | None:
        """The tag of the last load."""
        current = self._current()
        return current.tag if current else None

    def schema(self) -> T.StructType | None:
        current = self._current()
        return _schema_of(current) if current else None

    def read(self) -> DataFrame:
        current = self._current()
        if current is None:
            raise ValueError(f"no table at {self.path}")
        return self._read(current)

    def _read(self, current, folders: Sequence[str] | None = None) -> DataFrame:
        return self._read_as(_schema_of(current), current.folders if folders is None else folders)

    def _read_as(self, schema: T.StructType, chosen: Sequence[str]) -> DataFrame:
        if not chosen:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in chosen])

    def changes(self, since: int) -> tuple[int, DataFrame, DataFrame]:
        """The version now, and what rows have gone and come since another one, as (version, gone, come).

        Only the folders that are in one of the two versions and not in the other are read. Rows that were merely written
        anew, as neighbours of rows that changed, are in both frames, so sums over ``come`` less sums over ``gone`` are exact.
        """
        now = self._current()
        if now is None:
            raise ValueError(f"no table at {self.path}")
        then = self._current(since)
        before, after = (then.folders if then else []), now.folders
        return now.version, self._read(now, [f for f in before if f not in set(after)]), self._read(now, [f for f in after if f not in set(before)])

    def rejected(self, tag: str) -> DataFrame:
        """A batch that did not pass its checks."""
        return self.spark.read.parquet(self._rejected(tag))

    def _rejected(self, tag: str) -> str:
        return f"{self.path}/rejected/{''.join(c if c.isalnum() or c in '-_.' else f'%{ord(c):02X}' for c in tag)}"

    def has_commit(self, tag: str) -> bool:
        """Whether a load of this tag was committed. Of ``<stream>#<number>`` tags the last commit knows the highest."""
        current = self._current()
        if current is None:
            return False
        stream, number = _stream_of(tag)
        if stream is not None and current.streams is not None:
            return current.streams.get(stream, -1) >= number
        return not self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/commits").filter(F.col("tag") == tag).isEmpty()

    # -- writing

    def replace(self, df: DataFrame, tag: str | None = None, lossy: bool = False, expected: int | None = None) -> None:
        """The table holds exactly these rows; columns it had before remain. They may be made for one ``expected`` version only."""
        current = self._current()
        if expected is not None and (current.version if current else 0) != expected:
            raise ConcurrentCommit(f"{self.path} is past version {expected}")
        schema = self._schema_for(df, current)
        self._commit(current, self._write(aligned(df, schema, lossy)), schema, tag)

    def append(self, df: DataFrame, tag: str | None = None, lossy: bool = False) -> None:
        current = self._current()
        schema = self._schema_for(df, current)
        before = list(current.folders) if current else []
        self._commit(current, [*before, *self._write(aligned(df, schema, lossy))], schema, tag)

    def merge(
        self,
        df: DataFrame,
        keys: Sequence[str],
        tag: str | None = None,
        lossy: bool = False,
        check: Callable[[DataFrame, DataFrame], None] | None = None,
    ) -> None:
        """See ``merged``. The batch is staged once, in the table's types, so what it is computed from is read once.

        A partitioned or bucketed table rewrites the parts the batch has rows
        for; the other table the folders that hold an arriving key, which a scan
        of the key columns finds. A batch of new keys is an append there.

        ``check`` sees the batch and the table as it would be, and raises if they may not be published. Then the table
        stays as it is, and the batch can be read by its tag.
        """
        if check is not None and tag is None:
            raise ValueError("a load that may be rejected needs a tag")
        current = self._current()
        if not keys:
            raise ValueError("a merge needs key columns")
        if self.part_columns and not {c.lower() for c in self.part_columns} <= {k.lower() for k in keys}:
            raise ValueError("the columns of partitions or buckets must be part of the merge key")
        schema = self._schema_for(df, current)
        path = new_dir(self.spark, "staging") if check is None else self._rejected(tag)
        aligned(df, schema, lossy, keys).write.mode("overwrite").parquet(path)
        staging = self.spark.read.schema(schema).parquet(path)
        folders = list(current.folders) if current else []
        touched = self._touched(current, folders, staging, keys) if folders else []
        others = [f for f in folders if f not in touched]
        rows = self._merged(current, touched, staging, keys) if touched else staging
        written = [*others, *self._write(rows)]
        if check is not None:
            try:
                check(staging, self._read_as(schema, written))
            except Exception as reason:
                raise Rejected(tag, reason) from reason
        self._commit(current, written, schema, tag)

    def _merged(self, current, touched: list[str], staging: DataFrame, keys: Sequence[str]) -> DataFrame:
        return merged(self._read(current, touched), staging, keys)

    def _part(self) -> Column:
        """The part of a row: a hash, so that any value, null too, is a folder name."""
        return F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in self.part_columns]), F.lit(self.buckets))

    def _touched(self, current, folders: list[str], staging: DataFrame, keys: Sequence[str]) -> list[str]:
        if self.part_columns:
            parts = {str(r[0]) for r in staging.select(self._part()).distinct().collect()}  # one name per part, never rows
            return [f for f in folders if f.rpartition(f"{PART}=")[2] in parts]
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/(data/[0-9a-f]{32})/", 1)
        present = self._read(current).select(*[F.col(quoted(k)) for k in keys], folder.alias("_folder"))
        # a few names, one per load since the last replace
        return [r[0] for r in with_matches(present, staging, keys).select("_folder").distinct().collect()]

    def load(self, df: DataFrame, mode: str = "replace", keys: Sequence[str] = (), tag: str | None = None, lossy: bool = False) -> None:
        if mode == "replace":
            self.replace(df, tag, lossy)
        elif mode == "append":
            self.append(df, tag, lossy)
        elif mode == "merge":
            self.merge(df, keys, tag, lossy)
        else:
            raise ValueError(f"unknown load mode: {mode}")

    def _schema_for(self, df: DataFrame, current) -> T.StructType:
        incoming = table_schema(df.schema)
        if current is None:
            return incoming
        return grown_schema(_schema_of(current), incoming)

    def _write(self, df: DataFrame) -> list[str]:
        """Writes the rows to a new folder; returns it, or the folders of its parts."""
        folder = f"data/{uuid.uuid4().hex}"
        if not self.part_columns:
            rows = clustered(df, self.sort_keys) if self.sort_keys else df
            rows.write.option("compression", "snappy").parquet(f"{self.path}/{folder}")
            return [folder]
        # Rebalanced by part, so that a part with a third of the rows is written by many tasks.
        rows = df.withColumn(PART, self._part()).hint("rebalance", F.col(PART))
        if self.sort_keys:
            rows = rows.sortWithinPartitions(PART, *self.sort_keys)
        rows.write.option("compression", "snappy").partitionBy(PART).parquet(f"{self.path}/{folder}")
        files, _ = self._log()
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        names = [f.getPath().getName() for f in files.listStatus(root)]
        return sorted(f"{folder}/{n}" for n in names if n.startswith(f"{PART}="))

    def _commit(self, seen, folders: list[str], schema: T.StructType, tag: str | None) -> None:
        """Publishes the next version, unless another writer has committed since this one looked."""
        versions = self._versions()
        known = seen.version if seen else 0
        if any(v > known and self._commit_of(v) is not None for v in versions):
            raise ConcurrentCommit(f"{self.path} is past version {known}")
        version = max([known, *versions]) + 1
        streams = dict(seen.streams or {}) if seen else {}
        stream, number = _stream_of(tag)
        if stream is not None:
            streams[stream] = max(number, streams.get(stream, -1))
        # An older table's commits do not say what its streams have done; has_commit then looks into all of them.
        told = None if seen and seen.streams is None else streams
        text = json.dumps({"version": version, "tag": tag, "folders": folders, "table_schema": schema.json(), "streams": told})
        files, path = self._log()
        fs = self.spark._jvm.org.apache.hadoop.fs
        whole, name = fs.Path(path, f"_{uuid.uuid4().hex}"), fs.Path(path, f"{version:012d}.json")
        out = files.create(whole, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            self._renamed(files.makeQualified(whole), files.makeQualified(name))
        except Py4JJavaError as error:
            if files.exists(name):
                raise ConcurrentCommit(f"{self.path} is past version {version - 1}") from error
            raise

    def _renamed(self, source, target) -> None:
        """A rename that fails where the target exists."""
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(source, target, self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))


def _stream_of(tag: str | None) -> tuple[str | None, int]:
    """The stream and number of a tag of a numbered batch."""
    stream, mark, number = (tag or "").rpartition("#")
    return (stream, int(number)) if mark and number.isdecimal() else (None, -1)


def load_dimension(
    table: SnapshotTable, records: DataFrame, schema: T.StructType, max_length: Mapping[str, int] | None = None
) -> None:
    """Replaces a dimension by its records, flattened and brought to the declared schema."""
    table.replace(to_declared(flatten_dimension(records), schema, max_length))
