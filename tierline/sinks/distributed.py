"""Keyed tables whose rows lie by a hash of their key, as Spark knows.

Every folder of such a table is a bucketed Parquet table: one file per bucket,
found by the same hash that a shuffle uses. So a join or aggregation on the key
reads bucket by bucket and shuffles the other side only, a union of folders
keeps the buckets, and a merge writes what stays of a bucket and what arrives
for it in one task, without moving the table.

The distribution is fixed when the table is made. A bucket is read by one task,
so a key that a large share of rows has makes one large bucket: such a table is
better dealt to parts (``SnapshotTable``), whose joins adaptive execution splits.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierline.operators.joins import concat, without_matches
from tierline.operators.shape import quoted
from tierline.sinks.tables import SnapshotTable, aligned


class DistributedTable(SnapshotTable):
    """A ``SnapshotTable`` distributed by ``keys`` over ``buckets``, the same for every writer; files are sorted by ``sort_keys``.

    Spark reads buckets of tables only, so folders are registered in the session's catalogue, as external tables whose
    names begin with ``tierline_``; dropping those leaves the data. Readers in other sessions register them anew.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int, sort_keys: Sequence[str] = (), one_writer: bool = False):
        if not keys:
            raise ValueError("a distributed table needs keys")
        super().__init__(spark, path, sort_keys or keys, bucket_by=keys, buckets=buckets, one_writer=one_writer)

    def merge(self, df, keys=(), tag=None, lossy=False, check=None) -> None:
        """``SnapshotTable.merge`` by the distribution keys, in which the rows of the table are not shuffled."""
        if {k.lower() for k in keys or self.part_columns} != {k.lower() for k in self.part_columns}:
            raise ValueError("a distributed table is merged by the keys that distribute it")
        super().merge(df, self.part_columns, tag, lossy, check)

    def _touched(self, current, folders: list[str], staging: DataFrame, keys: Sequence[str]) -> list[str]:
        return folders

    def _merged(self, current, touched: list[str], staging: DataFrame, keys: Sequence[str]) -> DataFrame:
        arriving = self._dealt(staging)
        target = aligned(self._read(current, touched), staging.schema)
        return concat(without_matches(target, staging, keys), arriving)

    def _dealt(self, df: DataFrame) -> DataFrame:
        """One partition for each bucket; nothing is done to rows that lie so."""
        return df.repartition(self.buckets, *[quoted(k) for k in self.part_columns])

    def _write(self, df: DataFrame) -> list[str]:
        folder = f"data/{uuid.uuid4().hex}"
        own = {c.lower(): c for c in df.columns}
        by, order = ([own[k.lower()] for k in names] for names in (self.part_columns, self.sort_keys))
        writer = self._dealt(df).write.format("parquet").option("path", f"{self.path}/{folder}").option("compression", "snappy")
        writer.bucketBy(self.buckets, *by).sortBy(*order).saveAsTable(f"tierline_{folder.removeprefix('data/')}")
        return [folder]

    def _read_as(self, schema: T.StructType, chosen: Sequence[str]) -> DataFrame:
        if not chosen:
            return super()._read_as(schema, chosen)
        return concat(*[self.spark.table(self._registered(schema, folder)) for folder in chosen])

    def _registered(self, schema: T.StructType, folder: str) -> str:
        """The name of a folder as a table of these columns; those it lacks are null."""
        name = f"tierline_{folder.removeprefix('data/')}_{zlib.crc32(schema.json().encode()):08x}"
        if not self.spark.catalog.tableExists(name):
            own = {f.name.lower(): f.name for f in schema}
            columns = self.spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json()).toDDL()
            keys = ", ".join(quoted(own[k.lower()]) for k in self.part_columns)
            location = re.sub(r"(['\\])", r"\\\1", f"{self.path}/{folder}")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{location}'"
            )
        return name
