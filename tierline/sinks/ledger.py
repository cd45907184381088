"""The columns and types each run brought, so that reading all runs needs no file footers.

A run adds one small file beside the layer. The union of all runs is folded from
these rows: a column keeps its first name and place, nested types are merged,
and a column that two runs hold in types that do not go together is an error
that names the runs.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.workspace import path_exists

LEDGER_SCHEMA = "run string, finished string, place int, name string, type string"


class SchemaConflict(ValueError):
    """Two runs hold one column in types that cannot be merged."""


def record(spark: SparkSession, path: str, run: str, finished: str, schema: T.StructType) -> None:
    """Adds the columns of a run. Recording a run again changes nothing, as equal columns fold to one."""
    rows = [(run, finished, k, f.name, json.dumps(f.dataType.jsonValue())) for k, f in enumerate(schema)]
    spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1).write.mode("append").json(path)


def entries(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).json(path)


def columns(ledger: DataFrame) -> DataFrame:
    """(name, type, first, last, run): each type a column was ever brought in, with its first and last run."""
    at = F.struct("finished", "run", "place")
    return ledger.groupBy(F.lower("name").alias("key"), "type").agg(
        F.min_by("name", at).alias("name"), F.min(at).alias("first"), F.max(at).alias("last")
    )


def _merged(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The type both fit into as Parquet readers see it; None if there is none."""
    if one == other:
        return one
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        own = {f.name.lower(): f for f in one}
        for field in other:
            known = own.get(field.name.lower())
            both = _merged(known.dataType, field.dataType) if known else field.dataType
            if both is None:
                return None
            own[field.name.lower()] = T.StructField(known.name if known else field.name, both)
        return T.StructType(list(own.values()))
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        element = _merged(one.elementType, other.elementType)
        return element and T.ArrayType(element)
    if isinstance(one, T.MapType) and isinstance(other, T.MapType):
        key, value = _merged(one.keyType, other.keyType), _merged(one.valueType, other.valueType)
        return T.MapType(key, value) if key and value else None
    if isinstance(one, T.DecimalType) and isinstance(other, T.DecimalType) and one.scale == other.scale:
        return T.DecimalType(max(one.precision, other.precision), one.scale)
    return None


def _nullable(dtype: T.DataType) -> T.DataType:
    """The type as files give it back: anything may be null."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_nullable(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(_nullable(dtype.keyType), _nullable(dtype.valueType))
    return dtype


def union_schema(ledger: DataFrame) -> T.StructType:
    """The columns of all runs, in the order in which they came.

    Brings one row per column and type to the driver: the schema's size, whatever the number of runs.
    """
    found: dict[str, tuple[str, T.DataType, str]] = {}
    for row in columns(ledger).sort("first").collect():
        dtype = _nullable(T._parse_datatype_json_string(row.type))
        if row.key not in found:
            found[row.key] = (row.name, dtype, row.first.run)
            continue
        name, known, run = found[row.key]
        both = _merged(known, dtype)
        if both is None:
            raise SchemaConflict(
                f"column {name} is {known.simpleString()} since run {run} and {dtype.simpleString()} in run {row.first.run} to {row.last.run}"
            )
        found[row.key] = (name, both, run)
    return T.StructType([T.StructField(name, dtype) for name, dtype, _ in found.values()])
