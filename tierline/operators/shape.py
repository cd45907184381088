"""Turning nested, untidy batches into flat, typed columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPLEX = (T.StructType, T.ArrayType, T.MapType)


def quoted(*parts: str) -> str:
    """A column reference in which no character of a name is special."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def unique_names(names: Iterable[str]) -> list[str]:
    """Names made distinct, ignoring case, by ``_2``, ``_3`` … in order."""
    names = list(names)
    reserved = {n.lower() for n in names}
    used: set[str] = set()
    result = []
    for name in names:
        candidate, n = name, 1
        while candidate.lower() in used or (n > 1 and candidate.lower() in reserved):
            n += 1
            candidate = f"{name}_{n}"
        used.add(candidate.lower())
        result.append(candidate)
    return result


def _as_text(column: Column, dtype: T.DataType) -> Column:
    return F.to_json(column) if isinstance(dtype, COMPLEX) else column


def flatten(df: DataFrame) -> DataFrame:
    """Struct leaves as columns named by their path, arrays and maps as JSON text.

    Leaves of a struct follow the columns that were already there, level by
    level, to the last. Only the schema is walked here; the data sees a single
    projection.
    """
    level = [((f.name,), f.dataType) for f in df.schema]
    while any(isinstance(t, T.StructType) for _, t in level):
        plain = [item for item in level if not isinstance(item[1], T.StructType)]
        opened = [
            (path + (child.name,), child.dataType)
            for path, dtype in level
            if isinstance(dtype, T.StructType)
            for child in dtype
        ]
        level = plain + opened
    names = unique_names("_".join(path) for path, _ in level)
    return df.select(
        *[
            _as_text(F.col(quoted(*path)), dtype).alias(name)
            for (path, dtype), name in zip(level, names)
        ]
    )


def primitive_only(df: DataFrame) -> DataFrame:
    """Any column that is still nested becomes JSON text."""
    return df.select(*[_as_text(F.col(quoted(f.name)), f.dataType).alias(f.name) for f in df.schema])


def rename(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return df.toDF(*unique_names(rule(c) for c in df.columns))


# fixed values: characters that become an underscore in column names
NAME_SEPARATORS = "/ .-"


def tidy_name(name: str) -> str:
    return name.translate({ord(c): "_" for c in NAME_SEPARATORS}).lower()


def tidy_names(df: DataFrame) -> DataFrame:
    return rename(df, tidy_name)


def trim_strings(df: DataFrame) -> DataFrame:
    """Leading and trailing spaces off every text column (tabs stay)."""
    return df.select(
        *[
            (F.trim(F.col(quoted(f.name))) if isinstance(f.dataType, T.StringType) else F.col(quoted(f.name))).alias(f.name)
            for f in df.schema
        ]
    )


def null_counts(df: DataFrame) -> DataFrame:
    """One row: nulls per column, and ``_rows``; a single map-side aggregation."""
    return df.select(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in df.columns],
    )


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Without the columns that are null in every row; an empty batch stays as is.

    The columns of the result depend on the data, so this one has to run a job:
    one pass that brings a single row of counts to the driver.
    """
    if not df.columns:
        return df
    rows, *nulls = null_counts(df).first()
    if rows == 0:
        return df
    return df.drop(*[F.col(quoted(c)) for c, n in zip(df.columns, nulls) if n == rows])


def dedup(df: DataFrame, key: str | Sequence[str], latest_by: Sequence[Column] = ()) -> DataFrame:
    """One row per key; nulls count as one key; untouched if a key column is missing.

    ``latest_by`` says which row stays (first in that order). Spark drops the
    losers of every map task before the shuffle (window group limit), so a key
    with very many rows sends only one row per task. Rows that are equal in that
    order, or all without one, are ordered by a hash of the row, and by its columns
    where that is equal, so the same row stays when a task runs again.
    """
    keys = [key] if isinstance(key, str) else list(key)
    present = {c.lower() for c in df.columns}
    if not all(k.lower() in present for k in keys):
        return df
    return keep_first(df, keys, [*latest_by, *_any_order(df)], 1)


def _any_order(df: DataFrame) -> list[Column]:
    """An order of whole rows. Hashes pass over nulls, so their places are hashed too; maps have neither hash nor order, but a text."""

    def plain(dtype: T.DataType) -> bool:
        if isinstance(dtype, T.ArrayType):
            return plain(dtype.elementType)
        if isinstance(dtype, T.StructType):
            return all(plain(f.dataType) for f in dtype)
        return not isinstance(dtype, (T.MapType, T.VariantType))

    own = [F.col(quoted(f.name)) if plain(f.dataType) else F.to_json(F.struct(F.col(quoted(f.name)))) for f in df.schema]
    return [F.xxhash64(F.array(*[F.col(quoted(c)).isNull() for c in df.columns]), *own), *own]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of every key, optionally with their position."""
    position = rank or "_position"
    ranked = df.withColumn(
        position, F.row_number().over(Window.partitionBy(*[F.col(quoted(k)) for k in keys]).orderBy(*order))
    ).filter(F.col(position) <= n)
    return ranked if rank else ranked.drop(position)


def add_literals(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def processed_lineage(df: DataFrame, execution_id: str, ingestion_time: str, pipeline: str, country: str, processed_at: str) -> DataFrame:
    return add_literals(
        df,
        {
            "_pipeline_execution_id": execution_id,
            "_ingestion_timestamp": ingestion_time,
            "_pipeline_name": pipeline,
            "_country": country,
            "_processed_at": processed_at,
        },
    )


def curated_lineage(df: DataFrame, execution_id: str, curated_at: str) -> DataFrame:
    return add_literals(df, {"_curated_at": curated_at, "_curated_execution_id": execution_id})


def with_declared_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds the declared columns a batch did not bring, as typed nulls."""
    present = {c.lower() for c in df.columns}
    return df.select(
        "*",
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name.lower() not in present],
    )


def to_declared(df: DataFrame, schema: T.StructType, max_length: Mapping[str, int] | None = None) -> DataFrame:
    """Exactly the declared columns: matched ignoring case, cast, cut to length.

    Columns the schema does not know are ignored, missing ones are null. The
    length counts characters.
    """
    present = {c.lower(): c for c in df.columns}
    limits = max_length or {}

    def column(field: T.StructField) -> Column:
        if field.name.lower() not in present:
            return F.lit(None).cast(field.dataType)
        value = F.col(quoted(present[field.name.lower()])).try_cast(field.dataType)
        return F.left(value, F.lit(limits[field.name])) if field.name in limits else value

    return df.select(*[column(f).alias(f.name) for f in schema])


def flatten_dimension(df: DataFrame) -> DataFrame:
    """Dimension records: leaves named by lowercased path, lists as JSON text."""
    return rename(flatten(df), str.lower)
