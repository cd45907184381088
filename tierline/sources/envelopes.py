"""Records out of landed response documents.

Documents are rows of a DataFrame as the JSON scan gives them. What a response
looks like is read off the schema; where documents of several kinds were
landed together, each one is treated by the containers it has itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.shape import COMPLEX, quoted

# fixed values: containers tried in this order
GENERIC_CONTAINERS = ("results", "data")
SURVEY_CONTAINERS = ("results",)
TRACKER_CONTAINERS = ("rows", "dataValues", "trackedEntityInstances", "events")


def _field(schema: T.DataType, name: str) -> T.StructField | None:
    if isinstance(schema, T.StructType):
        for candidate in schema:
            if candidate.name == name:
                return candidate
    return None


def _records(docs: DataFrame, items: Column, dtype: T.DataType) -> DataFrame:
    """The elements of an array as rows, null elements too, or a single object."""
    if isinstance(dtype, T.ArrayType):
        element, rows = dtype.elementType, docs.select(F.explode(items).alias("record"))
    else:
        element, rows = dtype, docs.select(items.alias("record")).filter("record IS NOT NULL")
    if isinstance(element, T.StructType):
        return rows.select("record.*")
    return rows.select(F.col("record").alias("value"))


def explode_results(docs: DataFrame, container: str = "results") -> DataFrame:
    """One row per element if there is such a column, else the frame itself."""
    field = _field(docs.schema, container)
    return docs if field is None else _records(docs, F.col(quoted(container)), field.dataType)


def at_path(docs: DataFrame, path: str) -> DataFrame:
    """Records at a dotted path; a path that leads nowhere gives no rows."""
    dtype: T.DataType = docs.schema
    parts = path.split(".")
    for part in parts:
        field = _field(dtype, part)
        if field is None:
            return docs.limit(0)
        dtype = field.dataType
    return _records(docs, F.col(quoted(*parts)), dtype)


def first_container(
    docs: DataFrame, containers: Sequence[str] = GENERIC_CONTAINERS, columns: Sequence[str] | None = None
) -> DataFrame:
    """Records of the first container a document has, else the document itself.

    The documents are scanned once whatever kinds are among them. With
    ``columns`` exactly these come out, as text; header/row documents need
    them. Otherwise the columns are those of all containers together, text
    where their types differ.
    """
    rest = {f.name: (F.col(quoted(f.name)), f.dataType) for f in docs.schema if f.name not in containers}
    kinds = [_Kind.of(docs, name, columns) for name in containers if _field(docs.schema, name) is not None]
    if not kinds:
        return docs if columns is None else docs.select(_as_record(rest, _text(columns)).alias("record")).select("record.*")
    wanted = _text(columns) if columns is not None else _all_fields([k.fields for k in kinds] + [{n: t for n, (_, t) in rest.items()}])

    records = None
    for kind in kinds:
        mine = kind.records(wanted)
        records = F.when(kind.present, mine) if records is None else records.when(kind.present, mine)
    if rest:
        records = records.otherwise(F.array(_as_record(rest, wanted)))
    return docs.select(F.explode(records).alias("record")).select("record.*")


def _text(columns: Sequence[str]) -> dict[str, T.DataType]:
    return {c: T.StringType() for c in columns}


def _all_fields(parts: Sequence[dict[str, T.DataType]]) -> dict[str, T.DataType]:
    result: dict[str, T.DataType] = {}
    for part in parts:
        for name, dtype in part.items():
            result[name] = dtype if result.get(name, dtype) == dtype else T.StringType()
    return result


def _as_record(values: dict[str, tuple[Column, T.DataType]], wanted: dict[str, T.DataType]) -> Column:
    """A struct of the wanted fields; null where there is no such value."""

    def field(name: str, dtype: T.DataType) -> Column:
        if name not in values:
            return F.lit(None).cast(dtype)
        value, own = values[name]
        if own == dtype:
            return value
        return F.to_json(value) if isinstance(own, COMPLEX) else value.cast(dtype)

    return F.struct(*[field(n, t).alias(n) for n, t in wanted.items()])


@dataclass(frozen=True)
class _Kind:
    """Documents of one kind: how to tell them, and their records."""

    present: Column
    fields: dict[str, T.DataType]
    records: Callable[[dict[str, T.DataType]], Column]

    @staticmethod
    def of(docs: DataFrame, name: str, columns: Sequence[str] | None) -> _Kind:
        content, dtype = F.col(quoted(name)), _field(docs.schema, name).dataType
        items = content if isinstance(dtype, T.ArrayType) else F.array(content)
        element = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
        if name == "rows" and isinstance(element, T.ArrayType):
            places = _places(docs.schema, columns or ())
            fields = dict.fromkeys(columns or (), element.elementType)

            def values(item: Column) -> dict[str, tuple[Column, T.DataType]]:
                return {c: (F.try_element_at(item, p), element.elementType) for c, p in places.items()}

        elif isinstance(element, T.StructType):
            fields = {f.name: f.dataType for f in element}

            def values(item: Column) -> dict[str, tuple[Column, T.DataType]]:
                return {f.name: (item[f.name], f.dataType) for f in element}

        else:
            fields = {"value": element}

            def values(item: Column) -> dict[str, tuple[Column, T.DataType]]:
                return {"value": (item, element)}

        return _Kind(
            content.isNotNull(), fields, lambda wanted: F.transform(items, lambda item: _as_record(values(item), wanted))
        )


def _places(schema: T.StructType, columns: Sequence[str], headers: str = "headers") -> dict[str, Column]:
    """Where in a row the cell of each column is; null if there is no such header."""
    header_type = _field(schema, headers).dataType.elementType

    def label(header: Column, position: Column) -> Column:
        named = [header[n] for n in ("name", "column") if _field(header_type, n) is not None]
        return F.coalesce(*named, F.concat(F.lit("col_"), position))

    names = F.transform(F.col(quoted(headers)), label)

    def place(name: str) -> Column:
        from_end = F.array_position(F.reverse(names), name)
        return F.when(from_end > 0, F.size(names) - from_end + 1).cast("int")

    return {c: place(c) for c in columns}


def zip_rows(docs: DataFrame, columns: Sequence[str], headers: str = "headers", rows: str = "rows") -> DataFrame:
    """Header list and row arrays to records with the declared ``columns``.

    A header is called by its ``name``, else its ``column``, else ``col_<i>``;
    of two equal ones the later counts. Cells beyond the headers are ignored,
    missing ones are null. Headers are looked up once per document.
    """
    places = _places(docs.schema, columns, headers)
    cells = docs.select(
        F.array(*[places[c] for c in columns]).alias("places"), F.explode(F.col(quoted(rows))).alias("cells")
    )
    return cells.select(*[F.try_element_at("cells", F.col("places")[i]).alias(c) for i, c in enumerate(columns)])


def dimension_records(docs: DataFrame, response_key: str) -> DataFrame:
    """The array under the configured key; no rows if there is none."""
    return at_path(docs, response_key)
