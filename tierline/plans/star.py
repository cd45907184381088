"""The star pipeline as one plan: dimensions and facts from their envelopes to the joined view."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from tierline.operators.joins import Dimension, star_join
from tierline.plans import batch
from tierline.plans.load import Loaded, load
from tierline.sinks.tables import SnapshotTable, load_dimension
from tierline.sources.envelopes import dimension_records, zip_rows


@dataclass(frozen=True)
class StarDimension:
    """Where a dimension comes from and goes to, and what it adds to the view (output name -> column)."""

    documents: DataFrame
    response_key: str
    table: SnapshotTable
    schema: T.StructType
    fact_key: str
    columns: Mapping[str, str]
    key: str = "id"
    max_length: Mapping[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Star:
    """The fact table, its key, the columns of its rows-and-headers documents, and its dimensions."""

    facts: SnapshotTable
    keys: Sequence[str]
    columns: Sequence[str]
    dimensions: Sequence[StarDimension]
    watermark: str | None = None
    checks: Sequence[Mapping[str, Any]] = ()
    values: Mapping[str, Column] = field(default_factory=dict)


def load_star(star: Star, documents: DataFrame, run: batch.Run) -> Loaded:
    """Replaces the dimensions, then merges the facts of a run; dimensions come first, as the view joins them.

    ``values`` are expressions over the texts of a fact that give its typed columns. A run that comes again is not loaded again.
    """
    for dimension in star.dimensions:
        records = dimension_records(dimension.documents, dimension.response_key)
        load_dimension(dimension.table, records, dimension.schema, dimension.max_length)
    rows = zip_rows(documents, star.columns)
    clean = batch.processed(rows, run, dedup_key=list(star.keys), drop_nulls=False)
    facts = batch.curated(clean.withColumns(dict(star.values)), run)
    return load(star.facts, facts, star.keys, run.execution_id, star.watermark, checks=star.checks)


def view(star: Star) -> DataFrame:
    """All facts with the columns of their dimensions; facts without a match stay."""
    return star_join(star.facts.read(), [Dimension(d.table.read(), d.fact_key, d.key, d.columns) for d in star.dimensions])
