"""The load stage of a pipeline: merge, views, watermark, checks, verdict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.operators import quality
from tierline.operators.shape import quoted
from tierline.plans.steps import refresh_views
from tierline.sinks.tables import SnapshotTable


@dataclass(frozen=True)
class Loaded:
    rows: int
    watermark: Any
    verdict: str


def load(
    table: SnapshotTable,
    batch: DataFrame,
    keys: Sequence[str],
    tag: str | None = None,
    watermark: str | None = None,
    views: Mapping[str, str] | None = None,
    checks: Sequence[Mapping[str, Any]] = (),
    view_name: str | None = None,
    batch_checks: Sequence[Mapping[str, Any]] | None = None,
) -> Loaded:
    """Merges a batch and returns the table's size, its highest ``watermark`` value and the verdict of the checks.

    A tag that the table has seen is not loaded again. ``views`` may use the table as ``view_name``. Checks that fail
    raise after the load, as the rows are already visible to those who look into them. With ``batch_checks``, of the
    batch alone, both are made before the commit: a batch that fails is never seen, and stays readable by its tag.
    """
    if tag is None or not table.has_commit(tag):
        table.merge(batch, keys, tag, check=None if batch_checks is None else _passes(batch_checks, checks))
    state = table.read()
    if view_name:
        state.createOrReplaceTempView(view_name)
    refresh_views(table.spark, views or {})
    mark = F.max(F.col(quoted(watermark))) if watermark else F.lit(None)
    found = state.agg(F.count(F.lit(1)).alias("n"), mark.alias("mark")).first()
    return Loaded(found.n, found.mark, quality.require(quality.run_checks(state, checks)))


def _passes(of_batch: Sequence[Mapping[str, Any]], of_table: Sequence[Mapping[str, Any]]):
    def check(batch: DataFrame, state: DataFrame) -> None:
        quality.require(quality.run_checks(batch, of_batch))
        quality.require(quality.run_checks(state, of_table))

    return check
