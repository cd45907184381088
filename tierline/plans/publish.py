"""The publish job: monthly report to the update table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row

from tierline.operators.incremental import run_unless_empty
from tierline.operators.reports import indicator_rows
from tierline.sinks import publish
from tierline.sinks.tables import SnapshotTable
from tierline.workspace import checkpointed


def publish_monthly(
    report: DataFrame, targets: DataFrame, updates: SnapshotTable, updater: str, as_of: Column, tag: str | None = None
) -> Row | None:
    """Upserts the report's indicators; how many were written and skipped.

    The report is an aggregate over everything curated, so it is computed once
    and checkpointed; counting and publishing then read a few rows. ``updates``
    must exist. None for an empty report.
    """

    def run(rows: DataFrame) -> Row:
        values, _ = publish.monthly_values(rows, targets)
        batch = publish.monthly_batch(values, updater, as_of)
        updates.replace(publish.upsert_monthly(updates.read(), batch), tag)
        return publish.publish_counts(rows, targets).first()

    return run_unless_empty(checkpointed(indicator_rows(report)), run)
