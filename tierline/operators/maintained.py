"""KPI reports kept up to date from what changes in their table.

A report is held as sums that can be taken back: rows, and for every flag its
sum, its answers and its hits, per group. What a load took out of the table
counts against them, what it put in counts for them. Percentages are made from
the sums when the report is read, so they are those of the full report. A
refresh reads the parts of the table that loads have written since the last
one; its state has one row per group and names the version it is at, so a
refresh that dies or comes twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.calendar import year_quarter_label
from tierline.functions.indicators import has_committee
from tierline.operators import reports
from tierline.operators.joins import concat
from tierline.operators.shape import quoted
from tierline.sinks.tables import SnapshotTable

ROWS = "rows"
VERSION = "base"


@dataclass(frozen=True)
class Report:
    """Groups, the flags that are summed (label -> expression), and output name -> (measure, label)."""

    groups: Sequence[str]
    flags: Mapping[str, Column]
    measures: Mapping[str, tuple[str, str]]
    derived: Mapping[str, Column] = field(default_factory=dict)


def fiscal_quarter() -> Report:
    flags = {source: F.col(source) for source in reports.ALWAYS_SET.values()}
    flags |= {source: F.col(source) for source, _ in reports.MAYBE_UNANSWERED.values()}
    flags["has_chc"] = has_committee()
    measures = {"total_surveyed": ("rows", "")}
    for label, source in reports.ALWAYS_SET.items():
        measures |= {f"n_{label}": ("sum", source), f"pct_{label}": ("percentage", source)}
    for label, (source, denominator) in reports.MAYBE_UNANSWERED.items():
        measures |= {f"n_{label}": ("hits", source), denominator: ("answered", source), f"pct_{label}": ("percentage", source)}
    measures |= {"n_has_chc": ("sum", "has_chc"), "pct_has_chc": ("percentage", "has_chc")}
    label = year_quarter_label(F.col("fy_year"), F.col("fy_quarter"))
    return Report(("fy_year", "fy_quarter", "county_label", "managed_county"), flags, measures, {"fy_year_quarter": label})


def calendar_month() -> Report:
    flags = {c: F.col(c) for c in ("correct_ontime", "correct_ontime_fy26", "lifesaving_instock", "two_plusvisits")}
    flags["has_chc"] = has_committee()
    sums = ("correct_ontime", "correct_ontime_fy26", "has_chc", "lifesaving_instock")
    measures = {"total_surveyed": ("rows", ""), **{f"n_{c}": ("sum", c) for c in sums}}
    measures |= {"n_two_plusvisits": ("hits", "two_plusvisits"), "d_two_plusvisits": ("answered", "two_plusvisits")}
    return Report(("cy_year", "cy_month", "managed_county"), flags, measures)


def partials(rows: DataFrame, report: Report, sign: int = 1) -> DataFrame:
    """The sums of each group, counted for (1) or against (-1) it; one partial row per group and task is shuffled."""
    one = F.lit(sign).cast("long")
    sums = [(F.count(F.lit(1)) * one).alias(ROWS)]
    for label, flag in report.flags.items():
        sums += [
            (F.coalesce(F.sum(flag.cast("long")), F.lit(0)) * one).alias(f"sum_{label}"),
            (F.count(flag) * one).alias(f"answered_{label}"),
            (F.count_if(flag == 1) * one).alias(f"hits_{label}"),
        ]
    return rows.groupBy(*[F.col(quoted(g)) for g in report.groups]).agg(*sums)


def folded(parts: DataFrame, report: Report) -> DataFrame:
    """Partial sums added up; groups without rows are gone."""
    sums = [c for c in parts.columns if c not in report.groups]
    return parts.groupBy(*[F.col(quoted(g)) for g in report.groups]).agg(*[F.sum(c).alias(c) for c in sums]).filter(F.col(ROWS) != 0)


def finished(state: DataFrame, report: Report) -> DataFrame:
    """The report of folded sums; a sum or percentage of a flag nobody answered is null."""

    def value(kind: str, label: str) -> Column:
        if kind == "rows":
            return F.col(ROWS)
        answers = F.col(f"answered_{label}")
        if kind == "answered":
            return answers
        if kind == "hits":
            return F.col(f"hits_{label}")
        total = F.when(answers != 0, F.col(f"sum_{label}"))
        return total if kind == "sum" else F.round(total.cast("double") / answers.cast("double") * 100, 1)

    named = [value(*measure).alias(name) for name, measure in report.measures.items()]
    return state.select(*[F.col(quoted(g)) for g in report.groups], *named).withColumns(dict(report.derived))


class MaintainedReport:
    """A report of a table, whose sums are a small table of their own."""

    def __init__(self, base: SnapshotTable, path: str, report: Report) -> None:
        self.base, self.report = base, report
        self.state = SnapshotTable(base.spark, path)

    def at(self) -> int:
        """The version of the table that the sums are of."""
        current = self.state.tag()
        return int(current.removeprefix(f"{VERSION}:")) if current else 0

    def refresh(self) -> int:
        """Adds what has changed since; returns the version the report is at. Two refreshes at once: one gets ``ConcurrentCommit``.

        Rows of the table that lack a column of the report, as it came later, count as unanswered there.
        """
        seen, at = self.state.version(), self.at()
        now, gone, come = self.base.changes(at)
        if now == at:
            return now
        parts = concat(partials(come, self.report), partials(gone, self.report, -1))
        known = concat(self.state.read(), parts) if self.state.exists() else parts
        self.state.replace(folded(known, self.report), tag=f"{VERSION}:{now}", expected=seen)
        return now

    def read(self) -> DataFrame:
        return finished(self.state.read(), self.report)
