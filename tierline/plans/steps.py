"""SQL texts over named DataFrames.

Names are only registered while a statement is analysed, so two runs in one
session do not see each other's steps.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the names SQL texts use for their input
CLEANING_SOURCE = "source_data"
CURATING_SOURCE = "processed_data"
STEP_SOURCE = "__TABLE__"
STEP_MARKER = "-- transform_"

_MARKED = re.compile(r"^[ \t]*-- (transform_[^\n]*)$", re.MULTILINE)
_NOT_SQL = re.compile(r"^[ \t]*(--[^\n]*)?(\n|$)", re.MULTILINE)
INPUT_NAMES = (CLEANING_SOURCE, CURATING_SOURCE, STEP_SOURCE)

_naming = threading.Lock()


def run_sql(df: DataFrame, text: str) -> DataFrame:
    """One statement over ``df`` under any of the agreed input names.

    The names are views only while the statement is analysed, which happens at
    once, so literals, comments and aliases of the same name stay as they are
    and other runs of the session do not see this batch.
    """
    spark = df.sparkSession
    with _naming:
        before = {n: spark.table(n) for n in INPUT_NAMES if spark.catalog.tableExists(n)}
        for name in INPUT_NAMES:
            df.createOrReplaceTempView(name)
        try:
            return spark.sql(text.strip().rstrip(";"))
        finally:
            for name in INPUT_NAMES:
                spark.catalog.dropTempView(name)
                if name in before:
                    before[name].createOrReplaceTempView(name)


def split_steps(text: str) -> list[tuple[str, str]]:
    """Name and statement of every marked step; comments and blank lines go.

    Text before the first marker is not part of any step, and a marker without
    a statement is none.
    """
    parts = _MARKED.split(text)[1:]
    named = zip((p.strip() for p in parts[::2]), (_NOT_SQL.sub("", p).strip() for p in parts[1::2]))
    return [(name, sql) for name, sql in named if sql]


def run_steps(df: DataFrame, text: str | None) -> DataFrame:
    """Every step over the result of the one before, in a single plan.

    Without markers the text is one statement, without text the batch passes.
    """
    if not text or not text.strip():
        return df
    steps = split_steps(text)
    if not steps:
        return run_sql(df, text)
    for _, sql in steps:
        df = run_sql(df, sql)
    return df


def stamped(df: DataFrame, name: str = "_cleaned_at", at: Column | None = None) -> DataFrame:
    return df.withColumn(name, F.current_timestamp() if at is None else at)


def with_snapshot_date(df: DataFrame, day: Column | None = None) -> DataFrame:
    return df.withColumn("snapshot_date", F.current_date() if day is None else day)


def refresh_views(
    spark: SparkSession, definitions: Mapping[str, str | Callable[[SparkSession], DataFrame]], select: str | None = None
) -> list[str]:
    """(Re)creates views in name order; names not containing ``select`` are left.

    A definition is a query text or a function of the session; empty texts are
    skipped. A view may use those before it. Returns the names done.
    """
    done = []
    for name in sorted(definitions):
        definition = definitions[name]
        if select and select not in name:
            continue
        if isinstance(definition, str):
            if not definition.strip():
                continue
            frame = spark.sql(definition.strip().rstrip(";"))
        else:
            frame = definition(spark)
        frame.createOrReplaceTempView(name)
        done.append(name)
    return done


def read_statements(spark: SparkSession, path: str, pattern: str = "*.sql") -> list[tuple[str, str]]:
    """(name, text) of the SQL files of a folder, or of one file, in name order; empty ones are left out."""
    files = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).text(path)
    named = files.select(F.regexp_extract("_metadata.file_name", r"^(.*?)(?:\.[^.]*)?$", 1).alias("name"), F.trim("value").alias("text"))
    # a folder of statements, never data
    return [(r.name, r.text) for r in named.filter("text <> ''").orderBy("name").collect()]


def refresh_views_from(spark: SparkSession, path: str, pattern: str = "*.sql") -> list[str]:
    """(Re)creates a view for every SQL file of a folder, named like the file, in name order."""
    return refresh_views(spark, dict(read_statements(spark, path, pattern)))


def load_with_statements(
    load: Callable[[], None],
    spark: SparkSession,
    before: Sequence[tuple[str, str] | str] = (),
    after: Sequence[tuple[str, str] | str] = (),
) -> list[str]:
    """A load between two lists of (view name, query) or paths of SQL files, each run in its order."""

    def run(items: Sequence[tuple[str, str] | str]) -> list[str]:
        done = []
        for item in items:
            for name, query in read_statements(spark, item) if isinstance(item, str) else [item]:
                done += refresh_views(spark, {name: query})
        return done

    first = run(before)
    load()
    return first + run(after)
