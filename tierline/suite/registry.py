"""Name -> query, and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None
    covers: tuple[str, ...]


ENTRIES: dict[str, Entry] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its own name; ``covers`` lists operator ids."""

    def register(run: Query) -> Query:
        if run.__name__ in ENTRIES:
            raise ValueError(f"query {run.__name__} is registered twice")
        ENTRIES[run.__name__] = Entry(run, sql, tuple(covers.split()))
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
