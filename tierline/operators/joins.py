"""Joins and by-name unions.

No broadcast hint is used: Spark broadcasts a side when its size, known from
the files or measured at runtime, is below the session's threshold, and falls
back to a shuffle join whose skewed partitions adaptive execution splits (it
can for inner, left outer, semi and anti joins, which is all we use on data of
unbounded key frequency).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.shape import keep_first, quoted


@dataclass(frozen=True)
class Dimension:
    """A dimension of a star: its table, its key, and output name -> column."""

    table: DataFrame
    fact_key: str
    key: str
    columns: Mapping[str, str] = field(default_factory=dict)


def star_join(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Fact rows left-joined to every dimension.

    Facts without a match stay, a repeated dimension key repeats the fact, and
    a null key matches nothing.
    """

    def attach(left: DataFrame, step: tuple[int, Dimension]) -> DataFrame:
        number, dim = step
        key = f"_key_{number}"
        right = dim.table.select(
            F.col(quoted(dim.key)).alias(key),
            *[F.col(quoted(source)).alias(name) for name, source in dim.columns.items()],
        )
        return left.join(right, F.col(quoted(dim.fact_key)) == F.col(key), "left").drop(key)

    return reduce(attach, enumerate(dimensions), fact)


def without_matches(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose composite key does not occur in staging.

    A key with a null part equals nothing, so such rows stay.
    """
    return target.join(*_arriving(staging, keys), "left_anti")


def with_matches(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The other rows: those whose composite key occurs in staging."""
    return target.join(*_arriving(staging, keys), "left_semi")


def _arriving(staging: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """Distinct keys of staging, and when a target row has one of them."""
    arriving = staging.select(*[F.col(quoted(k)).alias(f"_arriving_{k}") for k in keys]).distinct()
    same_key = [F.col(quoted(k)) == F.col(quoted(f"_arriving_{k}")) for k in keys]
    return arriving, reduce(lambda a, b: a & b, same_key)


def new_columns(incoming: T.StructType, existing: T.StructType) -> list[T.StructField]:
    """Fields of ``incoming`` that ``existing`` lacks, ignoring case."""
    known = {f.name.lower() for f in existing}
    return [f for f in incoming if f.name.lower() not in known]


def concat(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, by column name; nothing is deduplicated."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def lookup_targets(
    rows: DataFrame, targets: DataFrame, on: str, target_key: str, columns: Mapping[str, str], first_by: Sequence[Column]
) -> tuple[DataFrame, DataFrame]:
    """Rows with the columns of the first target of their key, and the rest.

    Returns ``(found, skipped)``; together they hold every input row once.
    """
    first = keep_first(targets, [target_key], first_by, 1).select(
        F.col(quoted(target_key)).alias("_target_key"),
        *[F.col(quoted(source)).alias(name) for name, source in columns.items()],
    )
    same_key = F.col(quoted(on)) == F.col("_target_key")
    found = rows.join(first, same_key, "inner").drop("_target_key")
    skipped = rows.join(first.select("_target_key"), same_key, "left_anti")
    return found, skipped


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    owned: Sequence[str],
    seeds: Mapping[str, Column],
) -> DataFrame:
    """Rows of both sides, one per key.

    ``owned`` columns take the incoming value wherever an incoming row exists,
    also when it is null. All others keep the existing value; on a fresh row
    they take their seed, an expression that may name incoming columns as
    ``new.<column>``. ``incoming`` must hold one row per key.

    Existing rows are left-joined, and fresh ones are those without a match, so
    adaptive execution can split a key that very many existing rows share. Rows
    with a null in the key match nothing: existing ones stay, incoming ones are
    fresh. They pass the join beside it, as all of them would meet in one task.
    """
    complete = reduce(lambda a, b: a & b, [F.col(quoted(k)).isNotNull() for k in keys])
    new = incoming.filter(complete).withColumn("_new", F.lit(True)).alias("new")

    def pairs(old: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"old.{quoted(k)}") == F.col(f"new.{quoted(k)}") for k in keys])

    def updated(name: str) -> Column:
        before = F.col(f"old.{quoted(name)}")
        arrives = name in owned and name not in keys
        return F.when(F.col("new._new"), F.col(f"new.{quoted(name)}")).otherwise(before) if arrives else before

    def seeded(name: str) -> Column:
        return F.col(f"new.{quoted(name)}") if name in keys or name in owned else seeds.get(name, F.lit(None))

    old = existing.filter(complete).alias("old")
    # Rows of a key meet its one arriving row in a hash table, unsorted: what a task holds does not grow with a hot key.
    changed = old.join(new.hint("shuffle_hash"), pairs(old), "left").select(*[updated(c).alias(c) for c in existing.columns])
    # Only keys that arrive, each map task giving a key once: equal keys compress so well that no one sees the skew of their rows.
    # Where few keys arrive, Spark sends them to the rows and joins before it aggregates; then the existing rows are read, but not shuffled.
    known = existing.select(*[F.col(quoted(k)) for k in keys]).distinct()
    taken = known.alias("old").join(new, pairs(existing), "left_semi").alias("old")
    fresh = concat_all(new.join(taken, pairs(taken), "left_anti"), incoming.filter(~complete)).alias("new")
    rows = [existing.filter(~complete), changed, fresh.select(*[seeded(c).alias(c) for c in existing.columns])]
    return reduce(lambda a, b: a.unionByName(b), rows)


def concat_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by name, with the columns of the last."""
    return reduce(lambda a, b: a.unionByName(b), [f.select(*[F.col(quoted(c)) for c in frames[-1].columns]) for f in frames])
