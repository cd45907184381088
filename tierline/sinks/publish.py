"""Publishing report rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.indicators import percentage, status
from tierline.operators.joins import lookup_targets, upsert
from tierline.operators.shape import keep_first, primitive_only, quoted

UPDATE_KEYS = ("okrId", "month", "year")
OWNED = ("numerator", "denominatorOverride", "value", "status", "updatedByEmail", "updatedAt")


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, nested ones as JSON."""
    flat = primitive_only(df)
    return flat.select(*[F.col(quoted(c)).cast("string").alias(c) for c in flat.columns])


def publish_files(df: DataFrame, path: str, write_mode: str = "replace") -> str:
    """All rows as text into a folder; ``skipped`` for an empty batch."""
    if df.isEmpty():
        return "skipped"
    as_text(df).write.mode("overwrite" if write_mode == "replace" else "append").parquet(path)
    return "loaded"


def publish_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    write_mode: str = "replace",
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
) -> str:
    """All rows as text into a database table, which is created if missing.

    ``replace`` truncates and keeps the table and its grants. Executors write in
    parallel, over at most ``connections`` at a time.
    """
    if df.isEmpty():
        return "skipped"
    mode = "overwrite" if write_mode == "replace" else "append"
    writer = as_text(df).write.option("truncate", True).options(batchsize=1000, numPartitions=connections)
    writer.mode(mode).jdbc(url, table, properties=dict(properties or {}))
    return "loaded"


def managed_only(rows: DataFrame) -> DataFrame:
    return rows.filter(F.coalesce(F.col("managed_county").try_cast("int"), F.lit(0)) == 1)


def monthly_values(rows: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Managed indicator rows with value and status, and those without a target."""
    valued = managed_only(rows).withColumn("value", percentage(F.col("numerator"), F.col("denominator")))
    found, skipped = lookup_targets(
        valued,
        targets,
        on="indicator_id",
        target_key="okrId",
        columns={"target_id": "id", "target_value": "targetValue"},
        first_by=[F.col("id")],
    )
    return found.withColumn("status", status(F.col("value"), F.col("target_value"))), skipped


def monthly_batch(values: DataFrame, updater: str, as_of: Column, last: Column | None = None) -> DataFrame:
    """Values in the shape of the update table, one row per key.

    If a key occurs more often the row with the largest ``last`` stays.
    """
    order = [F.col("denominator").desc(), F.col("numerator").desc()] if last is None else [last.desc()]
    keyed = keep_first(values, ["target_id", "cy_month", "cy_year"], order, 1)
    return keyed.select(
        F.sha2(F.concat_ws("|", "target_id", "cy_year", "cy_month"), 256).alias("id"),
        F.col("numerator"),
        F.col("denominator").alias("denominatorOverride"),
        F.col("value"),
        F.col("status"),
        F.col("cy_month").alias("month"),
        F.col("cy_year").alias("year"),
        F.col("target_id").alias("okrId"),
        F.lit(updater).alias("updatedByEmail"),
        as_of.alias("updatedAt"),
    )


def upsert_monthly(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """The update table after a publish; what users entered is kept."""
    no_entries = F.array().cast("array<string>")
    return upsert(
        existing,
        batch,
        keys=UPDATE_KEYS,
        owned=OWNED,
        seeds={
            "id": F.col("new.id"),
            "narrative": F.lit(""),
            "risks": no_entries,
            "mitigations": no_entries,
            "createdByEmail": F.col("new.updatedByEmail"),
            "createdAt": F.col("new.updatedAt"),
        },
    )


def publish_counts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """How many indicator rows a publish writes and how many it skips: one row."""
    known = targets.select(F.col("okrId").alias("_known")).distinct()
    managed = F.coalesce(F.col("managed_county").try_cast("int"), F.lit(0)) == 1
    hit = managed & F.col("_known").isNotNull()
    return rows.join(known, F.col("indicator_id") == F.col("_known"), "left").agg(
        F.count_if(hit).alias("rows_upserted"), F.count_if(~hit).alias("rows_skipped")
    )
