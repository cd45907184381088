"""Quality checks, run audit, and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.operators import quality, runs
from tierline.plans import batch
from tierline.sinks.tables import SnapshotTable
from tierline.streaming import files as streams
from tierline.suite.incremental_queries import _CONTROL_SQL, _control
from tierline.suite.registry import query, table
from tierline.workspace import new_dir


@query(
    "DQ1 AGG9",
    "SELECT 'row_count_min' AS type, CAST(NULL AS VARCHAR) AS item, count(*) AS actual, CAST(10 AS BIGINT) AS expected, count(*) >= 10 AS passed FROM orders",
)
def dq_row_count(spark, sf_dir):
    return quality.row_count_min(table(spark, sf_dir, "orders"), 10)


def _gappy(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("o_totalprice")
    )


_NULLS_SQL = """SELECT 'null_check' AS type, 'o_orderkey' AS item, count(*) - count(o_orderkey) AS actual,
  CAST(0 AS BIGINT) AS expected, count(*) = count(o_orderkey) AS passed FROM orders
  UNION ALL SELECT 'null_check', 'o_totalprice', count(*) FILTER (WHERE o_orderstatus = 'F'), 0,
  count(*) FILTER (WHERE o_orderstatus = 'F') = 0 FROM orders"""


@query("DQ2 AGG10", _NULLS_SQL)
def dq_nulls(spark, sf_dir):
    return quality.null_check(_gappy(spark, sf_dir), ["o_orderkey", "o_totalprice"])


_NEGATIVE = "SELECT COUNT(*) FROM {table} WHERE o_totalprice < 0"


@query(
    "DQ3",
    f"""SELECT 'custom_sql' AS type, '{_NEGATIVE}' AS item, count(*) AS actual, CAST(0 AS BIGINT) AS expected,
    count(*) = 0 AS passed FROM orders WHERE o_totalprice < 0""",
)
def dq_custom_sql(spark, sf_dir):
    return quality.custom_sql(table(spark, sf_dir, "orders"), _NEGATIVE)


@query(
    "DQ4 DQ1 DQ2 DQ3",
    f"""SELECT *, 'failed: o_totalprice, never' AS verdict FROM (
    SELECT 'row_count_min' AS type, CAST(NULL AS VARCHAR) AS item, count(*) AS actual, CAST(1 AS BIGINT) AS expected,
      count(*) >= 1 AS passed FROM orders
    UNION ALL {_NULLS_SQL}
    UNION ALL SELECT 'custom_sql', '{_NEGATIVE}', count(*), 0, count(*) = 0 FROM orders WHERE o_totalprice < 0
    UNION ALL SELECT 'never', NULL, NULL, NULL, false)""",
)
def dq_verdict(spark, sf_dir):
    checks = [
        {"type": "row_count_min"},
        {"type": "null_check", "columns": ["o_orderkey", "o_totalprice"]},
        {"type": "custom_sql", "query": _NEGATIVE},
        {"type": "never"},
    ]
    results = quality.run_checks(_gappy(spark, sf_dir), checks)
    try:
        verdict = quality.require(results)
    except quality.QualityError as error:
        verdict = "failed: " + ", ".join(sorted((r["item"] or r["type"] for r in error.rows), reverse=True))
    return results.withColumn("verdict", F.lit(verdict))


@query(
    "SNK14 AGG9",
    """SELECT 'events' AS pipeline_name, 'run-1' AS execution_id, 'processed_complete' AS status,
    '2024-06-15T10:30:00' AS end_time, count(*) AS row_count, 3 AS column_count,
    '["event_id","ts","value"]' AS schema_columns, CAST(NULL AS VARCHAR) AS error_message FROM events""",
)
def run_audit(spark, sf_dir):
    """The rows are counted by the write itself."""
    root = new_dir(spark, "audited")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    run = batch.Run("events", "run-1", "2024-06-15T10:30:00")
    batch.write_layer(events, f"{root}/processed", run, f"{root}/audit", "processed")
    return spark.read.schema(runs.AUDIT_SCHEMA).json(f"{root}/audit").drop("path")


def _run_log(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("pipeline_name"),
        F.col("event_id").alias("execution_id"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("end_time"),
    )


_LOG_SQL = """log AS (SELECT CAST(user_id AS VARCHAR) AS pipeline_name, event_id AS execution_id, event_type AS status,
  ts AS end_time, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS recency FROM events)"""
_NEWEST_FIRST = ("end_time", "execution_id")


def _order():
    return [F.col(c).desc() for c in _NEWEST_FIRST]


@query("TOP1", f"WITH {_LOG_SQL} SELECT * EXCLUDE (recency) FROM log WHERE recency = 1")
def latest_run(spark, sf_dir):
    return runs.latest_run(_run_log(spark, sf_dir), "pipeline_name", _order())


@query("TOP2", f"WITH {_LOG_SQL} SELECT * REPLACE (CAST(recency AS INTEGER) AS recency) FROM log WHERE recency <= 10")
def last_k_runs(spark, sf_dir):
    return runs.recent_runs(_run_log(spark, sf_dir), "pipeline_name", _order(), 10)


@query(
    "TOP3",
    """SELECT event_type AS name, arg_max(event_id, ts) AS event_id, arg_max(user_id, ts) AS user_id
    FROM events GROUP BY event_type""",
)
def newest_table_version(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "name")
    return runs.newest_version(events, "name", "ts", ["event_id", "user_id"])


@query(
    "TOP4 TOP1 INC1",
    f"""WITH {_LOG_SQL}, {_CONTROL_SQL}
    SELECT CAST(c_custkey AS VARCHAR) AS pipeline_name, c_name AS description, l.execution_id, l.status, l.end_time,
      last_watermark_value, last_successful_run, last_execution_id
    FROM customer LEFT JOIN (SELECT * FROM log WHERE recency = 1) l ON CAST(c_custkey AS VARCHAR) = l.pipeline_name
    LEFT JOIN control k ON CAST(c_custkey AS VARCHAR) = k.pipeline_name""",
)
def run_status(spark, sf_dir):
    known = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("pipeline_name"), F.col("c_name").alias("description")
    )
    return runs.run_status(known, _run_log(spark, sf_dir), _control(spark, sf_dir), _order())


@query("STR1 SRC4 INC10", "SELECT * FROM events")
def stream_file_ingest(spark, sf_dir):
    """Two runs over the same files; the second finds nothing new."""
    root = new_dir(spark, "stream")
    for _ in range(2):
        stream = streams.table_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")
        streams.ingest_available(stream, f"{root}/events", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/events")


@query(
    "STR1 SNK4 SNK8",
    """SELECT event_id, user_id, CASE WHEN event_id % 3 > 0 THEN value END AS value, CASE WHEN event_id % 3 > 1 THEN event_type END AS event_type FROM events""",
)
def stream_schema_growth(spark, sf_dir):
    """Three drops of JSON lines, each with a column more; the stream starts anew for each, and once for none."""
    root = new_dir(spark, "growing-stream")
    events = table(spark, sf_dir, "events")
    taken = SnapshotTable(spark, f"{root}/events")
    for drop, columns in enumerate((["event_id", "user_id"], ["event_id", "user_id", "value"], ["event_type", "event_id", "user_id", "value"])):
        events.filter(F.col("event_id") % 3 == drop).select(*columns).write.mode("append").json(f"{root}/drops")
        streams.ingest_growing(spark, f"{root}/drops", taken, f"{root}/checkpoint")
    streams.ingest_growing(spark, f"{root}/drops", taken, f"{root}/checkpoint")
    return taken.read()


@query(
    "STR2 SNK5",
    """SELECT event_id, user_id, event_type FROM events
    UNION ALL SELECT event_id * 2, user_id, 'old' FROM events o
    WHERE NOT EXISTS (SELECT 1 FROM events n WHERE n.event_id = o.event_id * 2)""",
)
def stream_upsert(spark, sf_dir):
    """Events replace the rows a table already has under their ids."""
    root = new_dir(spark, "stream")
    events = SnapshotTable(spark, f"{root}/events")
    events.replace(
        table(spark, sf_dir, "events").select((F.col("event_id") * 2).alias("event_id"), "user_id", F.lit("old").alias("event_type"))
    )
    stream = streams.table_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    streams.upsert_available(stream.select("event_id", "user_id", "event_type"), events, ["event_id"], f"{root}/checkpoint")
    return events.read()


@query(
    "STR2 SNK5",
    """SELECT strftime(ts, '%Y%m%d') AS day, event_id, event_type FROM events
    UNION ALL SELECT strftime(ts, '%Y%m%d'), -1 - event_id, 'old' FROM events""",
)
def stream_upsert_by_day(spark, sf_dir):
    """As before, into a table of days; days without new events stay as they are."""
    root = new_dir(spark, "stream")
    day = F.date_format("ts", "yyyyMMdd").alias("day")
    events = table(spark, sf_dir, "events")
    old = events.select(day, "event_id", F.lit("old").alias("event_type"))
    others = events.select(day, (-1 - F.col("event_id")).alias("event_id"), F.lit("old").alias("event_type"))
    facts = SnapshotTable(spark, f"{root}/events", partition_by=["day"])
    facts.merge(old.unionByName(others), ["day", "event_id"])
    stream = streams.table_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    streams.upsert_partitions_available(
        stream.select(day, "event_id", "event_type"), f"{root}/events", ["day", "event_id"], ["day"], f"{root}/checkpoint"
    )
    return facts.read()
