"""Watermarks, windows and bounded reads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tierline.operators import incremental as inc
from tierline.sinks.control import ControlLog
from tierline.sources import footers
from tierline.suite.registry import query, table
from tierline.workspace import new_dir

_BOUND = "2024-01-15 12:00:00"


def _bound():
    return F.lit(_BOUND).cast("timestamp_ntz")


@query("INC3 INC4", f"SELECT event_id, ts, value FROM events WHERE ts > TIMESTAMP '{_BOUND}'")
def incremental_filter(spark, sf_dir):
    return inc.after(table(spark, sf_dir, "events").select("event_id", "ts", "value"), "ts", _bound())


@query("INC4", "SELECT event_id, user_id FROM events WHERE event_id >= (SELECT max(event_id) - 100 FROM events)")
def incremental_filter_inclusive(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    top = inc.table_watermark(events, "event_id").first().max_watermark
    return inc.after(events, "event_id", top - 100, inclusive=True)


def _periods(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("period"))


_PERIODS_SQL = "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y%m') AS period FROM orders WHERE strftime(o_orderdate, '%Y%m') IN "


@query("INC7", _PERIODS_SQL + "('199911', '199912', '200001')")
def rolling_months(spark, sf_dir):
    return inc.rolling_months(_periods(spark, sf_dir), F.col("period"), date(2000, 1, 31))


@query("INC8", _PERIODS_SQL + "('199601', '199803')")
def period_list(spark, sf_dir):
    return inc.in_periods(_periods(spark, sf_dir), F.col("period"), " 199601,199803 ,, ")


@query(
    "INC9 INC7 INC8",
    " UNION ALL ".join(
        f"SELECT '{name}' AS choice, count(*) AS n FROM orders WHERE {where}"
        for name, where in {
            "full": "true",
            "full_default": "strftime(o_orderdate, '%Y%m') = '199703'",
            "incremental": "o_orderkey > 1000",
            "incremental_periods": "o_orderkey > 1000 AND strftime(o_orderdate, '%Y%m') = '199601'",
            "rolling": "strftime(o_orderdate, '%Y%m') IN ('199911', '199912', '200001')",
            "rolling_periods": "strftime(o_orderdate, '%Y%m') = '199601'",
        }.items()
    ),
)
def incremental_read(spark, sf_dir):
    orders = _periods(spark, sf_dir)
    common = {"key": "o_orderkey", "bound": 1000, "period": F.col("period"), "as_of": date(2000, 1, 31)}
    choices = {
        "full": ("full", {}),
        "full_default": ("full", {"default_periods": "199703"}),
        "incremental": ("incremental", {"default_periods": "199703"}),
        "incremental_periods": ("incremental", {"periods": "199601"}),
        "rolling": ("rolling_window", {"default_periods": "199703"}),
        "rolling_periods": ("rolling_window", {"periods": ["199601"]}),
    }
    result = None
    for name, (strategy, extra) in choices.items():
        part = inc.read_incremental(orders, inc.strategy_of("full", override=strategy), **common, **extra)
        counted = part.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("choice"), "n")
        result = counted if result is None else result.unionByName(counted)
    return result


def _texts(spark, sf_dir):
    value = F.when(F.col("event_type") != "view", F.col("event_id").cast("string")).otherwise("")
    return table(spark, sf_dir, "events").select("user_id", value.alias("updated"))


@query("INC5", "SELECT max(CAST(event_id AS VARCHAR)) AS max_watermark FROM events WHERE event_type <> 'view'")
def batch_max_watermark(spark, sf_dir):
    """Compared as text, so 999 is above 1000; empty values do not count."""
    return inc.batch_watermark(_texts(spark, sf_dir), "updated")


@query("INC6 AGG11", "SELECT max(l_shipdate) AS max_watermark FROM lineitem")
def table_max_watermark(spark, sf_dir):
    return inc.table_watermark(table(spark, sf_dir, "lineitem"), "l_shipdate")


@query("INC6 AGG9 AGG11", "SELECT count(*) AS row_count, min(l_orderkey) AS min_l_orderkey, max(l_orderkey) AS max_l_orderkey FROM lineitem")
def table_max_from_footers(spark, sf_dir):
    """Rows and bounds of a table without reading its data."""
    return footers.extent(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey"])


@query(
    "INC1 INC2",
    """SELECT o_orderpriority AS pipeline_name, max(o_orderkey)::VARCHAR AS last_watermark_value, strftime(max(day), '%Y-%m-%d') AS last_successful_run,
    'run-' || arg_max(o_orderkey, day) AS last_execution_id FROM (
      SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, max(o_orderkey) AS o_orderkey FROM orders
      GROUP BY o_orderpriority, CAST(o_orderdate AS DATE) HAVING max(o_orderkey) % 10 <> 0
      QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY CAST(o_orderdate AS DATE) DESC) = 1
    ) GROUP BY o_orderpriority""",
)
def watermark_log(spark, sf_dir):
    """A pipeline per priority with a run per day; runs are logged out of order, twice, and some without a value."""
    orders = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    runs = orders.groupBy("o_orderpriority", day.alias("day")).agg(F.max("o_orderkey").alias("top"))
    rows = runs.select(
        F.col("o_orderpriority").alias("pipeline_name"),
        F.when(F.col("top") % 10 != 0, F.col("top").cast("string")).otherwise("").alias("last_watermark_value"),
        F.col("day").alias("last_successful_run"),
        F.concat(F.lit("run-"), F.col("top").cast("string")).alias("last_execution_id"),
    )
    log = ControlLog(spark, new_dir(spark, "watermarks"))
    for part in (rows.filter("last_successful_run >= '1995'"), rows.filter("last_successful_run < '1996'"), rows.filter("pipeline_name LIKE '1%'")):
        log.add(part)
    return log.state()


@query("INC6", "SELECT CAST(NULL AS TIMESTAMP) AS max_watermark FROM lineitem LIMIT 1")
def table_max_watermark_full(spark, sf_dir):
    return inc.table_watermark(table(spark, sf_dir, "lineitem"), "l_shipdate", mode="full")


def _control(spark, sf_dir):
    """A pipeline per user that has seen errors, with its last one."""
    errors = table(spark, sf_dir, "events").filter("event_type = 'error'")
    return errors.groupBy(F.col("user_id").cast("string").alias("pipeline_name")).agg(
        F.max(F.col("event_id").cast("string")).alias("last_watermark_value"),
        F.lit("2024-01-01").alias("last_successful_run"),
        F.lit("run-1").alias("last_execution_id"),
    )


_CONTROL_SQL = """control AS (SELECT CAST(user_id AS VARCHAR) AS pipeline_name,
  max(CAST(event_id AS VARCHAR)) AS last_watermark_value, '2024-01-01' AS last_successful_run,
  'run-1' AS last_execution_id FROM events WHERE event_type = 'error' GROUP BY user_id)"""


@query(
    "INC2",
    f"""WITH {_CONTROL_SQL}, fresh AS (SELECT CAST(s_suppkey AS VARCHAR) AS pipeline_name, s_name AS v
      FROM supplier WHERE s_acctbal > 0)
    SELECT coalesce(c.pipeline_name, f.pipeline_name) AS pipeline_name,
      CASE WHEN f.v IS NULL THEN c.last_watermark_value ELSE f.v END AS last_watermark_value,
      CASE WHEN f.v IS NULL THEN c.last_successful_run ELSE '2024-02-01' END AS last_successful_run,
      CASE WHEN f.v IS NULL THEN c.last_execution_id ELSE 'run-2' END AS last_execution_id
    FROM control c FULL OUTER JOIN fresh f ON c.pipeline_name = f.pipeline_name""",
)
def watermark_upsert(spark, sf_dir):
    """A pipeline per supplier has run; those in debt found nothing new."""
    news = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("pipeline_name"),
        F.when(F.col("s_acctbal") > 0, F.col("s_name")).otherwise("").alias("last_watermark_value"),
        F.lit("2024-02-01").alias("last_successful_run"),
        F.lit("run-2").alias("last_execution_id"),
    )
    return inc.write_watermark(_control(spark, sf_dir), news)


@query(
    "INC1 INC3",
    f"""WITH {_CONTROL_SQL}, asked AS (SELECT * FROM (VALUES ('8'), ('no such pipeline')) AS v(p))
    SELECT p, 'event_id' AS incremental_key, last_watermark_value AS start_after
    FROM asked LEFT JOIN control ON p = pipeline_name""",
)
def watermark_read(spark, sf_dir):
    control = _control(spark, sf_dir)
    known, unknown = (
        inc.boundaries(inc.read_watermark(control, name), "event_id").withColumn("p", F.lit(name))
        for name in ("8", "no such pipeline")
    )
    return known.unionByName(unknown)


@query(
    "INC10",
    "SELECT count(*) AS n, 'loaded' AS first_run, 'skipped' AS second_run FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'",
)
def empty_batch(spark, sf_dir):
    """The first run has rows, the second one, bounded by its watermark, none."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    batch = inc.after(events, "ts", _bound())
    first = inc.run_unless_empty(batch, lambda _: "loaded") or "skipped"
    seen = inc.table_watermark(batch, "ts").first().max_watermark
    rest = inc.after(batch, "ts", F.lit(str(seen)).cast("timestamp_ntz"))
    second = inc.run_unless_empty(rest, lambda _: "loaded") or "skipped"
    return batch.agg(F.count(F.lit(1)).alias("n")).withColumns({"first_run": F.lit(first), "second_run": F.lit(second)})
