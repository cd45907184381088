"""From the monthly report to published indicator rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.functions import fixed_values as fv
from tierline.operators import joins, reports
from tierline.sinks import publish
from tierline.suite import inputs
from tierline.suite.inputs import with_kpis
from tierline.suite.registry import query, table
from tierline.suite.survey_queries import CY_MONTH_SQL
from tierline.workspace import new_dir

UPDATER, AS_OF = "publisher@example.org", "2024-06-15T10:30:00"


def _long(spark, sf_dir):
    return reports.indicator_rows(reports.calendar_month_report(inputs.curated(spark, sf_dir)))


def _targets(spark, sf_dir):
    """Indicator definitions ``2.<nation>``; some have no or a zero target."""
    key = F.col("n_nationkey").cast("string")
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("def-"), key).alias("id"),
        F.concat(F.lit("2."), key).alias("okrId"),
        F.when(F.col("n_nationkey") != 4, F.col("n_regionkey") * 20.0).alias("targetValue"),
    )


def _existing(spark, sf_dir):
    """Updates entered before: two definitions in every month with orders."""
    orders = table(spark, sf_dir, "orders")
    months = orders.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).count()
    return months.select(
        F.concat_ws("/", F.lit("def"), "year", "month").alias("id"),
        F.col("count").alias("numerator"),
        F.lit(None).cast("long").alias("denominatorOverride"),
        F.lit(1.0).alias("value"),
        F.lit("entered by hand").alias("narrative"),
        F.lit("at_risk").alias("status"),
        F.array(F.lit("late"), F.lit("dear")).alias("risks"),
        F.array(F.lit("hurry")).alias("mitigations"),
        "month",
        "year",
        F.explode(F.array(F.lit("def-2"), F.lit("def-9"))).alias("okrId"),
        F.lit("user@example.org").alias("createdByEmail"),
        F.lit("user@example.org").alias("updatedByEmail"),
        F.lit("2000-01-01T00:00:00").alias("createdAt"),
        F.lit("2000-01-01T00:00:00").alias("updatedAt"),
    )


_MONTHLY = f"monthly AS ({CY_MONTH_SQL})"
_LONG = "long_v AS (" + " UNION ALL ".join(
    f"SELECT '{i}' AS indicator_id, {', '.join(fv.INDICATOR_DIMENSIONS)}, {n} AS numerator, {d} AS denominator FROM monthly"
    for i, (n, d) in fv.INDICATORS.items()
) + ")"
_TARGETS = """targets AS (SELECT 'def-' || n_nationkey AS id, '2.' || n_nationkey AS "okrId",
  CASE WHEN n_nationkey <> 4 THEN n_regionkey * CAST(20 AS DOUBLE) END AS "targetValue" FROM nation)"""
_VALUES = """values_v AS (
  SELECT l.*, t.id AS target_id, t."targetValue" AS target_value,
    CASE WHEN denominator <> 0 THEN round(CAST(numerator AS DOUBLE) / denominator * 100, 2) END AS value
  FROM long_v l JOIN targets t ON l.indicator_id = t."okrId" WHERE coalesce(managed_county, 0) = 1)"""
_STATUS = """status_v AS (
  SELECT *, CASE WHEN value IS NULL OR coalesce(target_value, 0) = 0 THEN 'on_track'
    ELSE (['okr_under_review', 'at_risk', 'delayed', 'on_track', 'achieved'])
      [1 + greatest(0, least(4, CAST(floor(value / target_value * 4) AS INTEGER)))] END AS status
  FROM values_v)"""


@query("RSH1", with_kpis("SELECT * FROM long_v", _MONTHLY, _LONG))
def indicator_unpivot(spark, sf_dir):
    return _long(spark, sf_dir)


@query(
    "DER27 DER28 PRJ20 JOIN3",
    with_kpis(
        "SELECT indicator_id, cy_year, cy_month, numerator, denominator, value, target_value, status FROM status_v",
        _MONTHLY,
        _LONG,
        _TARGETS,
        _VALUES,
        _STATUS,
    ),
)
def indicator_value_status(spark, sf_dir):
    found, _ = publish.monthly_values(_long(spark, sf_dir), _targets(spark, sf_dir))
    return found.select("indicator_id", "cy_year", "cy_month", "numerator", "denominator", "value", "target_value", "status")


@query(
    "JOIN3",
    with_kpis(
        """SELECT indicator_id, cy_year, cy_month, numerator FROM long_v
        WHERE managed_county = 1 AND indicator_id NOT IN (SELECT "okrId" FROM targets WHERE id <> 'def-3')""",
        _MONTHLY,
        _LONG,
        _TARGETS,
    ),
)
def target_lookup(spark, sf_dir):
    """Rows that are skipped because their indicator has no definition."""
    targets = _targets(spark, sf_dir).filter("id <> 'def-3'")
    _, skipped = publish.monthly_values(_long(spark, sf_dir), targets)
    return skipped.select("indicator_id", "cy_year", "cy_month", "numerator")


@query(
    "PRJ20 SNK12",
    with_kpis(
        """SELECT count(*) FILTER (WHERE managed_county = 1 AND indicator_id <> '2.3') AS rows_upserted,
        count(*) FILTER (WHERE managed_county <> 1 OR indicator_id = '2.3') AS rows_skipped FROM long_v""",
        _MONTHLY,
        _LONG,
    ),
)
def publish_counts(spark, sf_dir):
    return publish.publish_counts(_long(spark, sf_dir), _targets(spark, sf_dir).filter("id <> 'def-3'"))


_EXISTING = """existing AS (
  SELECT 'def/' || y || '/' || m AS id, n AS numerator, CAST(NULL AS BIGINT) AS "denominatorOverride",
    CAST(1 AS DOUBLE) AS value, 'at_risk' AS status, m AS month, y AS year, d AS "okrId"
  FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, count(*) AS n
        FROM orders GROUP BY ALL) CROSS JOIN (VALUES ('def-2'), ('def-9')) AS v(d))"""


@query(
    "SNK12 JOIN3 JOIN4 DER27 DER28 PRJ20",
    with_kpis(
        f"""SELECT coalesce(e."okrId", s.target_id) AS "okrId", coalesce(e.year, s.cy_year) AS year,
        coalesce(e.month, s.cy_month) AS month,
        coalesce(e.id, sha256(s.target_id || '|' || s.cy_year || '|' || s.cy_month)) AS id,
        CASE WHEN s.target_id IS NULL THEN e.numerator ELSE s.numerator END AS numerator,
        CASE WHEN s.target_id IS NULL THEN e."denominatorOverride" ELSE s.denominator END AS "denominatorOverride",
        CASE WHEN s.target_id IS NULL THEN e.value ELSE s.value END AS value,
        CASE WHEN s.target_id IS NULL THEN e.status ELSE s.status END AS status,
        CASE WHEN e.id IS NULL THEN '' ELSE 'entered by hand' END AS narrative,
        CASE WHEN e.id IS NULL THEN '' ELSE 'late;dear' END AS risks,
        CASE WHEN e.id IS NULL THEN '' ELSE 'hurry' END AS mitigations,
        CASE WHEN e.id IS NULL THEN '{UPDATER}' ELSE 'user@example.org' END AS "createdByEmail",
        CASE WHEN s.target_id IS NULL THEN 'user@example.org' ELSE '{UPDATER}' END AS "updatedByEmail",
        CASE WHEN e.id IS NULL THEN '{AS_OF}' ELSE '2000-01-01T00:00:00' END AS "createdAt",
        CASE WHEN s.target_id IS NULL THEN '2000-01-01T00:00:00' ELSE '{AS_OF}' END AS "updatedAt"
        FROM existing e FULL OUTER JOIN status_v s
          ON e."okrId" = s.target_id AND e.year = s.cy_year AND e.month = s.cy_month""",
        _MONTHLY,
        _LONG,
        _TARGETS,
        _VALUES,
        _STATUS,
        _EXISTING,
    ),
)
def kpi_publish_upsert(spark, sf_dir):
    values, _ = publish.monthly_values(_long(spark, sf_dir), _targets(spark, sf_dir))
    batch = publish.monthly_batch(values, UPDATER, F.lit(AS_OF))
    updated = publish.upsert_monthly(_existing(spark, sf_dir), batch)
    return updated.withColumns({c: F.array_join(c, ";") for c in ("risks", "mitigations")})


_TEXT_COLUMNS = ("_id", "county_label", "managed_county", "fy_year_quarter", "correct_ontime", "two_plusvisits", "has_chc")


@query(
    "SNK11",
    with_kpis("SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _TEXT_COLUMNS) + " FROM kpi_v"),
)
def publish_all_text(spark, sf_dir):
    path = new_dir(spark, "published")
    publish.publish_files(reports.record_report(inputs.curated(spark, sf_dir)).select(*_TEXT_COLUMNS), path)
    return spark.read.parquet(path)


@query(
    "JOIN4",
    """WITH old AS (
      SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 7 <> 0 THEN l_orderkey END AS key, l_quantity AS quantity, 'kept' AS note FROM lineitem
    ), new AS (SELECT CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey END AS key, o_totalprice AS quantity FROM orders WHERE o_orderkey % 2 = 1)
    SELECT old.key, CASE WHEN new.key IS NOT NULL THEN new.quantity ELSE old.quantity END AS quantity, note FROM old LEFT JOIN new ON old.key = new.key
    UNION ALL SELECT key, quantity, 'fresh' FROM new WHERE key IS NULL OR NOT EXISTS (SELECT 1 FROM old WHERE old.key = new.key)""",
)
def upsert_skewed(spark, sf_dir):
    """A key that a third of the existing rows share, and null keys on both sides."""
    line, order = F.col("l_orderkey"), F.col("o_orderkey")
    shared = F.when(line % 3 == 0, 1).when(line % 7 != 0, line)
    old = table(spark, sf_dir, "lineitem").select(shared.alias("key"), F.col("l_quantity").alias("quantity"), F.lit("kept").alias("note"))
    new = table(spark, sf_dir, "orders").filter(order % 2 == 1).select(F.when(order % 11 != 0, order).alias("key"), F.col("o_totalprice").alias("quantity"))
    return joins.upsert(old, new, ["key"], ["quantity"], {"note": F.lit("fresh")})
