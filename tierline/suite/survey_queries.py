"""Cleaning, KPI columns and KPI reports of the survey."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tierline.functions import survey as rules
from tierline.operators import effective, maintained, reports
from tierline.sinks.tables import SnapshotTable
from tierline.suite import inputs
from tierline.suite.inputs import with_clean, with_kpis
from tierline.suite.registry import ENTRIES, query, table
from tierline.workspace import new_dir

_PCT = "CAST(round(avg(CAST({0} AS DOUBLE)) * 100, 1) AS DOUBLE) AS pct_{1}"
_SUM = "CAST(sum({0}) AS BIGINT) AS n_{1}"


def _fyq_measures() -> str:
    parts = ["count(*) AS total_surveyed"]
    for label, source in reports.ALWAYS_SET.items():
        parts += [_SUM.format(source, label), _PCT.format(source, label)]
    for label, (source, denominator) in reports.MAYBE_UNANSWERED.items():
        parts += [
            f"count(*) FILTER (WHERE {source} = 1) AS n_{label}",
            f"count({source}) AS {denominator}",
            _PCT.format(source, label),
        ]
    parts += [_SUM.format("has_chc", "has_chc"), _PCT.format("has_chc", "has_chc")]
    return ", ".join(parts)


@query(
    "AGG1 AGG3 AGG4 AGG5 AGG6 AGG7 AGG8 DER25 PRJ19",
    with_kpis(
        f"""SELECT fy_year, fy_quarter, fy_year || '-' || fy_quarter AS fy_year_quarter, county_label,
        managed_county, {_fyq_measures()}
        FROM kpi_v GROUP BY fy_year, fy_quarter, county_label, managed_county"""
    ),
)
def kpi_fyq_report(spark, sf_dir):
    return reports.fiscal_quarter_report(inputs.curated(spark, sf_dir))


CY_MONTH_SQL = """SELECT cy_year, cy_month, managed_county, count(*) AS total_surveyed,
  CAST(sum(correct_ontime) AS BIGINT) AS n_correct_ontime,
  CAST(sum(correct_ontime_fy26) AS BIGINT) AS n_correct_ontime_fy26,
  CAST(sum(has_chc) AS BIGINT) AS n_has_chc,
  CAST(sum(lifesaving_instock) AS BIGINT) AS n_lifesaving_instock,
  count(*) FILTER (WHERE two_plusvisits = 1) AS n_two_plusvisits,
  count(two_plusvisits) AS d_two_plusvisits
FROM kpi_v GROUP BY cy_year, cy_month, managed_county"""


@query("AGG2 AGG4 AGG8", with_kpis(CY_MONTH_SQL))
def kpi_cy_month_report(spark, sf_dir):
    return reports.calendar_month_report(inputs.curated(spark, sf_dir))


def _in_batches(spark, sf_dir, report):
    """Surveys in three loads, the last of which corrects those of the first; the report follows each."""
    curated = inputs.curated(spark, sf_dir)
    early = curated.withColumns({"managed_county": 1 - F.col("managed_county"), "correct_ontime": F.lit(1), "two_plusvisits": F.lit(None).cast("int")})
    facts = SnapshotTable(spark, new_dir(spark, "surveys"), partition_by=["cy_year", "cy_month"])
    kept = maintained.MaintainedReport(facts, new_dir(spark, "report"), report)
    for batch in (early.filter("_id % 2 = 0"), curated.filter("_id % 2 <> 0"), curated.filter("_id % 2 = 0")):
        facts.merge(batch, ["cy_year", "cy_month", "_id"])
        kept.refresh()
    return kept.read()


@query("AGG1 SNK5", ENTRIES["kpi_fyq_report"].sql)
def kpi_fyq_incremental(spark, sf_dir):
    """The fiscal-quarter report from the changes of three loads."""
    return _in_batches(spark, sf_dir, maintained.fiscal_quarter())


@query("AGG2 SNK5", ENTRIES["kpi_cy_month_report"].sql)
def kpi_cy_month_incremental(spark, sf_dir):
    """The calendar-month report from the changes of three loads."""
    return _in_batches(spark, sf_dir, maintained.calendar_month())


@query(
    "PRJ21 DER25 DER26",
    with_kpis(f"SELECT {', '.join(reports.RECORD_COLUMNS)} FROM kpi_v"),
)
def kpi_record_report(spark, sf_dir):
    return reports.record_report(inputs.curated(spark, sf_dir))


_STAMP = "yyyy-MM-dd HH:mm:ss"


@query(
    "PRJ13 DER1 DER2 DER3 DER4 DER5",
    with_clean(
        """SELECT _id, county, county_label, managed_county,
        CAST(corrected AS VARCHAR) || ' 00:00:00' AS manual_date,
        basic_info_date || ' 08:' || lpad(CAST(minute_of_hour AS VARCHAR), 2, '0') || ':00' AS start_date,
        basic_info_date || ' 10:' || lpad(CAST(minute_of_hour AS VARCHAR), 2, '0') || ':30' AS end_date,
        basic_info_date || ' 08:' || lpad(CAST(minute_of_hour AS VARCHAR), 2, '0') || ':00' AS s_manual_dt,
        basic_info_date || ' 11:' || lpad(CAST(minute_of_hour AS VARCHAR), 2, '0') || ':15' AS e_manual_dt
        FROM clean_v"""
    ),
)
def clean_survey_dates(spark, sf_dir):
    df = inputs.cleaned(spark, sf_dir)
    stamps = ("manual_date", "start_date", "end_date", "s_manual_dt", "e_manual_dt")
    return df.select(
        "_id", "county", "county_label", "managed_county", *[F.date_format(c, _STAMP).alias(c) for c in stamps]
    )


@query("DER6 DER7 DER8 DER9", with_clean("SELECT _id, cy_month, cy_year, fy_year, fy_month, fy_quarter FROM clean_v"))
def fiscal_calendar(spark, sf_dir):
    df = inputs.survey(spark, sf_dir).withColumns(rules.calendar_columns())
    return df.select("_id", "cy_month", "cy_year", "fy_year", "fy_month", "fy_quarter")


def _kpis(*names: str) -> str:
    return with_kpis(f"SELECT _id, {', '.join(names)} FROM kpi_v")


_INCENTIVE = ("correct_ontime", "correct_incentive_amt", "ontime_incentive_date", "correct_ontime_fy26")


@query("DER10 DER11 DER12 DER13", _kpis(*_INCENTIVE))
def kpi_incentive(spark, sf_dir):
    return inputs.curated(spark, sf_dir).select("_id", *_INCENTIVE)


_SUPERVISION = ("two_plusvisits", "one_plusvisits")


@query("DER14 DER15", _kpis(*_SUPERVISION))
def kpi_supervision(spark, sf_dir):
    return inputs.curated(spark, sf_dir).select("_id", *_SUPERVISION)


_STOCK = (
    "lifesaving_instock",
    "lifesaving_instock_al",
    "supply_act_any_stock",
    "nchap_commodities",
    "supply_actal20_so_stock_clean",
)


@query("DER16 DER17 DER18 DER19 DER23", _kpis(*_STOCK))
def kpi_stock(spark, sf_dir):
    return inputs.curated(spark, sf_dir).select("_id", *_STOCK)


_CASES = ("case_1_correct", "case_2_correct", "case_3_correct", "correct_treatment", "chc_meetings_oneplus")


@query("DER20 DER21 DER22", _kpis(*_CASES))
def kpi_cases(spark, sf_dir):
    return inputs.curated(spark, sf_dir).select("_id", *_CASES)


@query("DER24 PRJ19", _kpis("ip", "basic_info_county"))
def kpi_partner(spark, sf_dir):
    return inputs.curated(spark, sf_dir).select("_id", "ip", "basic_info_county")


@query("DER3 DER24", _kpis("managed_county", "ip"))
def rules_by_date(spark, sf_dir):
    """The managed flag and the partner from a rule table with first and last days."""
    surveys = inputs.curated(spark, sf_dir).drop("managed_county", "ip")
    rules = effective.survey_rules(spark, inputs.RULES)
    return effective.by_survey_rules(surveys, rules).select("_id", "managed_county", "ip")


@query(
    "DER3",
    """WITH days AS (
      SELECT o_custkey, CAST(o_orderdate AS DATE) AS since, max(o_totalprice) AS price FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)
    ), rules AS (
      SELECT *, lead(since) OVER (PARTITION BY o_custkey ORDER BY since) AS until FROM days
    )
    SELECT o_orderkey, o.o_custkey, price AS price_in_force FROM orders o LEFT JOIN rules r
      ON r.o_custkey = CASE WHEN o_orderkey % 3 = 0 THEN o.o_custkey + 1 ELSE o.o_custkey END
      AND CAST(o_orderdate AS DATE) + 30 >= since AND (until IS NULL OR CAST(o_orderdate AS DATE) + 30 < until)""",
)
def rules_from_history(spark, sf_dir):
    """A rule table as large as the facts: the price each customer had in force, from one order day to the next."""
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    days = orders.groupBy(F.col("o_custkey").alias("key"), day.alias("valid_from")).agg(F.max("o_totalprice").alias("price"))
    rules = days.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy("key").orderBy("valid_from")))
    asked = orders.withColumn("of", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    told = effective.in_force(asked, rules, "of", F.date_add(day, 30), {"price_in_force": "price"})
    return told.select("o_orderkey", "o_custkey", "price_in_force")
