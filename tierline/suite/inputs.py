"""Survey-, fact- and target-shaped inputs derived from the given tables.

Each is written twice, as a projection in Spark and as a common table
expression for the oracle, with integer arithmetic that both compute alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions import fixed_values as fv
from tierline.functions import survey as rules
from tierline.functions.survey import SurveyRules
from tierline.suite.registry import table

# The dated rules, moved into the years the orders span.
RULES = SurveyRules(handover="1998-01-01", wrong_date="1998-02-09", right_date="1999-07-11")

STOCK_PRIMES = (11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59, 61)

POSITIVE, NEGATIVE = "Visit: CHA has AL not ASAQ", "no drugs for cha"


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One survey submission per order."""
    orders = table(spark, sf_dir, "orders")
    k, c, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("date")
    text = lambda col: col.cast("string")
    minute = F.lpad(text(k % 60), 2, "0")
    chc = F.when(c % 7 != 0, text(c % 2))
    flags = {
        name: F.when(k % prime != 0, "1").otherwise("0") for name, prime in zip(fv.KIT_COLUMNS, STOCK_PRIMES)
    }
    notes = (
        F.when(k % 6 == 0, POSITIVE)
        .when(k % 6 == 1, NEGATIVE)
        .when(k % 6 == 3, F.lit(f"{NEGATIVE}; {POSITIVE}"))
        .when(k % 6 != 2, "nothing to report")
    )
    return orders.select(
        k.alias("_id"),
        text(day).alias("basic_info_date"),
        text(c % 17).alias("basic_info_county"),
        text(k % 4).alias("basic_info_data_collector_org"),
        F.concat(text(day), F.lit("T08:"), minute, F.lit(":00")).alias("start"),
        F.concat(text(day), F.lit("T10:"), minute, F.lit(":30")).alias("end"),
        F.concat(F.lit("11:"), minute, F.lit(":15.000")).alias("end_manual"),
        text((k % 3 != 0).cast("int")).alias("grp_incentive1_incentive_correct"),
        text((c % 4 != 0).cast("int")).alias("grp_incentive1_incentive_ontime"),
        text(F.date_sub(day, (k % 45).cast("int"))).alias("grp_incentive1_incentive_date"),
        text(F.when(k % 3 == 2, 12720 + c % 12).otherwise(69 + c % 2)).alias("grp_incentive2_incentive_amt"),
        text(k % 3).alias("grp_incentive2_incentive_currency"),
        F.when(k % 10 != 0, text(k % 4)).alias("supervision_grp_supervision_last4wks"),
        F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, "0").otherwise("1").alias("stock_info_supply_actal20_so_stock"),
        *[column.alias(name) for name, column in flags.items()],
        notes.alias("txt_notes"),
        F.when(c % 9 != 0, text(1 + c % 4)).alias("sd_scenario_1"),
        F.when(c % 10 != 0, text(2 + (k + c) % 4)).alias("sd_scenario_2"),
        F.when(c % 11 != 0, text(1 + (k + 2 * c) % 3)).alias("sd_scenario_3"),
        chc.alias("health_services_communityengagement_chc"),
        F.when(chc == "1", text((k + c) % 3)).alias("health_services_communityengagement_meetings"),
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.clean(survey(spark, sf_dir), RULES)


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.curate(cleaned(spark, sf_dir), RULES)


# ------------------------------------------------------------------- oracle

_FLAGS_SQL = ",\n    ".join(
    f"CAST(CAST(o_orderkey % {p} <> 0 AS INTEGER) AS VARCHAR) AS {name}"
    for name, p in zip(fv.KIT_COLUMNS, STOCK_PRIMES)
)

SURVEY_CTE = f"""
survey_v AS (
  SELECT
    o_orderkey AS _id,
    CAST(day AS VARCHAR) AS basic_info_date,
    CAST(o_custkey % 17 AS VARCHAR) AS basic_info_county,
    CAST(o_orderkey % 4 AS VARCHAR) AS basic_info_data_collector_org,
    o_orderkey % 60 AS minute_of_hour,
    CAST(CAST(o_orderkey % 3 <> 0 AS INTEGER) AS VARCHAR) AS grp_incentive1_incentive_correct,
    CAST(CAST(o_custkey % 4 <> 0 AS INTEGER) AS VARCHAR) AS grp_incentive1_incentive_ontime,
    CAST(day - CAST(o_orderkey % 45 AS INTEGER) AS VARCHAR) AS grp_incentive1_incentive_date,
    CAST(CASE WHEN o_orderkey % 3 = 2 THEN 12720 + o_custkey % 12 ELSE 69 + o_custkey % 2 END AS VARCHAR)
      AS grp_incentive2_incentive_amt,
    CAST(o_orderkey % 3 AS VARCHAR) AS grp_incentive2_incentive_currency,
    CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey % 4 AS VARCHAR) END AS supervision_grp_supervision_last4wks,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '0' ELSE '1' END
      AS stock_info_supply_actal20_so_stock,
    {_FLAGS_SQL},
    CASE o_orderkey % 6 WHEN 0 THEN '{POSITIVE}' WHEN 1 THEN '{NEGATIVE}' WHEN 2 THEN NULL
      WHEN 3 THEN '{NEGATIVE}; {POSITIVE}' ELSE 'nothing to report' END AS txt_notes,
    CASE WHEN o_custkey % 9 <> 0 THEN CAST(1 + o_custkey % 4 AS VARCHAR) END AS sd_scenario_1,
    CASE WHEN o_custkey % 10 <> 0 THEN CAST(2 + (o_orderkey + o_custkey) % 4 AS VARCHAR) END AS sd_scenario_2,
    CASE WHEN o_custkey % 11 <> 0 THEN CAST(1 + (o_orderkey + 2 * o_custkey) % 3 AS VARCHAR) END AS sd_scenario_3,
    CASE WHEN o_custkey % 7 <> 0 THEN CAST(o_custkey % 2 AS VARCHAR) END AS health_services_communityengagement_chc,
    CASE WHEN o_custkey % 7 <> 0 AND o_custkey % 2 = 1 THEN CAST((o_orderkey + o_custkey) % 3 AS VARCHAR) END
      AS health_services_communityengagement_meetings
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)
)"""


def ci(name: str) -> str:
    """Text to integer, cutting off a fraction, in the oracle's dialect."""
    return f"CAST(trunc(TRY_CAST({name} AS DOUBLE)) AS INTEGER)"


def flag_sql(condition: str) -> str:
    return f"CAST(coalesce({condition}, false) AS INTEGER)"


def _contains_any(phrases) -> str:
    return "(" + " OR ".join(f"contains(note, '{p}')" for p in phrases) + ")"


_LABELS_SQL = "[" + ", ".join(f"'{name}'" for name in fv.COUNTY_LABELS.values()) + "]"

CLEAN_CTE = f"""
clean_v AS (
  SELECT *,
    lower(trim(basic_info_county)) AS county,
    {_LABELS_SQL}[code] AS county_label,
    {flag_sql(f"code = 13 OR (code = 4 AND d < DATE '{RULES.handover}')")} AS managed_county,
    CASE WHEN d = DATE '{RULES.wrong_date}' THEN DATE '{RULES.right_date}' ELSE d END AS corrected,
    CAST(month(d) AS INTEGER) AS cy_month,
    CAST(year(d) AS INTEGER) AS cy_year,
    CAST(year(d) + CAST(month(d) > 6 AS INTEGER) AS INTEGER) AS fy_year,
    CAST((month(d) + 5) % 12 + 1 AS INTEGER) AS fy_month,
    CAST(((month(d) + 5) % 12) // 3 + 1 AS INTEGER) AS fy_quarter
  FROM (SELECT *, {ci("basic_info_county")} AS code, TRY_CAST(basic_info_date AS DATE) AS d FROM survey_v)
)"""

_ONE = lambda name: f"({ci(name)} = 1)"
_ACT = (
    f"({_ONE('stock_info_supply_actal20_so_stock')} OR "
    f"({_ONE('stock_info_supply_act25_stock')} AND {_ONE('stock_info_supply_actasaq50_stock')}))"
)
_MEDICINES = " AND ".join(_ONE(f"stock_info_supply_{m}_stock") for m in ("amox", "ors", "zinc"))
_PARTNERS_SQL = " ".join(
    f"WHEN code IN ({', '.join(map(str, codes))}) THEN '{name}'" for name, codes in fv.OTHER_PARTNERS.items()
)

KPI_CTE = f"""
base_v AS (
  SELECT *,
    lower(coalesce(txt_notes, '')) AS note,
    TRY_CAST(grp_incentive1_incentive_date AS DATE) AS paid,
    {ci("supervision_grp_supervision_last4wks")} AS visits,
    {ci("grp_incentive2_incentive_currency")} AS currency,
    TRY_CAST(grp_incentive2_incentive_amt AS DOUBLE) AS amount
  FROM clean_v
  WHERE {ci("basic_info_data_collector_org")} IN (1, 3)
),
single_v AS (
  SELECT *,
    {flag_sql(_ONE("grp_incentive1_incentive_correct") + " AND " + _ONE("grp_incentive1_incentive_ontime"))}
      AS correct_ontime,
    {flag_sql(f"(currency = 1 AND amount = {fv.INCENTIVE_USD}) OR (currency = 2 AND round(amount * {fv.LD_TO_USD}, 2) = {fv.INCENTIVE_USD})")}
      AS correct_incentive_amt,
    {flag_sql('''day(paid) BETWEEN 5 AND 10 AND (
        month(paid) = month(corrected)
        OR (day(corrected) < 11 AND month(paid) = month(corrected - INTERVAL 1 MONTH)))''')}
      AS ontime_incentive_date,
    CAST(visits >= 2 AS INTEGER) AS two_plusvisits,
    CAST(visits >= 1 AS INTEGER) AS one_plusvisits,
    coalesce({ci("stock_info_supply_actal20_so_stock")},
      CASE WHEN {_contains_any(fv.AL_IN_STOCK_PHRASES)} THEN 1
           WHEN {_contains_any(fv.AL_OUT_OF_STOCK_PHRASES)} THEN 0 END) AS supply_actal20_so_stock_clean,
    {flag_sql(_ACT)} AS supply_act_any_stock,
    {flag_sql(f"{_ACT} AND {_MEDICINES}")} AS lifesaving_instock,
    {flag_sql(" AND ".join(_ONE(n) for n in fv.KIT_COLUMNS))} AS nchap_commodities,
    {", ".join(f"CASE WHEN sd_scenario_{n} IS NOT NULL THEN {flag_sql(f'{ci(f'sd_scenario_{n}')} = {a}')} END AS case_{n}_correct" for n, a in fv.SCENARIO_ANSWERS.items())},
    CASE WHEN health_services_communityengagement_meetings IS NOT NULL
      THEN {flag_sql(ci("health_services_communityengagement_meetings") + " > 0")} END AS chc_meetings_oneplus,
    {ci("health_services_communityengagement_chc")} AS has_chc,
    CASE WHEN code = 13 OR (code = 4 AND corrected < DATE '{RULES.handover}') THEN '{fv.MANAGED_PARTNER}' {_PARTNERS_SQL} END AS ip
  FROM base_v
),
kpi_v AS (
  SELECT *,
    correct_incentive_amt * ontime_incentive_date AS correct_ontime_fy26,
    {flag_sql(f"supply_actal20_so_stock_clean = 1 AND {_MEDICINES}")} AS lifesaving_instock_al,
    {flag_sql("case_1_correct + case_2_correct + case_3_correct = 3")} AS correct_treatment,
    fy_year || '-' || fy_quarter AS fy_year_quarter
  FROM single_v
)"""


def with_survey(select: str) -> str:
    return f"WITH {SURVEY_CTE}\n{select}"


def with_clean(select: str) -> str:
    return f"WITH {SURVEY_CTE},\n{CLEAN_CTE}\n{select}"


def with_kpis(select: str, *ctes: str) -> str:
    return f"WITH {', '.join([SURVEY_CTE, CLEAN_CTE, KPI_CTE, *ctes])}\n{select}"
