"""KPI reports, and the wide-to-long turn for publishing.

Every aggregation here is sum, count or average, so map tasks send one partial
row per group and a group with a third of all rows costs no more than others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions import fixed_values as fv
from tierline.functions.calendar import year_quarter_label
from tierline.functions.indicators import has_committee
from tierline.operators.shape import quoted


def group_size(name: str = "total_surveyed") -> Column:
    return F.count(F.lit(1)).alias(name)


def flag_sum(flag: Column, name: str) -> Column:
    """Sum of a flag; null if it is null in the whole group."""
    return F.sum(flag.cast("long")).alias(name)


def flag_hits(flag: Column, name: str) -> Column:
    """How often a flag is 1; 0 if it is null in the whole group."""
    return F.count_if(flag == 1).alias(name)


def answered(flag: Column, name: str) -> Column:
    return F.count(flag).alias(name)


def flag_percentage(flag: Column, name: str) -> Column:
    return F.round(F.avg(flag.cast("double")) * 100, 1).alias(name)


# fixed values: report measures, label -> source column. A flag that is always 0 or 1 has a
# numerator and a percentage, one that may be unanswered has a denominator too.
ALWAYS_SET = {
    "correct_ontime": "correct_ontime",
    "correct_ontime_fy26": "correct_ontime_fy26",
    "lifesaving_instock": "lifesaving_instock",
    "lifesaving_instock_al": "lifesaving_instock_al",
    "supply_act_any": "supply_act_any_stock",
    "nchap_commodities": "nchap_commodities",
    "correct_treatment": "correct_treatment",
}
MAYBE_UNANSWERED = {
    # label: (source column, denominator)
    "two_plusvisits": ("two_plusvisits", "d_two_plusvisits"),
    "one_plusvisits": ("one_plusvisits", "d_one_plusvisits"),
    "case_1_correct": ("case_1_correct", "d_case_1"),
    "case_2_correct": ("case_2_correct", "d_case_2"),
    "case_3_correct": ("case_3_correct", "d_case_3"),
    "chc_meetings": ("chc_meetings_oneplus", "d_chc_meetings"),
}


def fiscal_quarter_report(curated: DataFrame) -> DataFrame:
    measures = [group_size()]
    for label, source in ALWAYS_SET.items():
        measures += [flag_sum(F.col(source), f"n_{label}"), flag_percentage(F.col(source), f"pct_{label}")]
    for label, (source, denominator) in MAYBE_UNANSWERED.items():
        measures += [
            flag_hits(F.col(source), f"n_{label}"),
            answered(F.col(source), denominator),
            flag_percentage(F.col(source), f"pct_{label}"),
        ]
    measures += [flag_sum(has_committee(), "n_has_chc"), flag_percentage(has_committee(), "pct_has_chc")]

    report = curated.groupBy("fy_year", "fy_quarter", "county_label", "managed_county").agg(*measures)
    return report.withColumn("fy_year_quarter", year_quarter_label(F.col("fy_year"), F.col("fy_quarter")))


def calendar_month_report(curated: DataFrame) -> DataFrame:
    return curated.groupBy("cy_year", "cy_month", "managed_county").agg(
        group_size(),
        flag_sum(F.col("correct_ontime"), "n_correct_ontime"),
        flag_sum(F.col("correct_ontime_fy26"), "n_correct_ontime_fy26"),
        flag_sum(has_committee(), "n_has_chc"),
        flag_sum(F.col("lifesaving_instock"), "n_lifesaving_instock"),
        flag_hits(F.col("two_plusvisits"), "n_two_plusvisits"),
        answered(F.col("two_plusvisits"), "d_two_plusvisits"),
    )


# fixed values: columns of the record report, with two that are made for it
RECORD_COLUMNS = (
    "_id",
    "county_label",
    "managed_county",
    "cy_year",
    "cy_month",
    "fy_year",
    "fy_quarter",
    "fy_month",
    "fy_year_quarter",
    "correct_ontime",
    "correct_incentive_amt",
    "ontime_incentive_date",
    "correct_ontime_fy26",
    "two_plusvisits",
    "one_plusvisits",
    "lifesaving_instock",
    "lifesaving_instock_al",
    "supply_act_any_stock",
    "nchap_commodities",
    "case_1_correct",
    "case_2_correct",
    "case_3_correct",
    "correct_treatment",
    "has_chc",
    "chc_meetings_oneplus",
)


def record_report(curated: DataFrame) -> DataFrame:
    """One row per survey record."""
    made = {"fy_year_quarter": year_quarter_label(F.col("fy_year"), F.col("fy_quarter")), "has_chc": has_committee()}
    return curated.select(*[made[c].alias(c) if c in made else F.col(c) for c in RECORD_COLUMNS])


def indicator_rows(
    wide: DataFrame,
    indicators: Mapping[str, tuple[str, str]] = fv.INDICATORS,
    dimensions: Sequence[str] = fv.INDICATOR_DIMENSIONS,
) -> DataFrame:
    """One row per report row and indicator: numerator, denominator, dimensions.

    A column the report does not have gives null. Rows are multiplied where
    they are; nothing is shuffled.
    """
    present = {c.lower() for c in wide.columns}

    def value(name: str | None) -> Column:
        known = name is not None and name.lower() in present
        return (F.col(quoted(name)) if known else F.lit(None)).cast("long")

    entries = [
        F.struct(
            F.lit(indicator).alias("indicator_id"),
            value(numerator).alias("numerator"),
            value(denominator).alias("denominator"),
        )
        for indicator, (numerator, denominator) in indicators.items()
    ]
    carried = [
        (F.col(quoted(c)) if c.lower() in present else F.lit(None)).alias(c) for c in dimensions
    ]
    return wide.select(*carried, F.inline(F.array(*entries)))
