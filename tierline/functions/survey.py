"""Survey rules: cleaned columns, then KPI flags, as groups of expressions.

Each function maps column names to expressions, so a caller adds a whole group
with one ``withColumns``. Later groups may name columns of earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions import calendar as cal
from tierline.functions import fixed_values as fv
from tierline.functions.casts import flag, flag_or_null, time_on_day, to_day, to_double, to_int, to_ts


# Helper between the two steps of add_kpis: amoxicillin, ORS and zinc in stock.
MEDICINES = "_medicines_instock"


@dataclass(frozen=True)
class SurveyRules:
    """The dated parts of the rules; everything else is a fixed value."""

    handover: str = fv.HANDOVER_DATE
    wrong_date: str = fv.WRONG_DATE
    right_date: str = fv.RIGHT_DATE


def _number(name: str) -> Column:
    return to_int(F.col(name))


def _is_one(name: str) -> Column:
    return _number(name) == 1


# ---------------------------------------------------------------- cleaning


def county_columns(rules: SurveyRules) -> dict[str, Column]:
    code = _number("basic_info_county")
    labels = F.create_map(*[F.lit(v) for pair in fv.COUNTY_LABELS.items() for v in pair])
    before_handover = to_day(F.col("basic_info_date")) < F.lit(rules.handover).cast("date")
    return {
        "county": F.lower(F.trim("basic_info_county")),
        # a literal map: no join, and a code outside it gives null
        "county_label": F.try_element_at(labels, code),
        "managed_county": flag(
            (code == fv.MANAGED_COUNTY) | ((code == fv.HANDED_OVER_COUNTY) & before_handover)
        ),
    }


def date_columns(rules: SurveyRules) -> dict[str, Column]:
    raw = F.col("basic_info_date")
    day = to_day(raw)
    corrected = F.when(
        day == F.lit(rules.wrong_date).cast("date"), F.lit(rules.right_date).cast("timestamp")
    ).otherwise(to_ts(raw))
    return {
        "manual_date": corrected,
        "start_date": to_ts(F.col("start")),
        "end_date": to_ts(F.col("end")),
        "s_manual_dt": to_ts(F.col("start")),
        "e_manual_dt": time_on_day(F.col("end_manual"), day),
    }


def calendar_columns() -> dict[str, Column]:
    """Calendar and fiscal parts, of the date as entered."""
    day = to_day(F.col("basic_info_date"))
    return {
        "cy_month": F.month(day),
        "cy_year": F.year(day),
        "fy_year": cal.fiscal_year(day),
        "fy_month": cal.fiscal_month(day),
        "fy_quarter": cal.fiscal_quarter(day),
    }


def clean(df: DataFrame, rules: SurveyRules = SurveyRules(), cleaned_at: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if cleaned_at is None else cleaned_at
    return df.withColumns(
        {
            **county_columns(rules),
            **date_columns(rules),
            **calendar_columns(),
            "_cleaned_at": stamp,
        }
    )


# -------------------------------------------------------------- KPI groups


def reported_incentive() -> dict[str, Column]:
    return {
        "correct_ontime": flag(
            _is_one("grp_incentive1_incentive_correct") & _is_one("grp_incentive1_incentive_ontime")
        )
    }


def measured_incentive() -> dict[str, Column]:
    currency = _number("grp_incentive2_incentive_currency")
    amount = to_double(F.col("grp_incentive2_incentive_amt"))
    usd = F.when(currency == fv.CURRENCY_USD, amount).when(
        currency == fv.CURRENCY_LD, F.round(amount * fv.LD_TO_USD, 2)
    )

    paid = to_day(F.col("grp_incentive1_incentive_date"))
    surveyed = F.to_date("manual_date")
    first, last = fv.PAY_WINDOW_DAYS
    # Months behind the survey on the twelve-month dial; years do not count.
    months_back = F.pmod(F.month(surveyed) - F.month(paid), F.lit(12))
    in_time = (months_back == 0) | ((months_back == 1) & (F.dayofmonth(surveyed) <= last))
    return {
        "correct_incentive_amt": flag(usd == fv.INCENTIVE_USD),
        "ontime_incentive_date": flag(F.dayofmonth(paid).between(first, last) & in_time),
    }


def incentive_composite() -> dict[str, Column]:
    both = (F.col("correct_incentive_amt") == 1) & (F.col("ontime_incentive_date") == 1)
    return {"correct_ontime_fy26": flag(both)}


def supervision() -> dict[str, Column]:
    visits = _number("supervision_grp_supervision_last4wks")
    return {
        "two_plusvisits": flag_or_null(visits >= 2),
        "one_plusvisits": flag_or_null(visits >= 1),
    }


def _all_one(names: Sequence[str]) -> Column:
    """All of the flags are 1; null if some are unknown and none is another number.

    Plain answers are settled by comparing texts. Only rows with other spellings
    are parsed, in a loop that takes no generated code per flag.
    """
    flags = [F.col(n) for n in names]
    return (
        F.when(reduce(and_, [f == "1" for f in flags]), True)
        .when(F.lit("0").isin(*flags), False)
        .otherwise(F.forall(F.array(*flags), lambda answer: to_int(answer) == 1))
    )


def _mentions(phrases: Sequence[str]) -> Column:
    """One search for any of the phrases; the notes are lowercased once for it."""
    return F.lower("txt_notes").rlike("|".join(rf"\Q{p}\E" for p in phrases))


def stock() -> dict[str, Column]:
    told = F.when(_mentions(fv.AL_IN_STOCK_PHRASES), 1).when(_mentions(fv.AL_OUT_OF_STOCK_PHRASES), 0)
    any_act = _is_one(fv.AL_COLUMN) | _all_one(fv.ASAQ_COLUMNS)
    return {
        "supply_actal20_so_stock_clean": F.coalesce(_number(fv.AL_COLUMN), told),
        "supply_act_any_stock": flag(any_act),
        MEDICINES: flag(_all_one(fv.MEDICINE_COLUMNS)),
        "nchap_commodities": flag(_all_one(fv.KIT_COLUMNS)),
    }


def stock_composite() -> dict[str, Column]:
    medicines = F.col(MEDICINES) == 1
    return {
        "lifesaving_instock": flag((F.col("supply_act_any_stock") == 1) & medicines),
        "lifesaving_instock_al": flag((F.col("supply_actal20_so_stock_clean") == 1) & medicines),
    }


def cases() -> dict[str, Column]:
    def answered_right(number: int, answer: int) -> Column:
        given = F.col(f"sd_scenario_{number}")
        return F.when(given.isNotNull(), flag(to_int(given) == answer))

    return {
        f"case_{number}_correct": answered_right(number, answer)
        for number, answer in fv.SCENARIO_ANSWERS.items()
    }


def cases_composite() -> dict[str, Column]:
    all_right = reduce(and_, [F.col(f"case_{n}_correct") == 1 for n in fv.SCENARIO_ANSWERS])
    return {"correct_treatment": flag(all_right)}


def community() -> dict[str, Column]:
    meetings = F.col("health_services_communityengagement_meetings")
    return {"chc_meetings_oneplus": F.when(meetings.isNotNull(), flag(to_int(meetings) > 0))}


def partner(rules: SurveyRules) -> dict[str, Column]:
    """Partner by county; the hand-over looks at the corrected survey date."""
    code = _number("basic_info_county")
    before_handover = F.col("manual_date") < F.lit(rules.handover).cast("timestamp")
    name = F.when(
        (code == fv.MANAGED_COUNTY) | ((code == fv.HANDED_OVER_COUNTY) & before_handover),
        fv.MANAGED_PARTNER,
    )
    for other, codes in fv.OTHER_PARTNERS.items():
        name = name.when(code.isin(*codes), other)
    return {"ip": name}


def add_kpis(df: DataFrame, rules: SurveyRules = SurveyRules()) -> DataFrame:
    """All KPI columns: the independent ones first, then their composites."""
    return df.withColumns(
        {
            **reported_incentive(),
            **measured_incentive(),
            **supervision(),
            **stock(),
            **cases(),
            **community(),
            **partner(rules),
        }
    ).withColumns({**incentive_composite(), **stock_composite(), **cases_composite()}).drop(MEDICINES)


def county_level_only(df: DataFrame) -> DataFrame:
    return df.filter(_number("basic_info_data_collector_org").isin(*fv.COUNTY_LEVEL_ORGS))


def curate(df: DataFrame, rules: SurveyRules = SurveyRules()) -> DataFrame:
    """Curated survey rows. The filter goes first: it needs no KPI column."""
    return add_kpis(county_level_only(df), rules)
