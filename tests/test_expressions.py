"""Casts, calendar and the survey rules, on the values that are easy to get wrong."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tierline.functions import calendar as cal
from tierline.functions import fixed_values as fv
from tierline.functions import indicators, survey
from tierline.functions.casts import time_on_day, to_day, to_double, to_int, to_ts
from tierline.functions.survey import SurveyRules


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_to_integer(spark, ansi):
    cases = {
        "1": 1, " 7 ": 7, "-3": -3, "+4": 4, "1.0": 1, "1.9": 1, "-1.9": -1, ".5": 0, "5.": 5,
        "abc": None, "": None, "1e3": None, "1d": None, "NaN": None, "1.x": None, "99999999999": None,
        "0x10": None, None: None, "2147483647.9": 2147483647,
    }
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(k,) for k in cases], "t string")
        assert {r.t: r.n for r in df.select("t", to_int(F.col("t")).alias("n")).collect()} == cases
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_malformed_text_is_null(spark):
    df = spark.createDataFrame([("bad",), ("2024-02-30",), ("",)], "t string")
    got = df.select(to_day(F.col("t")), to_ts(F.col("t")), to_double(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(None, None, None)] * 3


def test_time_of_day_goes_on_the_survey_date(spark):
    df = spark.createDataFrame(
        [("10:45:00.000Z", "2024-06-30"), ("T09:00", "2024-06-30"), ("2024-01-02T03:04:05Z", "2024-06-30"), ("noon", "2024-06-30"), ("10:45", None)],
        "clock string, day string",
    )
    got = [r[0] for r in df.select(time_on_day(F.col("clock"), to_day(F.col("day")))).collect()]
    assert got == [datetime(2024, 6, 30, 10, 45), datetime(2024, 6, 30, 9), datetime(2024, 1, 2, 3, 4, 5), None, None]


def test_fiscal_calendar_around_its_borders(spark):
    df = spark.createDataFrame(
        [("2024-06-30",), ("2024-07-01",), ("2024-12-31",), ("2025-01-01",), ("2025-03-31",), ("2025-04-01",), ("2024-08-31",)], "d string"
    ).select(to_day(F.col("d")).alias("d"))
    got = df.select(cal.fiscal_year(F.col("d")), cal.fiscal_quarter(F.col("d")), cal.fiscal_month(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(2024, 4, 12), (2025, 1, 1), (2025, 2, 6), (2025, 3, 7), (2025, 3, 9), (2025, 4, 10), (2025, 1, 2)]


def test_month_lists():
    assert cal.last_months(date(2024, 3, 31), 3) == ["202401", "202402", "202403"]
    assert cal.last_months(date(2024, 1, 31), 3) == ["202311", "202312", "202401"]
    assert cal.last_months(date(2024, 1, 31), 0) == []


def _submission(**answers):
    names = [
        "basic_info_county", "basic_info_date", "basic_info_data_collector_org", "start", "end", "end_manual",
        "grp_incentive1_incentive_correct", "grp_incentive1_incentive_ontime", "grp_incentive1_incentive_date",
        "grp_incentive2_incentive_amt", "grp_incentive2_incentive_currency", "supervision_grp_supervision_last4wks",
        "stock_info_supply_actal20_so_stock", "txt_notes", "sd_scenario_1", "sd_scenario_2", "sd_scenario_3",
        "health_services_communityengagement_chc", "health_services_communityengagement_meetings", *fv.KIT_COLUMNS,
    ]
    return {n: answers.get(n) for n in names}


def _curated(spark, *submissions):
    rows = [_submission(basic_info_data_collector_org="1", **s) for s in submissions]
    schema = ", ".join(f"{n} string" for n in rows[0])
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema).coalesce(1)
    return survey.curate(survey.clean(df), SurveyRules()).collect()


def test_unanswered_questions(spark):
    (row,) = _curated(spark, {})
    zero = [
        "managed_county", "correct_ontime", "correct_incentive_amt", "ontime_incentive_date", "correct_ontime_fy26",
        "lifesaving_instock", "lifesaving_instock_al", "supply_act_any_stock", "nchap_commodities", "correct_treatment",
    ]
    null = [
        "county", "county_label", "two_plusvisits", "one_plusvisits", "case_1_correct", "case_2_correct", "case_3_correct",
        "chc_meetings_oneplus", "supply_actal20_so_stock_clean", "ip", "cy_month", "fy_year", "manual_date",
    ]
    assert {c: row[c] for c in zero} == dict.fromkeys(zero, 0)
    assert {c: row[c] for c in null} == dict.fromkeys(null)


def test_malformed_answers(spark):
    (row,) = _curated(
        spark,
        {
            "sd_scenario_1": "abc",
            "health_services_communityengagement_meetings": "many",
            "supervision_grp_supervision_last4wks": "often",
            "basic_info_county": "x",
            "grp_incentive2_incentive_amt": "seventy",
            "grp_incentive2_incentive_currency": "1",
        },
    )
    assert (row.case_1_correct, row.chc_meetings_oneplus, row.two_plusvisits) == (0, 0, None)
    assert (row.county_label, row.managed_county, row.correct_incentive_amt) == (None, 0, 0)


def test_county_hand_over_uses_the_raw_and_the_partner_the_corrected_date(spark):
    rows = _curated(
        spark,
        {"basic_info_county": "4", "basic_info_date": "2025-12-31"},
        {"basic_info_county": "4", "basic_info_date": "2026-01-01"},
        {"basic_info_county": "13", "basic_info_date": "2026-01-01"},
        {"basic_info_county": "13", "basic_info_date": None},
        {"basic_info_county": "4", "basic_info_date": None},
        {"basic_info_county": "4.0", "basic_info_date": fv.WRONG_DATE},
        {"basic_info_county": "16", "basic_info_date": "2025-12-31"},
        {"basic_info_county": "0", "basic_info_date": "2025-12-31"},
    )
    assert [(r.managed_county, r.ip) for r in rows] == [
        (1, "LMH"), (0, None), (1, "LMH"), (1, "LMH"), (0, None), (1, "LMH"), (0, None), (0, None),
    ]
    assert [r.county_label for r in rows[-3:]] == ["Grand Bassa", None, None]
    assert rows[5].manual_date == datetime(2025, 7, 11)
    assert (rows[5].cy_year, rows[5].cy_month, rows[5].fy_year) == (2016, 2, 2016)


def test_every_county_has_a_label_and_a_partner(spark):
    rows = _curated(spark, *[{"basic_info_county": str(c), "basic_info_date": "2025-01-01"} for c in range(1, 16)])
    assert [r.county_label for r in rows] == list(fv.COUNTY_LABELS.values())
    assert all(r.ip for r in rows)


def test_pay_window(spark):
    cases = [
        ("2025-06-20", "2025-06-05", 1),
        ("2025-06-20", "2025-06-10", 1),
        ("2025-06-20", "2025-06-11", 0),
        ("2025-06-20", "2025-06-04", 0),
        ("2025-06-10", "2025-05-07", 1),
        ("2025-06-11", "2025-05-07", 0),
        ("2025-01-05", "2024-12-08", 1),
        ("2025-12-05", "2025-01-08", 0),
        ("2025-06-20", "1999-06-07", 1),  # years do not count
        ("2025-06-20", None, 0),
        (None, "2025-06-07", 0),
    ]
    rows = _curated(spark, *[{"basic_info_date": s, "grp_incentive1_incentive_date": p} for s, p, _ in cases])
    assert [r.ontime_incentive_date for r in rows] == [expected for _, _, expected in cases]


def test_incentive_amount(spark):
    amounts = [("1", "70"), ("1", "70.0"), ("1", "70.004"), ("2", "12727"), ("2", "12728.2"), ("2", "12720"), ("3", "70"), (None, "70")]
    rows = _curated(spark, *[{"grp_incentive2_incentive_currency": c, "grp_incentive2_incentive_amt": a} for c, a in amounts])
    assert [r.correct_incentive_amt for r in rows] == [1, 1, 0, 1, 0, 0, 0, 0]


def test_notes_tell_the_stock_only_where_the_answer_is_missing(spark):
    rows = _curated(
        spark,
        {"txt_notes": "No drugs for CHA, but CHA has ACT(AL) here"},
        {"txt_notes": "NO DRUGS FOR CHA"},
        {"txt_notes": "CHA has al in stock not asaq", "stock_info_supply_actal20_so_stock": "0"},
        {"txt_notes": "CHA has al in stock not asaq", "stock_info_supply_actal20_so_stock": "?"},
        {"txt_notes": "nothing"},
    )
    assert [r.supply_actal20_so_stock_clean for r in rows] == [1, 0, 0, 1, None]


def test_every_phrase_is_found(spark):
    phrases = fv.AL_IN_STOCK_PHRASES + fv.AL_OUT_OF_STOCK_PHRASES
    rows = _curated(spark, *[{"txt_notes": f"x {p.upper()} y"} for p in phrases])
    assert [r.supply_actal20_so_stock_clean for r in rows] == [1] * 8 + [0] * 7


def test_act_by_either_formulation(spark):
    medicines = {f"stock_info_supply_{m}_stock": "1" for m in ("amox", "ors", "zinc")}
    both = {"stock_info_supply_act25_stock": "1", "stock_info_supply_actasaq50_stock": "1"}
    rows = _curated(
        spark,
        {**medicines, **both},
        {**medicines, "stock_info_supply_act25_stock": "1"},
        {**medicines, "stock_info_supply_actal20_so_stock": "1"},
        {**medicines, **both, "stock_info_supply_zinc_stock": "0"},
    )
    assert [(r.supply_act_any_stock, r.lifesaving_instock, r.lifesaving_instock_al) for r in rows] == [
        (1, 1, 0), (0, 0, 0), (1, 1, 1), (1, 0, 0),
    ]


def test_full_kit_needs_all_fourteen(spark):
    full = dict.fromkeys(fv.KIT_COLUMNS, "1")
    odd = dict(zip(fv.KIT_COLUMNS, ["1.0", " 1", "01", "+1"]))
    rows = _curated(
        spark,
        full,
        *[{**full, c: "0"} for c in fv.KIT_COLUMNS],
        {**full, **odd},
        {**full, **odd, fv.KIT_COLUMNS[-1]: "0.0"},
        {**full, fv.KIT_COLUMNS[3]: None},
        {**full, fv.KIT_COLUMNS[3]: "yes"},
        {**full, **odd, fv.KIT_COLUMNS[-1]: None},
        {**full, fv.KIT_COLUMNS[3]: "2"},
    )
    assert len(fv.KIT_COLUMNS) == 14
    assert [r.nchap_commodities for r in rows] == [1] + [0] * 14 + [1, 0, 0, 0, 0, 0]


def test_only_county_level_organisations_stay(spark):
    df = spark.createDataFrame([("1",), ("3",), ("2",), (None,), ("x",), ("3.0",)], "basic_info_data_collector_org string")
    assert sorted(r[0] for r in survey.county_level_only(df).collect()) == ["1", "3", "3.0"]


def test_indicator_value_and_status(spark):
    df = spark.createDataFrame(
        [(1, 3, 100.0), (3, 4, 100.0), (1, 0, 50.0), (1, None, 50.0), (None, 4, 50.0), (1, 2, 0.0), (1, 2, None), (1, 4, 100.0), (24, 100, 100.0), (9, 4, 100.0)],
        "n long, d long, target double",
    ).coalesce(1)
    valued = df.withColumn("v", indicators.percentage(F.col("n"), F.col("d")))
    got = [tuple(r) for r in valued.select("v", indicators.status(F.col("v"), F.col("target"))).collect()]
    assert got == [
        (33.33, "at_risk"), (75.0, "on_track"), (None, "on_track"), (None, "on_track"), (None, "on_track"),
        (50.0, "on_track"), (50.0, "on_track"), (25.0, "at_risk"), (24.0, "okr_under_review"), (225.0, "achieved"),
    ]
