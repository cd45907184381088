"""Fixed values of the survey programme.

Every value below is part of the expected results and cannot be derived; rules
that use them live in ``survey.py`` and ``indicators.py``.
"""

# --- fixed values: county codes and labels -------------------------------
COUNTY_LABELS = {
    1: "Bomi",
    2: "Bong",
    3: "Gbarpolu",
    4: "Grand Bassa",
    5: "Grand Cape Mount",
    6: "Grand Gedeh",
    7: "Grand Kru",
    8: "Lofa",
    9: "Margibi",
    10: "Maryland",
    11: "Montserrado",
    12: "Nimba",
    13: "Rivercess",
    14: "River Gee",
    15: "Sinoe",
}

# --- fixed values: implementing partner by county ------------------------
MANAGED_PARTNER = "LMH"
MANAGED_COUNTY = 13
HANDED_OVER_COUNTY = 4
HANDOVER_DATE = "2026-01-01"
OTHER_PARTNERS = {
    "IRC": (2, 7, 8, 14),
    "CHT/WB": (3, 5, 6),
    "Plan": (1, 9, 10, 11, 12, 15),
}

# --- fixed values: known wrong survey date and its correction ------------
WRONG_DATE = "2016-02-09"
RIGHT_DATE = "2025-07-11"

# --- fixed values: collector organisations kept in the curated layer -----
COUNTY_LEVEL_ORGS = (1, 3)

# --- fixed values: incentive payment -------------------------------------
CURRENCY_USD = 1
CURRENCY_LD = 2
LD_TO_USD = 0.0055
INCENTIVE_USD = 70.0
PAY_WINDOW_DAYS = (5, 10)

# --- fixed values: right answers of the case scenarios -------------------
SCENARIO_ANSWERS = {1: 3, 2: 4, 3: 2}

# --- fixed values: the commodities of the full supply kit ----------------
KIT_COLUMNS = (
    "stock_info_supplymicrolut_stock",
    "stock_info_supplymicrogynon_stock",
    "stock_info_supplymcondom_stock",
    "stock_info_supply_fcondom_stock",
    "stock_info_supply_disposable_gloves_stock",
    "stock_info_supply_act25_stock",
    "stock_info_supply_actasaq50_stock",
    "stock_info_supply_artesunate_stock",
    "stock_info_supply_amox_stock",
    "stock_info_supply_ors_stock",
    "stock_info_supply_zinc_stock",
    "stock_info_supply_pcm_stock",
    "stock_info_supplymuac_stock",
    "stock_info_supply_dispbag_stock",
)

# --- fixed values: what life-saving stock is made of ---------------------
AL_COLUMN = "stock_info_supply_actal20_so_stock"
ASAQ_COLUMNS = ("stock_info_supply_act25_stock", "stock_info_supply_actasaq50_stock")
MEDICINE_COLUMNS = (
    "stock_info_supply_amox_stock",
    "stock_info_supply_ors_stock",
    "stock_info_supply_zinc_stock",
)

# --- fixed values: notes that tell the AL stock, first match wins --------
AL_IN_STOCK_PHRASES = (
    "cha has act( al)",
    "cha has act(al)",
    "cha has act (al)",
    "cha has al not",
    "act( al) in stock not asaq",
    "al is available with cha",
    "cha has in stock act(al) not asaq",
    "cha has al in stock not asaq",
)
AL_OUT_OF_STOCK_PHRASES = (
    "stock out of al in community",
    "no malaria tablet of all age group",
    "no iccm commodities",
    "no drugs for cha",
    "no drugs has been delivered to cha",
    "stock out of iccm commodities",
    "only ors, zinc and amoxicillin are in stock",
)

# --- fixed values: status by percentage of the target --------------------
STATUS_BANDS = (
    (100, "achieved"),
    (75, "on_track"),
    (50, "delayed"),
    (25, "at_risk"),
)
STATUS_BELOW_BANDS = "okr_under_review"
STATUS_WITHOUT_TARGET = "on_track"

# --- fixed values: published indicators, (numerator, denominator) --------
INDICATORS = {
    "2.2": ("n_correct_ontime_fy26", "total_surveyed"),
    "2.3": ("n_has_chc", "total_surveyed"),
    "2.4": ("n_lifesaving_instock", "total_surveyed"),
    "2.6": ("n_two_plusvisits", "d_two_plusvisits"),
}
INDICATOR_DIMENSIONS = ("cy_year", "cy_month", "managed_county", "total_surveyed")
