"""Feature names and run windows; no Spark needed."""

from datetime import date

import pytest

from basketlens import config as K
from basketlens.config import Window, month_back
from basketlens.functions import naming as M


def test_category_names():
    assert M.category_stem("dep", "1_40", "l3") == "CAT_DEP_%1_40%_L3"
    names = M.pivot_renames(["1_40"], "dep")
    assert names["1_40_SPV"] == "CAT_DEP_%1_40%_SPV"
    assert names["1_40_PCT_Visits"] == "PCT_CAT_DEP_%1_40%_VISITS"
    with pytest.raises(ValueError):
        M.category_stem("dep", "1", "L4")


@pytest.mark.parametrize("old, new", [
    ("CAT_DEP_%1_40%_L3_SPEND", "CAT_L22_0140_L3_SPEND"),
    ("PCT_CAT_SEC_%2_4_9%_UNITS", "PCT_CAT_L21_0204009_UNITS"),
    ("CAT_SEC_%13_6_205%_SPV", "CAT_L21_1306205_SPV"),
    ("CAT_DIV_%10%_SPU", "CAT_L30_10_SPU"),
    ("PCT_CAT_DEP_%13_77&13_78&13_79%_VISITS", "PCT_CAT_L22_1305_VISITS"),
    ("PCT_SF_MINISUPERMARKET_SPEND", "PCT_SF_EXPRESS_SPEND"),
    ("Total_Spend", "SPEND"),
    ("N_DISTINCT_CLASS", "N_DISTINCT_L20"),
])
def test_model_names(old, new):
    assert M.model_name(old, K.FEATURE_TOKENS) == new


def test_income_model_names():
    assert M.model_name("CAT_DEP_%13_67%_L3_SPU", K.FEATURE_TOKENS) == "CAT_L22_1367_L3_SPU"
    assert M.model_name("CAT_DEP_%13_67%_L3_SPU", K.FEATURE_TOKENS_INCOME) == "CAT_L22_1334_L3_SPU"


def test_payment_prefixes():
    assert M.payment_stem("CARD") == "PYMT_CARD" and M.payment_stem("COUPON") == "PYMNT_COUPON"


def test_windows():
    run = Window.from_decision_date(date(2023, 8, 13))
    assert (run.start, run.end, run.start_week) == (date(2022, 8, 1), date(2023, 7, 12), 202231)
    year = Window.from_data_date(date(2024, 1, 31))
    assert (year.start, year.days) == (date(2023, 2, 1), 365)
    assert Window.from_data_date(date(2024, 1, 31), whole_months=False).start == date(2023, 1, 31)
    assert month_back(date(2024, 3, 31), 1) == date(2024, 2, 29)
    with pytest.raises(ValueError):
        Window.from_data_date(date(2024, 1, 30))
    with pytest.raises(ValueError):
        Window(date(2024, 2, 1), date(2024, 1, 1))


def test_clean_names():
    assert M.clean_name("seg_Price Insensitive/High") == "seg_Price_Insensitive_High"
