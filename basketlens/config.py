"""Typed configuration and the fixed values of the feature definitions."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


# --- fixed values: they decide results, so they are stated as they are -------------------

DIVISIONS = (1, 2, 3, 4, 9, 10, 13)
STORE_FORMATS = (1, 2, 3, 4, 5)

DEPARTMENT_EXCLUDE = ("1_36", "1_92", "13_25", "13_32")
SECTION_EXCLUDE = (
    "3_7_130", "3_7_131", "3_8_132", "3_9_81", "10_43_34", "3_14_78", "13_6_205", "13_67_364",
    "1_36_708", "1_45_550", "1_92_992", "2_3_245", "2_4_253", "2_66_350", "13_25_249",
    "13_25_250", "13_25_251", "13_67_359", "4_10_84", "4_56_111", "10_46_549",
    "13_6_316", "13_32_617", "13_67_360", "2_4_719",
)
DEPARTMENT_ADDED = ("2_33",)
SECTION_ADDED = ("3_14_80", "10_46_20", "2_33_704")

DEPARTMENT_MERGE = {"13_77&13_78&13_79": ("13_79", "13_77", "13_78")}
SECTION_MERGE = {
    "1_2_187&1_2_86": ("1_2_187", "1_2_86"),
    "3_14_50&3_51_416": ("3_14_50", "3_51_416"),
    "2_3_195&2_3_52": ("2_3_195", "2_3_52"),
}

FORMAT_RENAME = {"HDE": "Hypermarket", "Talad": "Supermarket", "GoFresh": "MiniSupermarket"}

DUMMY_HOUSEHOLD = -1
BACK_DAYS = 380
CARD_SHARE = 0.2
RECENCY_DAYS = (30, 90, 180, 360)
DAYS_PER_YEAR = 360
ACCOUNT_YEARS = 10

THICK_SPEND, THICK_VISITS, THICK_UNITS = 2000, 8, 100
AFFLUENT_SEGMENTS = ("Most Price Insensitive", "Price Insensitive")

CREDIT_SENTINEL = -999999
INCOME_SENTINEL = -9999999
POSTERIOR_OFFSET = 1.7889
SCORE_BASE, SCORE_DOUBLE = 497, 46

RETIRED_FEATURES = (
    "PCT_MIS_BIG_TICKET_UNITS", "PCT_MIS_FOR_LATER_SPEND", "PCT_MIS_FRESH_SPEND",
    "PCT_MIS_FOR_LATER_UNITS", "PCT_MIS_FOR_LATER_VISITS", "PCT_MIS_MIXED_VISITS",
    "PCT_MIS_ALC_TOB_VISITS", "PCT_MIS_HOME_REFRESH_VISITS", "PCT_CAT_L21_0204230_UNITS",
    "PCT_CAT_L21_0204230_SPEND", "PCT_CAT_L21_0204230_VISITS",
)
COPIED_DEPARTMENT, COPIED_SECTION = "1_40", "0140071"

FEATURE_TOKENS = {
    "DIV": "L30",
    "DEP": "L22",
    "SEC": "L21",
    "CLASS": "L20",
    "%3_14_50&3_51_416%": "0314050",
    "%2_3_195&2_3_52%": "0233701",
    "%13_77&13_78&13_79%": "1305",
    "%1_2_187&1_2_86%": "0102016",
    "Total_Spend": "SPEND",
    "Total_Units": "UNITS",
    "Total_Visits": "VISITS",
    "MINISUPERMARKET": "EXPRESS",
    "BKK&VICINITIES": "BKK",
    "%1_71_136%": "0101235",
    "%2_66_353%": "0233707",
}
FEATURE_TOKENS_INCOME = {**FEATURE_TOKENS, "%1_1_149%": "0101234", "%13_67%": "1334"}

FESTIVE = ("XMAS", "APRIL", "NONE")
DAY_PARTS = ("prework", "morning", "lunch", "afternoon", "evening", "late", "night")
FINE_DAY_PARTS = (
    "early_morning", "morning", "lunch", "afterlunch", "evening", "late_evening", "night",
)
DAY_SECTIONS = ("Morning_6AM_12PM", "Afternoon_12PM_4PM", "Evening_4PM_8PM", "Night_8PM_12AM")
WEEK_PARTS = ("Weekday", "Weekend")
PRICE_LEVELS = ("PREMIUM", "BUDGET", "NONE")
PAYMENTS = ("CASH", "CARD", "COUPON", "VOUCHER", "OTHER")
PROMO_FLAGS = ("PROMO", "MARK_DOWN", "NONE")
TILL_TENDERS = ("CASH", "CCARD", "COUPON", "VOUCH", "OTHER")

# Product groups and missions of the table of contacted households.
PRODUCT_GROUPS = (
    "apparel", "baby", "baby_kids", "babyaccessories", "babysupplement", "bakery", "bakeryboughtin", "ball",
    "basicfood", "beveragesparty", "breakfast_icecream", "cookameal", "cosmetics", "dairy_snacksbreaktime",
    "delicatessen", "fishseafood", "foodcourt", "foodsupplement", "freshmeat_seafood", "frozen", "fruit",
    "fruits_healthy", "giftgrocery", "haircare", "health_prod", "hle", "hlh", "hotbevsugar", "household_hlh",
    "icecreamdessert", "kid", "kitchenstock_precooked", "leisure", "luggage", "mealsolutions", "otherbakery",
    "otherdairydrinks", "otherhh", "otherliquor", "othermeat_seafoods", "otherprecooked", "othertobacco",
    "othertoiletries", "papergoods", "personalcare", "petfoodsupplys", "petshopstandalone", "pharmacy",
    "processedfood", "rtd", "skincare",
)
MISSIONS = (
    "ConsumptionforToday", "Emergency", "ImmediateConsumption", "Others", "StockUp", "TopUp", "Weekly", "trader",
)


@dataclass(frozen=True)
class FeedbackSource:
    """How one insurer delivers its call feedback."""

    insurer_nm: str
    encoding: str
    date_format: str


FEEDBACK_SOURCES = {
    "AZAY": FeedbackSource("AAC", "windows-1252", "LL/d/yyyy"),
    "CIGNA": FeedbackSource("CIG", "utf-8", "yyyy-MM-dd"),
}


# --- windows -----------------------------------------------------------------------------


def is_month_end(day: date) -> bool:
    return (day + timedelta(days=1)).day == 1


def month_start(day: date, months_back: int = 0) -> date:
    """First day of the month that lies ``months_back`` months before ``day``."""
    index = day.year * 12 + day.month - 1 - months_back
    return date(index // 12, index % 12 + 1, 1)


def month_back(day: date, months: int) -> date:
    """Same day ``months`` earlier, or the last day of a shorter month."""
    first = month_start(day, months)
    last_day = (month_start(first, -1) - timedelta(days=1)).day
    return first.replace(day=min(day.day, last_day))


def iso_week_id(day: date) -> int:
    iso = day.isocalendar()
    return iso.year * 100 + iso.week


@dataclass(frozen=True)
class Window:
    """Inclusive date range that every feature of one run refers to.

    ``weeks`` are the first and last week of the scan where a run sets them itself; otherwise they are
    those of the dates.
    """

    start: date
    end: date
    weeks: tuple[int, int] | None = None

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"window starts after it ends: {self.start} > {self.end}")

    @property
    def start_week(self) -> int:
        return self.weeks[0] if self.weeks else iso_week_id(self.start)

    @property
    def end_week(self) -> int:
        return self.weeks[1] if self.weeks else iso_week_id(self.end)

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    @classmethod
    def from_data_date(cls, data_date: date, months: int = 12, whole_months: bool = True) -> Window:
        """``months`` that end with ``data_date``, which must close a month.

        With ``whole_months`` the window opens on the first of a month, otherwise on the same
        day of the month as it closes (or on the last day of a shorter month).
        """
        if not is_month_end(data_date):
            raise ValueError(f"model data date {data_date} is not a month end")
        if whole_months:
            return cls(month_start(data_date, months - 1), data_date)
        return cls(month_back(data_date, months), data_date)

    @classmethod
    def from_decision_date(cls, decision: date, gap_months: int = 1, months: int = 12) -> Window:
        """Window that closes the day before ``decision`` moved ``gap_months`` back."""
        end = month_back(decision, gap_months) - timedelta(days=1)
        return cls(month_start(end, months - 1), end)
