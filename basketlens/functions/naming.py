"""Names of feature columns and their translation to the names a trained model knows."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

BASE_KPIS = ("Spend", "Visits", "Units", "SPV", "UPV", "SPU")
SHARE_KPIS = ("Spend", "Visits", "Units")
RECENCY_LEVELS = ("", "L3", "L6", "L9")


def category_stem(level: str, code: str, recency: str = "") -> str:
    """``CAT_DEP_%1_40%_L3``: level, code between percent signs, recency where there is one."""
    if recency.upper() not in RECENCY_LEVELS:
        raise ValueError(f"recency must be one of {RECENCY_LEVELS}, got {recency!r}")
    tail = f"_{recency.upper()}" if recency else ""
    return f"CAT_{level.upper()}_%{code}%{tail}"


def kpi_names(stem: str) -> dict[str, str]:
    """Output name of each KPI of one pivot value."""
    names = {kpi: f"{stem}_{kpi.upper()}" for kpi in BASE_KPIS}
    names.update({f"PCT_{kpi}": f"PCT_{stem}_{kpi.upper()}" for kpi in SHARE_KPIS})
    return names


def pivot_renames(codes: Iterable, level: str, recency: str = "") -> dict[str, str]:
    """Renames for a pivot whose columns are ``<code>_<KPI>``."""
    return {
        f"{code}_{kpi}": name
        for code in codes
        for kpi, name in kpi_names(category_stem(level, str(code), recency)).items()
    }


def label_stem(label: str) -> str:
    return label.upper().replace(" ", "")


def payment_stem(payment: str) -> str:
    """Vouchers and coupons carry their own spelling of the prefix."""
    prefix = "PYMNT" if payment in ("VOUCHER", "COUPON") else "PYMT"
    return f"{prefix}_{payment}"


def _pad_code(match: re.Match) -> str:
    """Fixed-width code: each part two digits, the third (section) part three."""
    parts = [p.zfill(2) if len(p) == 1 else p for p in match.group(1).split("_")]
    if len(parts) > 2:
        parts[2] = parts[2].zfill(3)
    return "".join(parts)


def model_name(column: str, tokens: Mapping[str, str]) -> str:
    """Name under which a trained model knows a feature column."""
    known = re.compile("|".join(re.escape(token) for token in tokens))
    swapped = known.sub(lambda hit: tokens[hit.group(0)], column)
    return re.sub(r"%([^%]*)%", _pad_code, swapped)


def clean_name(column: str) -> str:
    """Column name without characters a model library refuses."""
    return re.sub(r"\W", "_", column)
