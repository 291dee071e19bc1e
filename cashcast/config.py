"""Parameters and fixed business values.

The values under "FIXED VALUES" must equal the business rules being reproduced;
they are stated plainly, in natural order, in one place.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (business rules that results depend on)
# ---------------------------------------------------------------------------

COMPANY_CODE = "CC01"
SALES_ORGANIZATION = "VKORG1"
COMPANY_CURRENCY = "EUR"
DEFAULT_CHANNEL = "10"
DEFAULT_CUSTOMER_GROUP = "KG01"
FISCAL_BILLING_CATEGORY = "M"

# payment terms by tier: (DSO mean days, DSO std days, collection rate low, collection rate high)
TIER_TERMS = [
    ("A", 30, 5, 0.96, 0.99),
    ("B", 45, 8, 0.92, 0.97),
    ("C", 65, 20, 0.80, 0.92),
]

# dunning level: (extra days on DSO, multiplier on the collected amount)
DUNNING_TERMS = [
    (0, 0, 1.00),
    (1, 10, 0.97),
    (2, 25, 0.93),
    (3, 50, 0.85),
]

# currency -> rate into company currency
FX_RATES = [
    ("EUR", 1.0),
    ("USD", 0.92),
]

# currency -> house bank account
BANK_BY_CURRENCY = [
    ("EUR", "BANK001"),
    ("USD", "BANK002"),
]

# DSO clamp (days)
DSO_MIN, DSO_MAX = 1, 180

# cash forecast growth factor
CASH_GROWTH = 1.04

# seasonal demand offsets by month (L001 swing) and group scaling
SEASONAL_OFFSETS = [((7, 8), 0.40), ((10, 11), 0.20), ((1, 2), -0.20)]
GROUP_SWING = [("L001", 1.0), ("L004", 0.50), ("P001", 0.05)]
YOY_GROWTH = 0.03
BASE_YEAR = 2023

# weather multiplier on demand
HEAT_RAMP_START_C = 22.0
HEAT_RAMP_WIDTH_C = 5.0
HEAT_RAMP_MAX = 0.50
HOT_THRESHOLD_C = 25.0
HOT_BONUS = 0.30
ANOMALY_BONUS = 0.20
WEATHER_CAP = 3.0
P001_WEATHER_SHARE = 0.30

# price rules
SUMMER_SURGE = 1.05
VAT_RATE = 0.19

# weather harmonic and heat rule
WARMING_TREND_PER_MONTH = 0.04
EXTREME_HEAT_MARGIN_C = 3.0
WEATHER_FALLBACK = (10.0, 0.0)   # documented fallback (temperature, anomaly)

# forecast model
MIN_HISTORY_ROWS = 10
INTERVAL_WIDTH = 0.80
HORIZON_WEEKS = 26

# ---------------------------------------------------------------------------
# Run parameters on the driver's tables (see FIXTURES.md section 3)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ForecastConfig:
    training_end: dt.date = dt.date(1999, 12, 31)
    test_end: dt.date = dt.date(2000, 6, 30)
    horizon: int = HORIZON_WEEKS
    materials: tuple[str, ...] = ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")
    countries: tuple[str, ...] = ("EUROPE",)
    min_rows: int = MIN_HISTORY_ROWS
    fallback: tuple[float, float] = WEATHER_FALLBACK
    interval_width: float = INTERVAL_WIDTH
    phased_out: tuple[tuple[str, dt.date], ...] = (("PROMO", dt.date(2000, 1, 1)),)
    cash_years: tuple[int, int] = (1997, 1999)
    cash_forecast_start: dt.date = dt.date(2000, 1, 1)
    cash_forecast_months: int = 6
    heat_windows: tuple = field(default=(("EUROPE", (7, 8), (1997, 1998)),))
    base_year: int = 1995                      # first year of order history (growth origin)
    uplift_years: tuple[int, int] = (1997, 1999)   # heat summer vs normal summer (A15, V7)
    uplift_groups: tuple[str, ...] = ("L001", "L004")


DEFAULT = ForecastConfig()

# ---------------------------------------------------------------------------
# FIXTURE RULES: how the driver's tables stand in for the business tables
# (FIXTURES.md section 3). Fixed values, stated together.
# ---------------------------------------------------------------------------

# part type -> material group
MATERIAL_GROUPS = [
    ("SMALL", "L001"), ("MEDIUM", "L001"),
    ("STANDARD", "P001"), ("ECONOMY", "P001"),
    ("LARGE", "L004"), ("PROMO", "L004"),
]

# market segment -> customer tier (MACHINERY has no tier: its payers are skipped)
SEGMENT_TIERS = [
    ("BUILDING", "A"),
    ("AUTOMOBILE", "B"), ("FURNITURE", "B"),
    ("HOUSEHOLD", "C"),
]

# region name -> transaction currency (JPY has no rate on purpose)
REGION_CURRENCY = [("AMERICA", "USD"), ("ASIA", "JPY")]
OTHER_REGION_CURRENCY = "EUR"

# order status -> overall processing status
ORDER_STATUS = [("F", "C"), ("P", "B"), ("O", "A")]
REJECTED_PRIORITY = "5-LOW"

# payment terms code by tier
TIER_PAYMENT_TERMS = [("A", "NT30"), ("B", "NT45"), ("C", "NT65")]
OTHER_PAYMENT_TERMS = "NT30"

# SKUs with a Sep-Dec price surge and their rate (supplied as data, drawn once)
SURGE_SKUS = [("STANDARD", "0.07"), ("PROMO", "0.05")]
SURGE_MONTHS = (9, 10, 11, 12)
SUMMER_MONTHS = (7, 8)

# data-quality expectations: heat-wave anomaly floor per heat year (in window order),
# summer uplift range, and share targets with tolerance
HEAT_ANOMALY_FLOORS = (2.0, 2.5)
UPLIFT_RANGE = (1.4, 1.7)
ELIGIBLE_SHARE_TARGET = (0.63, 0.05)
CANCELLED_SHARE_TARGET = (0.10, 0.02)
ITEMS_PER_ORDER = (2, 3)

# FIXED VALUES: documented table volumes (two sets are published) and the forecast's length; "about"
# is read as within a tenth
VOLUME_TARGETS = [
    ("generator", [("weather", 210), ("salesorder", 5000), ("salesorderitem", 12500), ("billingdocument", 3500),
                   ("billingdocumentitem", 9000), ("cashflow", 3150), ("cashflowforecast", 181)]),
    ("overview", [("weather", 210), ("salesorder", 7000), ("salesorderitem", 17500), ("billingdocument", 4851),
                  ("billingdocumentitem", 12600), ("cashflow", 3969), ("cashflowforecast", 181)]),
]
VOLUME_TOLERANCE = 0.1
