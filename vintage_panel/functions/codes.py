"""Codes, labels, bands, rates and limits that results depend on."""

from __future__ import annotations

from datetime import date

from .scalars import ArmRegime, Band

# Status and reason codes of account events.
CHARGEOFF_STATUS = ("B", "Z")
FRAUD_CHARGEOFF = ("Z", "88")
SETTLEMENT_REASONS = ("68", "43", "47", "57")
WORKOUT_REASON = "46"
SHIFT_STATUS = "C"
FIRST_PARTY_REASON = "36"
SYNTHETIC_FIRST_REASON = "39"
SYNTHETIC_THIRD_REASON = "40"
DISPUTE_TYPE = "03"
DISPUTE_NOT_IN_DB = "N"
MAX_MOB_STATUS = (" ", "Z")
NO_FRAUD_SUSPECT = "Non Fraud"

# Application decline codes by exclusion rule.
DECLINE_CODES = {
    "underage": "P00010",
    "recent_decline": "M00001",
    "app_completed": "M00002",
    "app_inprogress": "M00003",
    "bureau_nohit": "H00010",
    "credit_freeze": "F00010",
    "ssn_mismatch": "K00010",
    "dob_mismatch": "K00020",
}

# Channel labels of the profile and of the behaviour panel.
PROFILE_CHANNELS = {
    "CK_LIGHTBOX": "1.CKLB",
    "EXPERIAN_CRDT_MTCH": "2.ECM",
    "DIRECT_MAIL": "3.DM",
    "REFERRALS": "4.RAF",
}
PROFILE_CHANNEL_DEFAULT = "5.Other"
PANEL_CHANNELS = {
    "DIRECT_MAIL": "Direct Mail",
    "CK_LIGHTBOX": "CK Lightbox",
    "EXPERIAN_CRDT_MTCH": "Experian CreditMatch",
}
PANEL_CHANNEL_DEFAULT = "Other Channels"

# Behaviour codes.
BEHAVIOUR_CODES = {"PRREVLR": "Revolver", "PRTRANS": "Transactor"}
BEHAVIOUR_DEFAULT = "Mixed Behavior"

# Score bands (integer bounds, closed).
SCORE_BANDS_4 = (
    Band("3. Sub Prime", ge=580, le=599),
    Band("1. Prime+", ge=660),
    Band("2. Near Prime", ge=600, le=659),
    Band("4. SubPrime <580", lt=580),
)
SCORE_BANDS_4_DEFAULT = "5. Check"
SCORE_BANDS_6 = (
    Band("1.580-599", ge=580, le=599),
    Band("2.600-619", ge=600, le=619),
    Band("3.620-639", ge=620, le=639),
    Band("4.640-659", ge=640, le=659),
    Band("5.660+", ge=660),
    Band("0. <580", lt=580),
)
SCORE_BANDS_6_DEFAULT = "9. other"
CREDIT_BANDS = (
    Band("3. Sub Prime", ge=580, le=599),
    Band("1. Prime+", ge=660),
    Band("2. Near Prime", ge=600, le=659),
)
CREDIT_BANDS_DEFAULT = "4. Check"

# Test-arm limits and the day after which they changed.
ARM_CHANGE = date(2025, 7, 1)
ARMS_BEFORE = ArmRegime(70, 85, 100)
ARMS_AFTER = ArmRegime(80, 90, 100)


def _yearly(*rates: tuple[int, int, float]) -> tuple[tuple[date, date, float], ...]:
    return tuple((date(lo, 1, 1), date(hi, 12, 31), rate / 12) for lo, hi, rate in rates)


# Yearly operating-cost and funding rates, used as monthly rates.
OPEX_RATES = _yearly(
    (2021, 2022, -0.082),
    (2023, 2023, -0.082),
    (2024, 2024, -0.064),
    (2025, 2025, -0.053),
    (2026, 2026, -0.049),
)
OPEX_DEFAULT = -0.049 / 12
FUNDING_RATES = _yearly(
    (2021, 2022, -0.0881),
    (2023, 2023, -0.0881),
    (2024, 2024, -0.0924),
    (2025, 2025, -0.0861),
    (2026, 2026, -0.071),
)
FUNDING_DEFAULT = -0.071 / 12

# Acquisition cost by channel label and entry year; None is the channel default.
ACQUISITION_COST = {
    "Direct Mail": {2022: 99.0, 2023: 82.0, 2024: 70.0, 2025: 102.7, None: 102.7},
    "CK Lightbox": {2022: 64.8, 2023: 64.8, 2024: 67.7, 2025: 73.0, None: 73.0},
    "Experian CreditMatch": {2022: 64.5, 2023: 70.6, 2024: 70.6, 2025: 74.3, None: 74.3},
}
ACQUISITION_COST_DEFAULT = 5.0

# Fee, interchange and recovery constants, launch phases, extract months.
ANNUAL_FEE_LEVEL = 39
INTERCHANGE_RATE = 0.0145
NET_CHARGEOFF_SHARE = 0.9
ADJUSTMENT_CODE = 256
LAUNCH_PHASES = ("04", "05")
EXTRACT_MOBS = (3, 6, 11, 15, 23)
EXTRACT_MIN_YEAR = 2023
# fixed values: cohorts of the model
COHORT_MOBS = (6, 11, 15)
COHORT_YEARS = (2023, 2024)
# fixed values: columns left out of the information-value ranking
IV_IGNORE_ANY_CASE = ("pmic", "band")
IV_IGNORE_PARTS = ("SUPPRE", "VINTAGE", "AUATTR")
IV_IGNORE_NAMES = ("CCFLOW", "PRICETESTSEGMENT", "BOOKMONTH", "REVOLVERFLAGFINAL")

# Name fragments and prefixes that mark columns to drop before screening.
DROP_FRAGMENTS = (
    "APPROVAL",
    "BUCKET",
    "CONNECTED",
    "DATE",
    "OFFER",
    "APPLICATIONSTAT",
    "ACCOUNTID",
    "ACCOUNT_ID",
    "AUTOPAYAMOUNTTYPEID",
)
DROP_PREFIXES = ("IS",)

# Information-value strength bands, highest first.
IV_STRENGTH = ((0.5, "Suspicious"), (0.3, "Strong"), (0.1, "Medium"))
IV_WEAK = (0.02, "Weak")
IV_USELESS = "Useless"

# Order of behaviour levels in tables and in stacked volumes.
LEVEL_ORDER = ("Revolver", "Mixed Behavior", "Transactor")
STACK_ORDER = ("Transactor", "Mixed Behavior", "Revolver")
