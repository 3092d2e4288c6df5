"""Canonical schema of the readings table and the fixed values the
operators must reproduce exactly.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced; do not edit).
# ---------------------------------------------------------------------------

# Raw column names of the dirty readings file, in file order.
RAW_COLUMNS = [
    "date", "Usage_kWh", "Lagging_Current_Reactive.Power_kVarh",
    "Leading_Current_Reactive_Power_kVarh", "CO2(tCO2)",
    "Lagging_Current_Power_Factor", "Leading_Current_Power_Factor", "NSM",
    "WeekStatus", "Day_of_week", "Load_Type",
]
# Same columns in snake case, same order (positional rename).
SNAKE_COLUMNS = [
    "date", "usage_kwh", "lagging_current_reactive_power_kvarh",
    "leading_current_reactive_power_kvarh", "co2_tco2",
    "lagging_current_power_factor", "leading_current_power_factor", "nsm",
    "week_status", "day_of_week", "load_type",
]
JUNK_COLUMN = "mixed_type_col"

# Strings that the strict numeric cleaning turns into null (exact match).
NUMERIC_NULL_TOKENS = [
    "invalid", "?", "error", " NAN ", " ? ", " null ", " ERROR ", " n/a ", " INVALID ",
]
# Strings a CSV reader treats as missing by default (exact match, no trimming).
NA_LITERALS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

WEEK_STATUS_MAP = {"wEEKDAY": "Weekday", "wEEKEND": "Weekend", "NAN": None}
DAY_OF_WEEK_MAP = {
    "mONDAY": "Monday", "tUESDAY": "Tuesday", "wEDNESDAY": "Wednesday",
    "tHURSDAY": "Thursday", "fRIDAY": "Friday", "sATURDAY": "Saturday",
    "sUNDAY": "Sunday", "NAN": None,
}
LOAD_TYPE_MAP = {
    "lIGHT_lOAD": "Light_Load", "mEDIUM_lOAD": "Medium_Load",
    "mAXIMUM_lOAD": "Maximum_Load", "NAN": None,
}

WEEK_STATUS_VALUES = ["Weekday", "Weekend"]
DAY_OF_WEEK_VALUES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                      "Saturday", "Sunday"]
LOAD_TYPE_VALUES = ["Light_Load", "Medium_Load", "Maximum_Load"]

# Chained outlier rule: (column, k), applied in this order.
OUTLIER_STEPS = [
    ("usage_kwh", 3.0),
    ("lagging_current_reactive_power_kvarh", 3.0),
    ("leading_current_reactive_power_kvarh", 20.0),
    ("co2_tco2", 3.0),
    ("lagging_current_power_factor", 3.0),
    ("leading_current_power_factor", 300.0),
]
# Notebook variant of the chain (same columns, other k).
OUTLIER_K_NOTEBOOK = [2.0, 4.0, 20.0, 1.5, 3.0, 300.0]

NSM_MAX = 86399
DATE_FORMAT = "dd/MM/yyyy HH:mm"          # Spark pattern for rendering
DATE_PARSE_FORMAT = "d/M/yyyy H:mm"       # lenient day-first parse

# ---------------------------------------------------------------------------
# Column groups (snake case, used internally).
# ---------------------------------------------------------------------------

TARGET = "usage_kwh"
NUMERIC_COLUMNS = SNAKE_COLUMNS[1:8]
FEATURE_NUMERIC = SNAKE_COLUMNS[2:8]         # the six numeric predictors
CATEGORICAL_COLUMNS = ["week_status", "day_of_week", "load_type"]
RAW_TO_SNAKE = dict(zip(RAW_COLUMNS, SNAKE_COLUMNS))
KEY = "reading_id"


def q(name: str) -> str:
    """Backtick-quote a column name (dots and parentheses are legal here)."""
    return "`" + name.replace("`", "``") + "`"
