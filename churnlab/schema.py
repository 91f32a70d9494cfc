"""Column names, name mapping and StructTypes.

Internal names are snake_case; ``DISPLAY_NAMES`` maps them to the spaced names that customer
files use, so CSV inputs with the original headers can be renamed on read.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID = "customer_id"
LABEL = "churn"

MINUTE_COLS = ["total_day_minutes", "total_eve_minutes", "total_night_minutes", "total_intl_minutes"]
CALL_COLS = ["total_day_calls", "total_eve_calls", "total_night_calls", "total_intl_calls"]
CHARGE_COLS = ["total_day_charge", "total_eve_charge", "total_night_charge", "total_intl_charge"]
PLAN_COLS = ["international_plan", "voice_mail_plan"]

RAW_COLUMNS = [
    ID, "state", "account_length", "area_code", "international_plan", "voice_mail_plan",
    "number_vmail_messages",
    "total_day_minutes", "total_day_calls", "total_day_charge",
    "total_eve_minutes", "total_eve_calls", "total_eve_charge",
    "total_night_minutes", "total_night_calls", "total_night_charge",
    "total_intl_minutes", "total_intl_calls", "total_intl_charge",
    "customer_service_calls", LABEL,
]

# The original file headers, in file order.
DISPLAY_NAMES = {
    "state": "State",
    "account_length": "Account length",
    "area_code": "Area code",
    "international_plan": "International plan",
    "voice_mail_plan": "Voice mail plan",
    "number_vmail_messages": "Number vmail messages",
    "total_day_minutes": "Total day minutes",
    "total_day_calls": "Total day calls",
    "total_day_charge": "Total day charge",
    "total_eve_minutes": "Total eve minutes",
    "total_eve_calls": "Total eve calls",
    "total_eve_charge": "Total eve charge",
    "total_night_minutes": "Total night minutes",
    "total_night_calls": "Total night calls",
    "total_night_charge": "Total night charge",
    "total_intl_minutes": "Total intl minutes",
    "total_intl_calls": "Total intl calls",
    "total_intl_charge": "Total intl charge",
    "customer_service_calls": "Customer service calls",
    "churn": "Churn",
}

# Engineered feature names in the order they are appended.
ENGINEERED = [
    "customer_tenure_months", "total_minutes", "total_calls", "avg_daily_usage", "call_frequency",
    "intl_usage_rate", "high_service_calls", "has_vmail",
    "log_total_minutes", "log_total_calls", "log_avg_daily_usage", "log_call_frequency",
    "usage_service_interaction", "intl_plan_usage_flag", "day_usage_ratio", "tenure_usage_score",
    "service_calls_per_month",
]

# The 17 numeric inputs of the raw table (after Yes/No encoding of the plans).
NUMERIC_INPUTS = [
    "account_length", "number_vmail_messages",
    "total_day_minutes", "total_day_calls", "total_day_charge",
    "total_eve_minutes", "total_eve_calls", "total_eve_charge",
    "total_night_minutes", "total_night_calls", "total_night_charge",
    "total_intl_minutes", "total_intl_calls", "total_intl_charge",
    "customer_service_calls", "international_plan", "voice_mail_plan",
]

RAW_SCHEMA = T.StructType([
    T.StructField(ID, T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("account_length", T.IntegerType()),
    T.StructField("area_code", T.IntegerType()),
    T.StructField("international_plan", T.StringType()),
    T.StructField("voice_mail_plan", T.StringType()),
    T.StructField("number_vmail_messages", T.LongType()),
    T.StructField("total_day_minutes", T.DoubleType()),
    T.StructField("total_day_calls", T.LongType()),
    T.StructField("total_day_charge", T.DoubleType()),
    T.StructField("total_eve_minutes", T.DoubleType()),
    T.StructField("total_eve_calls", T.LongType()),
    T.StructField("total_eve_charge", T.DoubleType()),
    T.StructField("total_night_minutes", T.DoubleType()),
    T.StructField("total_night_calls", T.LongType()),
    T.StructField("total_night_charge", T.DoubleType()),
    T.StructField("total_intl_minutes", T.DoubleType()),
    T.StructField("total_intl_calls", T.LongType()),
    T.StructField("total_intl_charge", T.DoubleType()),
    T.StructField("customer_service_calls", T.LongType()),
    T.StructField(LABEL, T.BooleanType()),
])

# Scoring request: 13 required fields with their allowed ranges (fixed values).
REQUEST_FIELDS = [
    ("account_length", "int", 1, 250),
    ("international_plan", "yesno", None, None),
    ("voice_mail_plan", "yesno", None, None),
    ("number_vmail_messages", "int", 0, 100),
    ("total_day_minutes", "float", 0, 400),
    ("total_eve_minutes", "float", 0, 400),
    ("total_night_minutes", "float", 0, 400),
    ("total_intl_minutes", "float", 0, 30),
    ("total_day_calls", "int", 0, 200),
    ("total_eve_calls", "int", 0, 200),
    ("total_night_calls", "int", 0, 200),
    ("total_intl_calls", "int", 0, 30),
    ("customer_service_calls", "int", 0, 10),
]

ATTRIBUTION_TYPE = T.ArrayType(T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("shap_value", T.DoubleType()),
]))


def safe_name(text: str) -> str:
    """Lower-case, non-alphanumerics to underscores (for one-hot column names)."""
    out = []
    for ch in text.lower():
        out.append(ch if ch.isalnum() else "_")
    return "".join(out)
