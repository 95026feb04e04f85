"""Table schemas and column lists shared by every module."""

from pyspark.sql import types as T

# Table layouts, CSV headers, category names and column lists that the data model prescribes.

CRM_COLUMNS = [
    "customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure", "city", "state", "zip_code",
]
SERVICE_COLUMNS = [
    "customer_id", "phone_service", "multiple_lines", "internet_service", "online_security", "online_backup",
    "device_protection", "tech_support", "streaming_tv", "streaming_movies",
]
BILLING_COLUMNS = [
    "customer_id", "contract", "paperless_billing", "payment_method", "monthly_charges", "total_charges", "churn",
    "churn_value", "churn_score", "cltv", "churn_reason",
]
CDR_COLUMNS = ["event_id", "customer_id", "event_date", "event_type", "duration_mins", "data_mb", "call_type"]

CSV_HEADERS = {
    "CustomerID": "customer_id",
    "Gender": "gender",
    "Senior Citizen": "senior_citizen",
    "Partner": "partner",
    "Dependents": "dependents",
    "Tenure Months": "tenure",
    "City": "city",
    "State": "state",
    "Zip Code": "zip_code",
    "Phone Service": "phone_service",
    "Multiple Lines": "multiple_lines",
    "Internet Service": "internet_service",
    "Online Security": "online_security",
    "Online Backup": "online_backup",
    "Device Protection": "device_protection",
    "Tech Support": "tech_support",
    "Streaming TV": "streaming_tv",
    "Streaming Movies": "streaming_movies",
    "Contract": "contract",
    "Paperless Billing": "paperless_billing",
    "Payment Method": "payment_method",
    "Monthly Charges": "monthly_charges",
    "Total Charges": "total_charges",
    "Churn Label": "churn",
    "Churn Value": "churn_value",
    "Churn Score": "churn_score",
    "CLTV": "cltv",
    "Churn Reason": "churn_reason",
}

ADDON_COLUMNS = [
    "online_security", "online_backup", "device_protection", "tech_support", "streaming_tv", "streaming_movies",
]
BINARY_COLUMNS = ["gender", "senior_citizen", "partner", "dependents", "phone_service", "paperless_billing"]
NOMINAL_COLUMNS = ["multiple_lines", "internet_service", *ADDON_COLUMNS, "contract", "payment_method"]
NUMERIC_COLUMNS = [
    "tenure", "monthly_charges", "total_charges", "churn_score", "cltv", "num_services", "charge_per_month_ratio",
    "total_calls", "total_call_mins", "total_data_mb", "complaint_count",
]
SUMMARY_COLUMNS = [
    "tenure", "monthly_charges", "total_charges", "churn_score", "cltv", "total_calls", "total_call_mins",
    "total_data_mb", "complaint_count",
]
DISTRIBUTION_COLUMNS = ["tenure", "monthly_charges", "total_charges", "churn_score", "cltv"]
USAGE_COLUMNS = ["total_calls", "total_call_mins", "total_data_mb", "complaint_count"]
CORRELATION_COLUMNS = [
    "tenure", "monthly_charges", "total_charges", "churn_score", "cltv", "num_services", "total_calls",
    "total_call_mins", "total_data_mb", "complaint_count", "churn_value",
]

# Tenure segments: name and highest month of tenure that belongs to it.
SEGMENT_LIMITS = [("New", 12), ("Growing", 36), ("Loyal", 60)]
LAST_SEGMENT = "Champion"
SEGMENTS = [name for name, _ in SEGMENT_LIMITS] + [LAST_SEGMENT]
LAST_BAND_LIMIT = 72
BAND_LABELS = ["New (0-12m)", "Growing (13-36m)", "Loyal (37-60m)", "Champion (61+m)"]

MONTH_TO_MONTH = "Month-to-month"
RISK_CHARGE = 70

_TEXT = T.StringType()
_TYPES = {
    "tenure": T.IntegerType(),
    "monthly_charges": T.DecimalType(8, 2),
    "total_charges": T.DecimalType(10, 2),
    "churn_value": T.IntegerType(),
    "churn_score": T.IntegerType(),
    "cltv": T.IntegerType(),
    "event_id": T.LongType(),
    "event_date": T.TimestampNTZType(),
    "duration_mins": T.DecimalType(8, 2),
    "data_mb": T.DecimalType(10, 2),
}


def _schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, _TYPES.get(c, _TEXT)) for c in columns])


CRM = _schema(CRM_COLUMNS)
SERVICES = _schema(SERVICE_COLUMNS)
BILLING = _schema(BILLING_COLUMNS)
CDR = _schema(CDR_COLUMNS)
TABLES = {"crm": CRM, "services": SERVICES, "billing": BILLING, "cdr": CDR}
TABLE_KEYS = {"crm": "customer_id", "services": "customer_id", "billing": "customer_id", "cdr": "event_id"}
