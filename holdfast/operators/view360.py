"""The wide per-customer view and its parts.

Usage events are reduced to one row per customer before the join. Customer keys are unique in the other three
tables, so this equals joining every event and grouping afterwards, but only one narrow row per customer is shuffled
and a customer who owns a large part of all events is pre-aggregated where the events are read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import schemas as S
from holdfast.functions import columns as C

KEY = "customer_id"
COUNTS = {"total_calls": "call", "total_sms": "sms", "total_data_sessions": "data", "complaint_count": "complaint"}
SUMS = {"total_call_mins": ("call", "duration_mins"), "total_data_mb": ("data", "data_mb")}


def join_sources(crm: DataFrame, services: DataFrame, billing: DataFrame) -> DataFrame:
    return crm.join(services, KEY).join(billing, KEY)


def join_profile(crm: DataFrame, services: DataFrame, billing: DataFrame) -> DataFrame:
    return join_sources(crm, services, billing).select(KEY, "tenure", "monthly_charges", "internet_service", "churn")


def count_columns() -> list[Column]:
    return [F.count_if(F.col("event_type") == kind).alias(name) for name, kind in COUNTS.items()]


def sum_columns() -> list[Column]:
    return [
        F.coalesce(F.sum(F.when(F.col("event_type") == kind, F.col(measure))), F.lit(0)).alias(name)
        for name, (kind, measure) in SUMS.items()
    ]


def usage_counts(cdr: DataFrame) -> DataFrame:
    return cdr.groupBy(KEY).agg(*count_columns())


def usage_sums(cdr: DataFrame) -> DataFrame:
    return cdr.groupBy(KEY).agg(*sum_columns())


def usage_totals(cdr: DataFrame) -> DataFrame:
    return cdr.groupBy(KEY).agg(*count_columns(), *sum_columns())


def join_usage(customers: DataFrame, totals: DataFrame) -> DataFrame:
    """Keep every customer; those without events get zeros."""
    measures = [c for c in totals.columns if c != KEY]
    joined = customers.join(totals, KEY, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in measures})


def monthly_averages() -> dict[str, Column]:
    return {
        "avg_monthly_call_mins": C.monthly_average(F.col("total_call_mins"), F.col("tenure")),
        "avg_monthly_data_mb": C.monthly_average(F.col("total_data_mb"), F.col("tenure")),
    }


def customer_360(crm: DataFrame, services: DataFrame, billing: DataFrame, cdr: DataFrame) -> DataFrame:
    customers = join_sources(crm.drop("zip_code"), services, billing)
    return join_usage(customers, usage_totals(cdr)).withColumns({
        **monthly_averages(),
        "tenure_segment": C.tenure_segment(),
        "num_services": C.num_services(),
        "revenue_at_risk": C.revenue_at_risk(),
    })


VIEW_COLUMNS = [
    *[c for c in S.CRM_COLUMNS if c != "zip_code"],
    *S.SERVICE_COLUMNS[1:],
    *S.BILLING_COLUMNS[1:],
    *COUNTS,
    *SUMS,
    "avg_monthly_call_mins", "avg_monthly_data_mb", "tenure_segment", "num_services", "revenue_at_risk",
]
